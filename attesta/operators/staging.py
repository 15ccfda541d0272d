"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir. Only a local session may do without that setting, and then has a folder of its own."""
    where, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not where:
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = f"file://{tempfile.gettempdir()}/attesta-checkpoints"
    return f"{where.rstrip('/')}/attesta-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below spark.checkpoint.dir and read back, so that what is dear is made once and lost executors cost a retry."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

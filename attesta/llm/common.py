"""What the operators of this package share: reading, writing intermediate tables, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a side may have to be broadcast. Rows here are keys and numbers of at most some 40 bytes.
BROADCAST_ROWS = 1_000_000

#: Rows in an Arrow batch. Whole texts are long, so that Spark's default of 10,000 rows would take gigabytes.
ARROW_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Ready a session for Python workers: they get this package, and whole texts in batches of at most ARROW_ROWS rows."""
    shipped = getattr(spark.sparkContext, "_attesta_shipped", None)
    if shipped is None:
        root = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp()) / "attesta_package.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(archive))
        spark.sparkContext._attesta_shipped = str(archive)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session may do without one, and then has one of its own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = f"file://{tempfile.gettempdir()}/attesta-checkpoints"
    return f"{where.rstrip('/')}/attesta-{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Removes the intermediate tables of this application; tables that were returned must have been read by then."""
    where = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back; ``clean`` removes it, as the tables that are returned read it lazily.

    Cuts the lineage in a way that survives lost executors, and gives the reader exact sizes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite").option("compression", "zstd")
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a table already written, with a broadcast hint if it has at most ``most`` rows.

    Beyond that the join is left to shuffle both sides, and Spark to split what is skewed.
    """
    return F.broadcast(df) if df.count() <= most else df


def hex64(col) -> F.Column:
    """16 lower-case hex digits of a 64-bit integer."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))

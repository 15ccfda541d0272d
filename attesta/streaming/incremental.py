"""Resumable scans as Structured Streaming: a checkpoint is the cursor, a trigger takes what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .keyed import KeyedTable


def resumable(spark: SparkSession, source: str, sink: str, checkpoint: str, key: str, pattern: str = "*.parquet") -> int:
    """Append the rows of new files whose key is new to ``sink``; returns the batches run. Calling it again goes on from the checkpoint.

    Keys that were seen stay in the state, as a cursor's list of processed items does.
    """
    schema = spark.read.option("pathGlobFilter", pattern).parquet(source).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(source).dropDuplicates([key])
    query = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return len(query.recentProgress)


def worklist(items: DataFrame, enriched: DataFrame, key: str) -> DataFrame:
    """Items that are not enriched yet, or only with a warning, so that they are tried again."""
    return items.join(enriched.where(F.col("crawl_warning").isNull()).select(key), key, "left_anti")


def upsert(current: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, action): update where both have it, insert where only the new one does, keep the rest."""
    a, b = current.select(F.col(key), F.lit(1).alias("_a")), new.select(F.col(key), F.lit(1).alias("_b"))
    return a.join(b, key, "full").select(key, F.when(F.col("_a").isNull(), "insert").when(F.col("_b").isNull(), "keep").otherwise("update").alias("action"))


def upsert_sink(spark: SparkSession, folder: str, key: str, order: str, **options):
    """A function for ``foreachBatch`` that upserts each batch into a keyed table; one that is tried again changes nothing."""
    return KeyedTable(spark, folder, key, **options).sink(order)


def read_newest(spark: SparkSession, folder: str, key: str) -> DataFrame | None:
    return KeyedTable(spark, folder, key).read()


def run_budget(now: str, end: str, total: int, buffer: int = 900, least: int = 300):
    """Seconds that a run may take: until the window's end less a buffer, at least ``least``, at most ``total``."""
    left = F.unix_timestamp(end) - F.unix_timestamp(now) - buffer
    return F.greatest(F.lit(least), F.least(F.lit(total), left))

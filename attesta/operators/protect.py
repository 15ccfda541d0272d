"""Protecting a publication: carry-forward, superset check, audits, manifest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class PublishGuardError(RuntimeError):
    """A publication that must not replace the one before."""


def preserve(candidate: DataFrame, baseline: DataFrame, key: str, eligible: Column) -> DataFrame:
    """The candidate and those eligible rows of the baseline whose key it lacks; ``origin`` tells which."""
    kept = baseline.where(eligible).join(candidate.select(key).distinct(), key, "left_anti")
    return candidate.withColumn("origin", F.lit("candidate")).unionByName(kept.withColumn("origin", F.lit("baseline")), allowMissingColumns=True)


def missing_keys(baseline: DataFrame, candidate: DataFrame, key: str) -> DataFrame:
    """Keys that the baseline has and the candidate lacks."""
    return baseline.select(key).where(F.col(key).isNotNull()).distinct().join(candidate.select(key), key, "left_anti")


def require_superset(baseline: DataFrame, candidate: DataFrame, key: str, show: int = 20) -> None:
    lost = [r[0] for r in missing_keys(baseline, candidate, key).orderBy(key).limit(show).collect()]
    if lost:
        raise PublishGuardError(f"the candidate lacks keys of the baseline, among them {lost}")


def require_rows(df: DataFrame, least: int, name: str) -> DataFrame:
    if (n := df.limit(least).count()) < least:
        raise PublishGuardError(f"{name} has {n} rows; at least {least} are needed")
    return df


def guarded_write(df: DataFrame, path: str, least: int, name: str) -> None:
    """Writes JSON lines, unless there are too few rows: then what is there stays."""
    require_rows(df, least, name).write.mode("overwrite").json(path)


def audit(df: DataFrame, checks: list[tuple[str, Column]], key: str) -> DataFrame:
    """(check_ord, error, rows): the row checks that fail, with how many rows do, and repeated keys. One pass and one aggregation of keys."""
    counts = df.agg(*(F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"c{i}") for i, (_, ok) in enumerate(checks)))
    rows = F.explode(F.array(*(F.struct(F.lit(i).cast("bigint").alias("check_ord"), F.lit(name).alias("error"), F.col(f"c{i}").alias("rows")) for i, (name, _) in enumerate(checks))))
    repeated = df.groupBy(key).count().where("count > 1").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(len(checks)).cast("bigint").alias("check_ord"), F.lit("duplicate keys").alias("error"), "rows")
    return counts.select(rows.alias("e")).select("e.*").unionAll(repeated).where("rows > 0")


def union_in_order(*inputs: DataFrame) -> DataFrame:
    """All inputs, with their number as ``file_ord``; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [d.withColumn("file_ord", F.lit(i)) for i, d in enumerate(inputs)])


def manifest(df: DataFrame, sources: str) -> DataFrame:
    """(source, rows) of an array column."""
    return df.select(F.explode(sources).alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("rows"))


def publish_order(count: str, rank: str, title: str) -> list[Column]:
    return [F.desc(count), F.coalesce(F.col(rank), F.lit(1_000_000_000)).asc(), F.asc(title)]

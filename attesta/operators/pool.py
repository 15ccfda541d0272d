"""Pools of nodes: first-wins insertion, choice, failover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nodes import excluded
from .resolve import keep_first


def distinct_nodes(nodes: DataFrame, name: str, order: str) -> DataFrame:
    """The first node of each name; nodes without one are told apart by all they hold."""
    key = F.coalesce(F.nullif(F.trim(name), F.lit("")), F.to_json(F.struct(*(c for c in nodes.columns if c != order))))
    return keep_first(nodes.withColumn("_k", key), ["_k"], [order]).drop("_k")


def insert_new(pool: DataFrame, new: DataFrame, name: str, order: str, keywords: list[str] = ()) -> DataFrame:
    """The new nodes that are not excluded and whose name the pool lacks, the first of each name."""
    ok = new.where(~excluded(F.col(name), list(keywords))) if keywords else new
    return keep_first(ok.join(pool.select(name).distinct(), name, "left_anti"), [name], [order])


def counters(log: DataFrame, name: str, ok: Column, at: str) -> DataFrame:
    """(name, success, fail, last_used) of a log of uses."""
    return log.groupBy(name).agg(F.count_if(ok).alias("success"), F.count_if(~ok).alias("fail"), F.max(at).alias("last_used"))


def best(stats: DataFrame, name: str, order: str) -> DataFrame:
    """The node of the highest share of successes; unused ones count one half; ties by order."""
    score = F.coalesce(F.try_divide(F.col("success"), F.col("success") + F.col("fail")), F.lit(0.5))
    return stats.agg(F.min_by(name, F.struct((-score).alias("s"), F.col(order).alias("o"))).alias("picked"))


def fastest(nodes: DataFrame, name: str, history: str, order: str, reserved: list[str] = ()) -> DataFrame:
    """The node of the lowest positive latency in its last measurement, reserved names aside."""
    last = F.try_element_at(F.col(history), F.lit(-1))
    return nodes.where(~F.col(name).isin(list(reserved)) & (last > 0)).agg(F.min_by(name, F.struct(last.alias("l"), F.col(order).alias("o"))).alias("picked"))


def failover(attempts: DataFrame, nodes: DataFrame, key: str, order: str, node: str, rows: str, node_order: str, least: int = 2) -> DataFrame:
    """(key, current, blocked, next): an attempt with fewer than ``least`` rows blocks its node for that key; next is the first node in order that is neither blocked nor current.

    The next node is among the first in order, one more than any key has blocked and in use; those are numbered, and a key's is the first number that it has not used, so
    that the pool never stands beside every key.
    """
    per = attempts.groupBy(key).agg(F.max_by(node, order).alias("current"), F.max_by(F.col(rows) < least, F.col(order)).alias("failed"), F.array_sort(F.collect_set(F.when(F.col(rows) < least, F.col(node)))).alias("blocked"))
    most = per.agg(F.coalesce(F.max(F.size("blocked")), F.lit(0))).first()[0] + 2
    places = nodes.select(F.struct(F.col(node_order).alias("o"), F.col(node).alias("n")).alias("_s")).orderBy("_s").limit(most)
    ranked = places.agg(F.array_sort(F.collect_list("_s")).alias("_all")).select(F.posexplode("_all").alias("_place", "_s")).select("_place", F.col("_s.n").alias("_n"))
    taken = per.select(key, F.explode(F.array_distinct(F.array_append("blocked", F.col("current")))).alias("_n")).join(ranked, "_n").groupBy(key).agg(F.array_sort(F.collect_list("_place")).alias("_taken"))
    free = F.array_min(F.array_except(F.sequence(F.lit(0), F.size("_taken")), F.col("_taken")))
    x = per.join(taken, key, "left").withColumn("_place", F.coalesce(free, F.lit(0)))
    return x.join(ranked.withColumnRenamed("_n", "_next"), "_place", "left").select(key, "current", "blocked", F.when(F.col("failed"), F.col("_next")).alias("next"))


def prefix_until(pages: DataFrame, part: str, order: str, stop: Column) -> DataFrame:
    """The rows of each part before the first one that stops it: what a circuit breaker keeps."""
    firsts = pages.where(stop).groupBy(part).agg(F.min(order).alias("_stop"))
    return pages.join(firsts, part, "left").where(F.col("_stop").isNull() | (F.col(order) < F.col("_stop"))).drop("_stop")


def with_stats(nodes: DataFrame, stats: DataFrame, name: str) -> DataFrame:
    """``nodes`` with their counters; a node that was never used has none."""
    return nodes.join(stats.select(name, "success", "fail"), name, "left").fillna(0, ["success", "fail"])


def available(nodes: DataFrame, most_failed: float = 0.8) -> DataFrame:
    """The nodes of which fewer than that share of uses failed; all of them, if none is left."""
    rate = F.col("fail") / F.greatest(F.col("success") + F.col("fail"), F.lit(1))
    ok = nodes.where(rate < most_failed)
    return nodes if ok.isEmpty() else ok


def round_robin(nodes: DataFrame, name: str, order: str, turn: int) -> str | None:
    """The node whose turn it is, in order; none of an empty pool. Only its place is counted, then one row is read."""
    n = nodes.count()
    if not n:
        return None
    row = nodes.orderBy(order).select(name).offset(turn % n).limit(1).first()
    return row[0]


def listing(nodes: DataFrame, name: str, order: str, limit: int = 50) -> DataFrame:
    """(name, rate): the first nodes of a pool with their successes and uses."""
    total = F.col("success") + F.col("fail")
    return nodes.orderBy(order).limit(limit).select(name, F.when(total > 0, F.format_string("%d/%d", F.col("success"), total)).otherwise("N/A").alias("rate"))


def save_pool(nodes: DataFrame, stats: DataFrame, settings: DataFrame, folder: str) -> None:
    """Nodes, counters and settings (keywords, subscriptions) as JSON lines."""
    for name, df in (("nodes", nodes), ("stats", stats), ("settings", settings)):
        df.write.mode("overwrite").json(f"{folder}/{name}")


def load_pool(spark: SparkSession, folder: str, schemas: dict[str, str]) -> dict[str, DataFrame]:
    """What ``save_pool`` wrote; a part that is missing is empty."""
    out = {}
    for name, schema in schemas.items():
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        there = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
        out[name] = spark.read.schema(schema).json(f"{folder}/{name}") if there else spark.createDataFrame([], schema)
    return out


def subscribed(pool: DataFrame, nodes: DataFrame, name: str, order: str, keywords: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The nodes of a subscription that the pool takes, and (added, excluded, known): how many it took, left out by keyword, and had already or twice."""
    new = insert_new(pool, nodes, name, order, list(keywords))
    out = excluded(F.col(name), list(keywords)) if keywords else F.lit(False)
    added = new.agg(F.count(F.lit(1)).alias("added"))
    counts = nodes.agg(F.count_if(out).alias("excluded"), F.count(F.lit(1)).alias("all"))
    return new, counts.join(F.broadcast(added), F.lit(True)).select("added", "excluded", (F.col("all") - F.col("excluded") - F.col("added")).alias("known"))


def dealt(requests: DataFrame, order: str, nodes: DataFrame, name: str = "name", start: int = 0) -> DataFrame:
    """``requests`` with the node that serves each: round robin over the nodes in the order of their names, all requests in one pass. Without nodes, none has any."""
    from .browse import numbered

    ring = numbered(nodes.select(F.col(name).alias("node")), [], ["node"]).withColumn("_k", F.col("place") - 1).drop("place")
    turn = F.pmod(F.col("place") - 1 + start, F.lit(max(1, ring.count())))
    return numbered(requests, [], [order]).withColumn("_k", turn).join(ring, "_k", "left").drop("_k", "place")

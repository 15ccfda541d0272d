"""Overlap, coverage and single-source reports; pool choices; log classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .resolve import keep_first


def overlap_pairs(df: DataFrame, key: str, source: str, order: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, source_a, source_b, ord_a, ord_b) of each pair of sources that share a key, by the first record of each, with what it carries as ``_a`` and ``_b``; sources are few, records many."""
    first = df.where(F.col(key).isNotNull()).groupBy(key, source).agg(F.min_by(F.struct(*carry, F.col(order).alias("o")), order).alias("r"))
    per_key = first.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(source).alias("s"), "r"))).alias("x")).where("size(x) > 1")
    a = per_key.select(key, "x", F.posexplode("x").alias("i", "a"))
    b = a.select(key, "a", F.explode(F.expr("slice(x, i + 2, size(x))")).alias("b"))
    return b.select(key, F.col("a.s").alias("source_a"), F.col("b.s").alias("source_b"), F.col("a.r.o").alias("ord_a"), F.col("b.r.o").alias("ord_b"), *(F.col(f"{s}.r.{c}").alias(f"{c}_{s}") for c in carry for s in "ab"))


def classify_overlap(tests: list[tuple[str, Column, Column]]) -> tuple[Column, Column]:
    """compatible, incompatible or unknown, and why: a difference of any (name, a, b) decides; without one, all must be known on both sides."""
    differ = F.filter(F.array(*(F.when(a != b, F.lit(f"{n} differs")) for n, a, b in tests)), lambda x: x.isNotNull())
    known = F.lit(True)
    for _, a, b in tests:
        known = known & a.isNotNull() & b.isNotNull()
    return F.when(F.size(differ) > 0, "incompatible").when(known, "compatible").otherwise("unknown"), F.array_join(differ, "; ")


def histogram(df: DataFrame, by: Column, name: str) -> DataFrame:
    return df.groupBy(by.alias(name)).agg(F.count(F.lit(1)).alias("rows"))


def rates(df: DataFrame, key: str, source: str) -> DataFrame:
    """How many keys one source alone has, how many several have, and the shares in per cent (half to even)."""
    per = df.groupBy(key, source).agg(F.count(F.lit(1)).alias("_n")).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    t = per.agg(F.count_if(F.col("n") == 1).alias("single"), F.count_if(F.col("n") > 1).alias("multi"), F.count(F.lit(1)).alias("total"))
    pct = lambda c: F.coalesce(F.bround(F.try_divide(F.col(c) * 100.0, F.col("total")), 2), F.lit(0.0))
    return t.select("single", "multi", "total", pct("single").alias("single_pct"), pct("multi").alias("multi_pct"))


def top(df: DataFrame, by: list[Column], n: int) -> DataFrame:
    return df.orderBy(*by).limit(n)


def classify_log(text: Column, rules: list[tuple[str, Column]], otherwise: str = "unknown") -> Column:
    """The first rule that holds; an empty log is ``empty``."""
    out = F.lit(otherwise)
    for name, test in reversed(rules):
        out = F.when(test, name).otherwise(out)
    return F.when(F.length(F.trim(F.coalesce(text, F.lit("")))) == 0, "empty").otherwise(out)


def pick(df: DataFrame, name: str, score: Column, order: str, group: list[str] | None = None) -> DataFrame:
    """The name of the least score, ties by order, in each group."""
    return df.groupBy(*(group or [])).agg(F.min_by(name, F.struct(score.alias("s"), F.col(order).alias("o"))).alias("picked"))


def newest(df: DataFrame, keys: list[str], valid: Column, created: str, tie: str) -> DataFrame:
    """The newest valid row of each key."""
    return keep_first(df.where(valid), keys, [(-F.unix_micros(F.col(created).cast("timestamp"))).alias("c"), F.col(tie).alias("t")])


def merge_cursors(df: DataFrame, key: str, order: str, items: str, page: str, done: str) -> DataFrame:
    """Cursors of one key as one: different items in order, the furthest page, complete if all are."""
    once = df.select(key, F.col(order).alias("_o"), F.posexplode(items).alias("_i", "_x")).groupBy(key, "_x").agg(F.min(F.struct("_o", "_i")).alias("_at"))
    united = once.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_x"))), lambda e: e["_x"]).alias("items"))
    rest = df.groupBy(key).agg(F.max(page).alias("page"), F.bool_and(done).alias("complete"))
    return rest.join(united, key, "left").select(key, F.coalesce("items", F.array().cast("array<string>")).alias("items"), "page", "complete")


def most_common(df: DataFrame, by: Column, name: str, order: str, n: int) -> DataFrame:
    """The ``n`` most frequent values with their counts; of equals the one that came first."""
    return df.groupBy(by.alias(name)).agg(F.count(F.lit(1)).alias("rows"), F.min(order).alias("_first")).orderBy(F.desc("rows"), "_first").limit(n).drop("_first")


def merge_bundles(states: DataFrame, key: str) -> DataFrame:
    """Conflicting cursors of one key as one. ``states``: key, side (0 theirs, 1 ours, 2 current), items, skipped (a map), brand_index, page, plan, complete, total.

    Items are united, the current side's first; what was skipped is that of the last side that says so. The place is never made up of two: the earliest of those with the same plan of
    brands, or the beginning where plans differ. It is complete if every side is. There are three sides at most, so a key's states are few.
    """
    sides = F.array_sort(F.collect_list(F.struct("side", "items", F.map_entries("skipped").alias("skipped"), "brand_index", "page", "plan", "complete", "total")))
    x = states.groupBy(key).agg(sides.alias("s")).withColumn("placed", F.filter("s", lambda v: v["brand_index"].isNotNull() & v["page"].isNotNull()))
    items = F.array_distinct(F.flatten(F.reverse(F.transform("s", lambda v: F.coalesce(v["items"], F.array().cast("array<string>"))))))
    pairs = F.flatten(F.transform("s", lambda v: F.coalesce(v["skipped"], F.expr("cast(array() as array<struct<key:string,value:string>>)"))))
    skipped = F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["key"]), F.map_from_entries(F.array(e))))
    plans = F.transform("placed", lambda v: F.coalesce(v["plan"], F.array().cast("array<string>")))
    agree = (F.size("placed") <= 1) | ((F.size(F.array_distinct(plans)) == 1) & (F.size(plans[0]) > 0))
    first = F.array_min(F.transform("placed", lambda v: F.struct(v["brand_index"], v["page"])))
    place = F.when(agree, first).otherwise(F.struct(F.lit(0).alias("brand_index"), F.lit(1).alias("page")))
    out = x.select(key, items.alias("items"), skipped.alias("skipped"), place.alias("p"), F.forall("s", lambda v: F.coalesce(v["complete"], F.lit(False))).alias("complete"), F.coalesce(F.array_max(F.transform("s", lambda v: v["total"])), F.size(items)).alias("total"))
    return out.select(key, "items", "skipped", F.col("p.brand_index").alias("brand_index"), F.col("p.page").alias("page"), "complete", "total")

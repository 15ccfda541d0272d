"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted-shingle similarity.

A document's windows are as long as the benchmark item they are held against. Each window and each item gets a SimHash of 64
bits over its shingles of five words. Fingerprints are cut into ``RADIUS`` + 1 blocks; two within ``RADIUS`` bits have an equal block,
so a join on equal blocks finds them all. Each candidate is then verified by the weighted similarity of the
shingles themselves: sum of the smaller over sum of the larger multiplicities, 0.8 or more.

Windows are fingerprinted where they can matter: a window that shares no shingle with an item has similarity 0 to it, and one that shares less
than 0.8 of the item's shingles stays below 0.8. So a document's windows are those around its shared shingles, for items of which it has
enough; they start where a shared shingle puts the item's start, and meet that item's blocks only: never all windows
all items, however many of either there are. Shingles are fetched for pairs whose fingerprints are near enough.

At the threshold fingerprints differ in 10 bits on average with a standard deviation of 3; a radius of 15 keeps 98 in 100 pairs
there and nearly all above. Everything is native expressions. Words are runs of letters and digits, lower-cased.

Defined results: a null text is the empty text; an item of fewer than five words is one shingle of its words and found where the document has
these words in a row; items without words match nothing; rows of one doc_id are taken together, and so are rows of one item_id that repeat; null ids match
nothing; empty tables give an empty table; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bounded, materialise, table

WIDTH, RADIUS, BITS, SIMILARITY = 5, 15, 4, 0.8


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0)


def _shingles(hashes: Column) -> Column:
    """Hashes of the shingles of an array of word hashes; fewer words than a shingle: one; no words: none."""
    n = F.size(hashes)
    several = F.transform(F.sequence(F.lit(1), n - WIDTH + 1), lambda i: F.xxhash64(*(F.get(hashes, i + (k - 1)) for k in range(WIDTH))))
    return F.when(n >= WIDTH, several).when(n > 0, F.array(F.xxhash64(hashes))).otherwise(F.expr("cast(array() as array<bigint>)"))


def with_shingles(df: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """(keys, sh): the shingles of each text in order."""
    hashes = F.transform(words(F.col(text)), lambda w: F.xxhash64(w))
    return df.select(*keys, F.element_at(F.transform(F.array(hashes), _shingles), 1).alias("sh"))  # in an array, so that the hashes are made once


def _short_matches(docs: DataFrame, own: DataFrame, doc_key: str, text: str) -> DataFrame | None:
    """(doc, item, start) of each passage that is an item of fewer than WIDTH words; nothing if there is no such item."""
    widths = sorted(r["n"] for r in own.where(F.col("n") < WIDTH).select("n").distinct().collect())
    if not widths:
        return None
    hashes = docs.select(F.col(doc_key).alias("doc"), F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("hs"))
    at = lambda k: F.when(F.size("hs") >= k, F.transform(F.sequence(F.lit(0), F.size("hs") - k), lambda i: F.struct(i.alias("start"), F.lit(k).alias("n"), F.xxhash64(F.slice("hs", i + 1, k)).alias("h"))))
    runs = hashes.select("doc", F.explode(F.concat(*(F.coalesce(at(k), F.expr("cast(array() as array<struct<start:int,n:int,h:bigint>>)")) for k in widths))).alias("r")).select("doc", "r.*")
    items = materialise(own.where(F.col("n") < WIDTH).select("item", "n", F.col("sh")[0].alias("h")), "benchmark-short")
    return runs.join(bounded(items), ["n", "h"]).groupBy("doc", "item").agg(F.min("start").alias("start"))


def simhash(sh: Column) -> Column:
    """Bits that are set in more than half of the hashes."""
    bit = lambda b: F.aggregate(sh, F.lit(0), lambda acc, h: acc + F.getbit(h, b).cast("int"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), lambda acc, b: acc.bitwiseOR(F.when(bit(b) * 2 > F.size(sh), F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))))


def similarity(a: Column, b: Column) -> Column:
    """Of two arrays with repeats: sum of smaller over sum of larger multiplicities."""
    count = lambda xs, h: F.size(F.filter(xs, lambda x: x == h))
    common = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda acc, h: acc + F.least(count(a, h), count(b, h)))
    return F.when(F.size(a) + F.size(b) > 0, common / (F.size(a) + F.size(b) - common)).otherwise(0.0)


def _blocks(fp: str) -> Column:
    mask = (1 << BITS) - 1
    return F.expr(f"transform(sequence(0, {RADIUS}), i -> struct(i as block, cast(shiftrightunsigned({fp}, i * {BITS}) & {mask} as int) as value))")


def matches(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_key, item_key, similarity, start_word, bits) of each document that has a window similar to an item: the best window."""
    own = with_shingles(items.withColumn("n", F.size(words(F.col(text)))), item_key, "n", text=text).where("size(sh) > 0")
    own = materialise(own.select(F.col(item_key).alias("item"), "n", "sh", F.size("sh").alias("len"), simhash(F.col("sh")).alias("fp")), "benchmark-items")
    short = _short_matches(docs, own, doc_key, text)
    own = own.where(F.col("n") >= WIDTH)
    grams = own.select("item", "len", F.posexplode("sh").alias("ipos", "h"))
    grams = materialise(grams, "benchmark-shingles")
    texts = with_shingles(docs, doc_key, text=text).withColumnRenamed(doc_key, "doc")
    hits = texts.select("doc", F.posexplode("sh").alias("pos", "h")).join(bounded(grams), "h")
    hits = materialise(hits.select("doc", "item", "len", "pos", "ipos").distinct(), "benchmark-hits")
    # A window of similarity s has at least s of the item's shingles.
    enough = hits.groupBy("doc", "item", "len").agg(F.count_distinct("ipos").alias("got")).where(F.col("got") >= SIMILARITY * F.col("len")).select("doc", "item", "len")
    starts = materialise(hits.join(enough, ["doc", "item", "len"], "left_semi").select("doc", "item", "len", F.greatest(F.col("pos") - F.col("ipos"), F.lit(0)).alias("start")).distinct(), "benchmark-starts")
    found = materialise(starts.select("doc").distinct(), "benchmark-found")
    again = with_shingles(docs.join(bounded(found.withColumnRenamed("doc", doc_key)), doc_key, "left_semi"), doc_key, text=text).withColumnRenamed(doc_key, "doc")
    windows = starts.join(again, "doc").select("doc", "start", "item", "len", F.expr("slice(sh, start + 1, len)").alias("win")).where("size(win) > 0")
    windows = materialise(windows.select("*", simhash(F.col("win")).alias("wfp")), "benchmark-windows")
    probes = windows.select("doc", "start", "item", "wfp", F.explode(_blocks("wfp")).alias("b")).select("doc", "start", "item", "wfp", "b.*")
    index = materialise(own.select("item", "fp", F.explode(_blocks("fp")).alias("b")).select("item", "fp", "b.*"), "benchmark-index")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("wfp")))
    pairs = probes.join(bounded(index), ["item", "block", "value"]).where(near <= RADIUS).groupBy("doc", "start", "item").agg(F.min(near).alias("bits"))
    texts_ = windows.select("doc", "start", "item", "win").join(pairs, ["doc", "start", "item"])
    items_ = own.select("item", "sh")
    checked = texts_.join(F.broadcast(items_) if grams.count() <= BROADCAST_ROWS else items_, "item").withColumn("similarity", similarity(F.col("win"), F.col("sh"))).where(F.col("similarity") >= SIMILARITY)
    best = checked.groupBy("doc", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), (-F.col("bits")).alias("less"))).alias("m"))
    out = best.select(F.col("doc").alias(doc_key), F.col("item").alias(item_key), F.col("m.similarity").alias("similarity"), (-F.col("m.back")).cast("long").alias("start_word"), (-F.col("m.less")).cast("long").alias("bits"))
    return out if short is None else out.unionAll(short.select(F.col("doc").alias(doc_key), F.col("item").alias(item_key), F.lit(1.0), F.col("start").cast("long"), F.lit(0).cast("long")))


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without those that have a benchmark item."""
    leaks = materialise(matches(docs, items).select("doc_id").distinct(), "benchmark-leaks")
    return docs.join(bounded(leaks), "doc_id", "left_anti")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op5_benchmark_decontamination": op5}
ORACLE_SQL: dict[str, str] = {}

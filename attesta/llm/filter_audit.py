"""Filter interaction audit: what each filter of a chain removes, in every order in which the filters can be applied.

Filters are failure conditions. A document's failures are one integer, a bit for each filter; documents are counted by part and by that
mask, so that what follows depends on the number of parts and masks alone. Each mask cell is unpivoted against the steps of all
orders; a running bit-or over a cell's steps tells what an earlier step has removed; conditional sums over the cells give the
metrics of a step, and totals over the window of a part and a filter give the filter's removals in all orders.

No text is shuffled, but 40 bytes of it: equal texts are told by their SHA-256 digests. Rows of equal text are summed up before they
meet, by part, labels and failures, so that a text or a part that a third of all documents have does not gather in one task.

Defined results: a null text is the empty text, and has no words; a null part is the empty string. A null doc_id has no smaller one and
is smaller than none: it never fails for being a repetition, and has no labels. Rows with one doc_id are documents of their own, all of
them have its labels, and none repeats the other. If several labels of a doc_id differ, one that is 1 counts. An empty table gives an
empty table. Only the columns doc_id, text and the part are read, so that others may have any name.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

BLANKS = r"[\x20\x09-\x0D]+"
METRICS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(text: Column, words: Column) -> dict[str, Column]:
    """The conditions under which a text itself fails, by the filters' letters: under 50 words, few different words, many capitals, symbols."""
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"A": n < 50, "B": 100 * distinct < 65 * n, "C": 100 * capitals > 5 * F.length(text), "D": text.rlike(r"[#$%&*|]")}


def masked(docs: DataFrame, part: str = "source", repeated: str = "E", conditions=failures) -> DataFrame:
    """(doc_id, part, text_key, mask): bit k of mask is set if the k-th filter, in the order of their letters, fails; ``repeated`` is still open."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    fails = conditions(F.col("text"), F.col("words"))
    bits = {f: 1 << k for k, f in enumerate(sorted([*fails, repeated]))}
    mask = sum((F.coalesce(c.cast("int"), F.lit(0)) * bits[f] for f, c in fails.items()), F.lit(0))
    slim = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    slim = slim.withColumn("words", F.filter(F.split("text", BLANKS, -1), lambda x: x != ""))
    return slim.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("text_key"), mask.cast("int").alias("mask"))


def cells(rows: DataFrame, labels: DataFrame, repeat_bit: int) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and failures, with ``repeat_bit`` set where a smaller doc_id has the same text."""
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    no = F.lit(False)
    kind = ["text_key", "part", "mask", "good", "toxic"]
    # By kind: rows, the smallest doc_id, and the rows that have it (a doc_id can have several). One shuffle serves the join and the first count.
    ids = rows.where("doc_id IS NOT NULL").join(marks, "doc_id", "left").withColumns({k: F.coalesce(k, no) for k in ("good", "toxic")}).groupBy(*kind, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    own = ids.groupBy(*kind).agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("least"))
    own = own.unionByName(rows.where("doc_id IS NULL").withColumns({"good": no, "toxic": no}).groupBy(*kind).agg(F.count(F.lit(1)).alias("n")), allowMissingColumns=True)
    firsts = own.withColumn("first", F.min("least.doc_id").over(Window.partitionBy("text_key")))
    new = F.when(F.col("least").isNull(), F.col("n")).when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    both = F.array(F.struct(F.col("mask"), new.alias("n")), F.struct((F.col("mask") + repeat_bit).alias("mask"), (F.col("n") - new).alias("n")))
    split = firsts.select("part", "good", "toxic", F.explode(both).alias("c")).select("part", "good", "toxic", "c.*").where("n > 0")
    told = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return split.groupBy("part", "mask").agg(F.sum("n").alias("n"), told("good"), told("toxic"))


def audit(counts: DataFrame, filters: str) -> DataFrame:
    """Per part, order and step the metrics, from cells (part, mask, n, good, toxic); filters: their letters, that of bit 0 first."""
    steps = F.array(*(F.struct(F.lit("".join(o)).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(1 << filters.index(f)).alias("bit")) for o in permutations(filters) for k, f in enumerate(o)))
    long = counts.select("*", F.inline(steps))
    fails = F.col("mask").bitwiseAND(F.col("bit"))
    before = Window.partitionBy("part", "mask", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    long = long.withColumn("earlier", F.coalesce(F.bit_or(fails).over(before), F.lit(0))).withColumn("fails", fails)
    fail, gone = F.col("fails") != 0, F.col("earlier") != 0
    total = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0))
    here = fail & ~gone
    out = long.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fail & ~gone).alias("kept"), total(here).alias("removed"), total(fail & gone).alias("redundant"), total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(here, "good").alias("good_lost"), total(here, "toxic").alias("toxic_lost"))
    out = out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit")))
    return out.select("part", "filter_order", "step", *(F.col(m).cast("long").alias(m) for m in METRICS))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = masked(table(spark, sf_dir, "documents"))
    return audit(cells(rows, table(spark, sf_dir, "labels"), 1 << 4), "ABCDE")


QUERIES = {"op12_filter_audit": op12}
ORACLE_SQL = {"op12_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
m AS (SELECT part, (CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN doc_id > first THEN 16 ELSE 0 END) AS mask,
    coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic FROM w LEFT JOIN labels USING (doc_id)),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM m GROUP BY ALL),
r AS (SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed, sum(CASE WHEN mask & earlier <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN g ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN x ELSE 0 END) AS toxic_lost FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""}

"""Preference formatting: pairs of conversations become one prompt and two completions with loss masks.

The longest run of equal first turns (role and text) of the chosen and the rejected conversation is rendered once, as the
prompt. What follows is rendered as each side's completion, and a mask gives the spans of it that carry loss:
the text and the end mark of assistant turns. Spans are ``start-end`` in characters of the completion, end exclusive.

A conversation is rendered into one value, so its turns come together in one row; conversations that share
a first turn, however many, do not: pairs are a one-to-one table, and nothing is grouped by content.

Defined results: turns are ordered by number, role, text; a null role is "user", a null text is empty; repeated turns
stay; a pair with a missing side gives no row; a side that is a prefix of the other has an empty completion; empty
tables give empty tables; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

END = "<|end|>\n"


def neighbour_pairs(turns: DataFrame) -> Column:
    """The pair of a conversation where no pairs are given: ids 2k (chosen) and 2k+1 (rejected)."""
    return F.shiftright("conv_id", 1)


def _rendered(t: Column) -> Column:
    return F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit(END))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _spans(turns: Column) -> Column:
    """Spans of assistant turns, from a fold that carries the position."""
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        end = acc["at"] + F.length(_rendered(t))
        span = F.concat_ws("-", (acc["at"] + F.length(t["role"]) + 5).cast("string"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(t["role"] == "assistant", F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: F.array_join(acc["spans"], ","))


def preferences(turns: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """One row per pair. ``turns``: conv_id, turn, role, text. ``pairs``: pair_id, chosen_id, rejected_id; by default neighbouring ids."""
    turns = turns.select("conv_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    if pairs is None:
        sided = turns.select(neighbour_pairs(turns).alias("pair_id"), (F.col("conv_id") - 2 * F.shiftright("conv_id", 1)).alias("side"), "*")
    else:
        sides = pairs.select("pair_id", F.explode(F.array(F.struct(F.lit(0).cast("bigint").alias("side"), F.col("chosen_id").alias("conv_id")), F.struct(F.lit(1).cast("bigint").alias("side"), F.col("rejected_id").alias("conv_id")))).alias("x")).select("pair_id", "x.*")
        sided = turns.join(sides, "conv_id")
    grouped = sided.groupBy("pair_id").agg(F.array_sort(F.collect_list(F.struct("side", "turn", "role", "text", "conv_id"))).alias("all"))
    both = grouped.select("pair_id", F.filter("all", lambda t: t["side"] == 0).alias("a"), F.filter("all", lambda t: t["side"] == 1).alias("b")).where("size(a) > 0 AND size(b) > 0")
    same = F.zip_with("a", "b", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    both = both.withColumn("cut", F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, F.size("a").cast("long")).cast("int"))
    both = both.select("*", F.slice("a", 1, F.col("cut")).alias("p"), F.slice("a", F.col("cut") + 1, F.size("a") + 1).alias("c"), F.slice("b", F.col("cut") + 1, F.size("b") + 1).alias("r"))
    return both.select(
        "pair_id", F.col("a")[0]["conv_id"].alias("chosen_id"), F.col("b")[0]["conv_id"].alias("rejected_id"), F.col("cut").cast("long").alias("n_prompt_turns"), _text(F.col("p")).alias("prompt"),
        _text(F.col("c")).alias("chosen"), _text(F.col("r")).alias("rejected"), _spans(F.col("c")).alias("chosen_mask"), _spans(F.col("r")).alias("rejected_mask"),
    )


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences(table(spark, sf_dir, "conversations"))


QUERIES = {"op10_preference_formatting": op10}
ORACLE_SQL = {"op10_preference_formatting": r"""
WITH t AS (
  SELECT conv_id >> 1 AS pair_id, conv_id & 1 AS side, conv_id, coalesce(role, 'user') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM conversations
), pairs AS (SELECT pair_id FROM t GROUP BY pair_id HAVING count(DISTINCT side) = 2),
diff AS (
  SELECT pair_id, min(pos) AS first_diff FROM (
    SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.pos, b.pos) AS pos, a.role = b.role AND a.text = b.text AS same
    FROM (SELECT * FROM t WHERE side = 0) a FULL JOIN (SELECT * FROM t WHERE side = 1) b ON a.pair_id = b.pair_id AND a.pos = b.pos
  ) WHERE same IS NOT TRUE GROUP BY pair_id
), cut AS (
  SELECT p.pair_id, coalesce(d.first_diff - 1, (SELECT max(pos) FROM t WHERE t.pair_id = p.pair_id AND side = 0)) AS cut
  FROM pairs p LEFT JOIN diff d ON d.pair_id = p.pair_id
), r AS (
  SELECT t.*, cut, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS line FROM t JOIN cut USING (pair_id)
), e AS (
  SELECT *, sum(CASE WHEN pos > cut THEN length(line) ELSE 0 END) OVER (PARTITION BY pair_id, side ORDER BY pos) AS stop FROM r
), s AS (SELECT *, CASE WHEN role = 'assistant' THEN (stop - length(line) + length(role) + 5)::BIGINT || '-' || stop::BIGINT END AS span FROM e)
SELECT pair_id, max(conv_id) FILTER (side = 0) AS chosen_id, max(conv_id) FILTER (side = 1) AS rejected_id, max(cut) AS n_prompt_turns,
  coalesce(string_agg(line, '' ORDER BY pos) FILTER (side = 0 AND pos <= cut), '') AS prompt,
  coalesce(string_agg(line, '' ORDER BY pos) FILTER (side = 0 AND pos > cut), '') AS chosen,
  coalesce(string_agg(line, '' ORDER BY pos) FILTER (side = 1 AND pos > cut), '') AS rejected,
  coalesce(string_agg(span, ',' ORDER BY pos) FILTER (side = 0 AND pos > cut), '') AS chosen_mask,
  coalesce(string_agg(span, ',' ORDER BY pos) FILTER (side = 1 AND pos > cut), '') AS rejected_mask
FROM s GROUP BY pair_id
"""}

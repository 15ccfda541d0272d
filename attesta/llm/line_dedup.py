"""Line dedup: drop the lines that a large share of a site's pages have.

Per host, the pages that contain a line are divided by the host's pages. A line on more than ``max_ratio`` of the
pages and on at least ``min_pages`` of them is boilerplate; every occurrence of it on that host goes.
Lines are compared without the blanks around them; blank lines stay and are never counted.

Only 128-bit line hashes are shuffled, counted on the map side first, so that neither a host with a third of all pages
nor a line on each of them meets in one task. A host has at most (mean lines per page) / max_ratio such lines.

Defined results: a null text stays null; a null host is a host of its own; a repeated row is another page; a line
repeated on a page counts once; a text all of whose lines go becomes empty; an empty table gives an empty table;
other columns pass through untouched, but for columns named ld_lines and ld_dropped, which the counts replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialise, table

BLANKS = " \t\r"


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)))


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2"))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = 0.05, min_pages: int = 5) -> DataFrame:
    """(host, key) of the lines to drop; key is the hash of a line."""
    pages = docs.select(F.coalesce(F.col(host).cast("string"), F.lit("\x00")).alias("host"), F.col(text).alias("text"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    keys = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: x != ""), _key))
    counts = pages.select("host", F.explode(keys).alias("key")).groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    return counts.join(totals, "host").where(F.col("n") > max_ratio * F.col("pages")).select("host", "key", "n", "pages")


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = 0.05, min_pages: int = 5) -> DataFrame:
    """``docs`` with the lines dropped from ``text``, and the columns ld_lines and ld_dropped."""
    found = materialise(boilerplate(docs, host, text, max_ratio, min_pages), "boilerplate-lines")
    sets = found.groupBy("host").agg(F.collect_set("key").alias("ld_keys")).select(F.col("host").alias("ld_host"), "ld_keys", F.transform("ld_keys", lambda k: k["h1"]).alias("ld_h1"))
    if found.count() <= BROADCAST_ROWS:
        sets = F.broadcast(sets)
    names = {c: f"in_{c}" for c in docs.columns}
    t = F.col(f"in_{text}")
    key = lambda x: _key(F.btrim(x, F.lit(BLANKS)))
    # The host's lines that the page has are found by a set of numbers; only those are compared whole.
    own = F.array_intersect(F.transform(F.split(t, "\n", -1), lambda x: F.xxhash64(F.btrim(x, F.lit(BLANKS)))), "ld_h1")
    out = docs.withColumnsRenamed(names).join(sets, F.coalesce(F.col(f"in_{host}").cast("string"), F.lit("\x00")) == F.col("ld_host"), "left").withColumn("ld_own", own)
    raw = F.split(t, "\n", -1)
    few = F.filter(raw, lambda x: ~(F.array_contains("ld_own", F.xxhash64(F.btrim(x, F.lit(BLANKS)))) & F.array_contains("ld_keys", key(x))))
    out = out.withColumn("ld_kept", F.when(F.col("ld_keys").isNull() | (F.size("ld_own") == 0), raw).otherwise(few))
    new = F.when(F.col("ld_keys").isNull(), t).otherwise(F.array_join("ld_kept", "\n"))
    others = [F.col(v).alias(c) if c != text else new.alias(text) for c, v in names.items() if c not in ("ld_lines", "ld_dropped")]
    lines = F.when(t.isNull(), 0).otherwise(F.size(raw))
    kept = F.when(t.isNull(), 0).otherwise(F.size("ld_kept"))
    return out.select(*others, lines.cast("long").alias("ld_lines"), (lines - kept).cast("long").alias("ld_dropped"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "text", F.col("ld_lines").alias("n_lines"), F.col("ld_dropped").alias("n_dropped"))


QUERIES = {"op1_line_dedup": op1}
ORACLE_SQL = {"op1_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents
), trimmed AS (SELECT *, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM lines),
counts AS (SELECT source, line, count(DISTINCT doc_id) AS n FROM trimmed WHERE line <> '' GROUP BY ALL),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
bad AS (SELECT source, line FROM counts JOIN totals USING (source) WHERE n >= 5 AND n > 0.05 * pages),
marked AS (SELECT t.*, b.line IS NOT NULL AS gone FROM trimmed t LEFT JOIN bad b ON t.source = b.source AND t.line = b.line)
SELECT doc_id, source, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
  count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped
FROM marked GROUP BY doc_id, source
"""}

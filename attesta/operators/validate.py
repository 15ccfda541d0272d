"""Checks over files, lines and definitions: policies, scans, blocks, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def by_prefix(name: Column, policy: list[tuple[str, int]]) -> Column:
    """The value of the first prefix (prefix, value) that a name begins with; null for unknown names."""
    return F.coalesce(*(F.when(name.startswith(p), F.lit(v)) for p, v in policy))


def policy_error(name: Column, value: Column, policy: list[tuple[str, int]]) -> Column:
    """What is wrong with a value under a policy by prefix; null if nothing."""
    want = by_prefix(name, policy)
    return (F.when(want.isNull(), F.concat(F.lit("unknown name: "), name)).when(value.isNull(), F.concat(name, F.lit(": the value is missing")))
            .when(value != want, F.concat(name, F.lit(": must be "), want.cast("string"), F.lit(", got "), value.cast("string"))))


def lines_of(files: DataFrame, path: str, text: str) -> DataFrame:
    """(path, line_no from 1, line)."""
    return files.select(path, F.posexplode(F.split(F.col(text), r"\r?\n", -1)).alias("_i", "line")).select(path, (F.col("_i") + 1).alias("line_no"), "line")


def scan_files(files: DataFrame, path: str, text: str, needed: list[str], wanted: str, exempt: str) -> DataFrame:
    """(path, line_no, line): lines that match ``wanted`` and not ``exempt``, of files in which every pattern of ``needed`` occurs somewhere. Files are judged whole and lines exploded only of those that pass; no shuffle."""
    hot = files
    for p in needed:
        hot = hot.where(F.col(text).rlike(f"(?m){p}"))
    return lines_of(hot, path, text).where(F.col("line").rlike(wanted) & ~F.col("line").rlike(exempt)).select(path, "line_no", F.trim("line").alias("line"))


def walked(path: Column, skipped: list[str], kinds: list[str]) -> Column:
    """Whether a walk visits a path: none of its parts is skipped, and its ending is one of the kinds."""
    parts = F.split(path, "/")
    return ~F.arrays_overlap(parts, F.array(*map(F.lit, skipped))) & path.rlike(rf"\.(?:{'|'.join(kinds)})$")


def skipped(path: Column, patterns: list[str]) -> Column:
    """Whether any pattern is found in a path, with forward slashes and in any case."""
    return F.replace(path, F.lit("\\"), F.lit("/")).rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns))


def blocks(lines: DataFrame, path: str, order: str, line: str, marker: str) -> DataFrame:
    """(path, start, block): the list item (``- name:`` or ``- uses:``, by indentation) around each line that matches ``marker``.

    An item runs to the next line that is indented less, or as much and is an item itself. Files are windows of their own.
    """
    indent = F.length(F.regexp_extract(line, r"^(\s*)", 1))
    blank = F.trim(line).rlike(r"^(?:#.*)?$")
    w = W.partitionBy(path).orderBy(order)
    head = F.when(F.col(line).rlike(r"^\s*-\s+(?:name|uses):"), F.struct(F.col(order).alias("at"), indent.alias("indent")))
    marked = lines.withColumn("_indent", indent).withColumn("_blank", blank).withColumn("_head", F.last(head, ignorenulls=True).over(w))
    # A line outside the indentation of the item before it ends that item.
    out = ~F.col("_blank") & (F.col(order) > F.col("_head.at")) & ((F.col("_indent") < F.col("_head.indent")) | ((F.col("_indent") == F.col("_head.indent")) & F.col(line).rlike(r"^\s*-\s+")))
    ended = F.max(F.when(out, 1).otherwise(0)).over(W.partitionBy(path, "_head").orderBy(order))
    inside = marked.where(F.col("_head").isNotNull()).withColumn("_ended", ended).where("_ended = 0")
    grouped = inside.groupBy(path, F.col("_head.at").alias("start")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, line))), lambda x: x[line]), "\n").alias("block"))
    return grouped.where(F.col("block").rlike(marker))


def changed_definitions(before: DataFrame, after: DataFrame, name: str, body: str) -> DataFrame:
    """(name, error): definitions that are gone or changed; new ones are allowed."""
    a, b = before.select(name, F.col(body).alias("_a")), after.select(name, F.col(body).alias("_b"), F.lit(True).alias("_has"))
    joined = a.join(b, name, "left")
    return joined.select(name, F.when(F.col("_has").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed").alias("error")).where("error IS NOT NULL")


def manifest_differences(expected: DataFrame, actual: DataFrame, path: str, fields: list[str]) -> DataFrame:
    """(path, error): files that one manifest lacks, or whose fields (kind, mode, digest) differ."""
    a = expected.select(path, F.struct(*fields).alias("_a"), F.lit(True).alias("_in_a"))
    b = actual.select(path, F.struct(*fields).alias("_b"), F.lit(True).alias("_in_b"))
    why = F.when(F.col("_in_a").isNull(), "unexpected").when(F.col("_in_b").isNull(), "missing").when(~F.col("_a").eqNullSafe(F.col("_b")), "different")
    return a.join(b, path, "full").select(path, why.alias("error")).where("error IS NOT NULL")


def errors(rules: list[tuple[str, Column]]) -> Column:
    """The messages of the rules (message, condition) that do not hold for certain, in order."""
    return F.filter(F.array(*(F.when(F.coalesce(ok, F.lit(False)), F.lit(None).cast("string")).otherwise(m) for m, ok in rules)), lambda x: x.isNotNull())


def http_failure(status: Column) -> Column:
    """The class of an HTTP status: none is a network failure."""
    return F.when(status.isNull(), "network").when(status.isin(401, 403), "auth").when(status == 429, "rate_limit").when(status >= 500, "server").when(status >= 400, "request").otherwise("ok")

"""Payloads that are one JSON document, read in splits.

The file is scanned in pieces that end with a closing brace, so that Spark splits it as it splits lines. Whether a split begins inside a string, and how deep, follows
from what the splits before it hold: each is summed up under both beginnings, and the sums, a row for each split, are put together in order. A second scan cuts each split where a
value of the list ends. Values that lie in one split never leave their task; those that cross into the next are joined. What is left, the document with each
stretch of its lists' values replaced by a mark, is small, and is parsed whole: it tells which member holds the records, and whether the document is JSON.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.staging import staged

#: Splits whose sums are broadcast; beyond that they are joined by a shuffle. A row of them is some 200 bytes.
SPLITS = 1_000_000
#: Pieces outside lists, beyond which a document is read whole: its shape is then not that of a list of records.
OUTSIDE = 10_000
MEMBER = r'^[ \t\r\n]*,[ \t\r\n]*"(?:[^"\\]|\\.)*"[ \t\r\n]*:'
LEVEL = np.zeros(256, np.int64)
LEVEL[list(b"{[")], LEVEL[list(b"}]")] = 1, -1
SUMS = "path string, block long, flips long, delta_outside long, delta_inside long, head string, bytes long, size long"
CUTS = "path string, block long, n long, text binary, at long, low long, commas long, seen long, starts boolean, ended boolean"


def json_document(text: Column) -> Column:
    """A text as a variant, null where it is not one JSON value from end to end. The parser stops after a value; what follows it cannot be right inside both an array and an object."""
    inside = F.try_parse_json(F.concat(F.lit('{"d":'), text, F.lit("}")))
    return F.when(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull(), F.try_variant_get(inside, "$.d", "variant"))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch, bytes]]:
    """((path, block), rows, bytes) of the rows of one split in one batch, with the braces that the scan took off."""
    for batch in batches:
        keys = list(zip(batch["path"].to_pylist(), batch["block"].to_pylist(), strict=True))
        at = 0
        for key, same in itertools.groupby(keys):
            rows = batch.slice(at, n := len(list(same)))
            at += n
            yield key, rows, b"}".join(rows["text"].to_pylist()) + b"}"


def _levels(blob: bytes, inside: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bytes without escapes, which of them are outside strings, and whether the end is inside one. No escape crosses a piece."""
    flat = np.frombuffer(re.sub(rb"\\.", b"__", blob, flags=re.DOTALL), np.uint8)
    quotes = np.cumsum(flat == 34) + inside
    return flat, quotes % 2 == 0, int(quotes[-1] % 2)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each split: whether its quotes are odd, how much deeper it ends if it begins outside or inside a string, its first character that is no space."""
    for (path, block), stretches in itertools.groupby(_stretches(batches), key=lambda s: s[0]):
        inside, delta, size, head = 0, [0, 0], 0, b""
        for _, rows, blob in stretches:
            flat, outside, inside = _levels(blob, inside)
            delta[0] += int(LEVEL[flat[outside]].sum())
            delta[1] += int(LEVEL[flat[~outside]].sum())
            size, head, whole = size + len(blob), head or blob.lstrip(b" \t\r\n")[:1], rows["size"][0].as_py()
        yield pa.RecordBatch.from_pydict({"path": [path], "block": [block], "flips": [inside], "delta_outside": [delta[0]], "delta_inside": [delta[1]], "head": [head.decode("latin-1") or None], "bytes": [size], "size": [whole]})


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts between the ends of values at the depth of the list's records, or above it, and what is left at both ends of a split."""
    names = [c.split()[0] for c in CUTS.split(", ")]
    for (path, block), stretches in itertools.groupby(_stretches(batches), key=lambda s: s[0]):
        first, n, seen = True, 0, 0
        for _, rows, blob in stretches:
            if first:
                inside, depth, base = (rows[c][0].as_py() for c in ("inside", "depth", "base"))
                starts, held, at, low, commas, first = inside == 0 and depth <= base, [], depth, depth, 0, False
            flat, outside, inside = _levels(blob, inside)
            depths = np.cumsum(np.where(outside, LEVEL[flat], 0)) + depth
            ends = np.flatnonzero((flat == 125) & outside & (depths <= base)) + 1
            marks = np.cumsum((flat == 44) & outside & (depths == base))
            out, before = [], 0
            for s, e in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True) if len(ends) else ():
                held.append(blob[s:e])
                low, commas, before = min(low, int(depths[s:e].min())), commas + int(marks[e - 1]) - before, int(marks[e - 1])
                out.append((path, block, n, b"".join(held), at, low, commas, seen, starts, True))
                n, seen, starts, held, at, low, commas = n + 1, seen + commas, True, [], int(depths[e - 1]), int(depths[e - 1]), 0
            s = int(ends[-1]) if len(ends) else 0
            if s < len(blob):
                held.append(blob[s:])
                low, commas = min(low, int(depths[s:].min())), commas + int(marks[-1]) - before
            depth = int(depths[-1])
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)), schema=CUT_TYPES)
        if held:
            yield pa.RecordBatch.from_pydict({c: [v] for c, v in zip(names, (path, block, n, b"".join(held), at, low, commas, seen, starts, False), strict=True)}, schema=CUT_TYPES)


CUT_TYPES = pa.schema([("path", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("text", pa.binary()), *((c, pa.int64()) for c in ("at", "low", "commas", "seen")), ("starts", pa.bool_()), ("ended", pa.bool_())])


def _joined(rows: DataFrame, small: DataFrame, on: list[str], few: bool) -> DataFrame:
    """Rows with what belongs to their split, still in the order in which they lie."""
    if few:
        return rows.join(F.broadcast(small), on)
    return rows.withColumn("_o", F.monotonically_increasing_id()).join(small.hint("shuffle_merge"), on).sortWithinPartitions(*on, "_o").drop("_o")


class Document:
    """The JSON documents of a path: ``outline`` (path, v), a variant with marks for the stretches of records that ``inner`` holds; v is null where a document is no JSON."""

    def __init__(self, spark: SparkSession, path: str):
        self.mark = uuid.uuid4().hex
        pieces = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("text"))
        sums = staged(pieces.mapInArrow(_sums, SUMS), "splits")
        w = W.partitionBy("path").orderBy("block")
        before, whole = w.rowsBetween(W.unboundedPreceding, -1), w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        begin = sums.withColumn("inside", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2)
        begin = begin.withColumn("depth", F.coalesce(F.sum(F.when(F.col("inside") == 0, F.col("delta_outside")).otherwise(F.col("delta_inside"))).over(before), F.lit(0)))
        begin = begin.withColumn("base", F.when(F.first("head", True).over(whole) == "[", 1).otherwise(2)).withColumn("over", F.sum("bytes").over(whole) - F.col("size"))
        begin = begin.select("path", "block", "inside", "depth", "base", "over")
        n, odd = begin.agg(F.count(F.lit(1)), F.count_if(~F.col("over").isin(0, 1))).first()
        self.inner = None
        if odd:  # compressed, so that lengths do not tell whether the last brace is there
            return self._whole(spark, path)
        few = n <= SPLITS
        cuts = staged(_joined(pieces, begin, ["path", "block"], few).drop("over", "size").mapInArrow(_cuts, CUTS), "cuts")
        ahead = cuts.groupBy("path", "block").agg(F.sum("commas").alias("c")).select("path", "block", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("ahead"))
        cuts = _joined(cuts, ahead, ["path", "block"], few).withColumn("first", F.col("ahead") + F.col("seen")).withColumn("text", F.col("text").cast("string")).drop("ahead", "seen")
        is_whole, place = F.col("starts") & F.col("ended"), F.struct("block", "n")
        parts = cuts.where(~is_whole).withColumn("g", F.sum(F.col("starts").cast("int")).over(W.partitionBy("path").orderBy("block", "n")))
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "n", "text"))), lambda x: x["text"]), "")
        parts = parts.groupBy("path", "g").agg(F.min(place).alias("place"), text.alias("text"), F.min_by("at", place).alias("at"), F.min("low").alias("low"), F.sum("commas").alias("commas"), F.min("first").alias("first"), F.bool_or("ended").alias("ended"))
        columns = ["path", "place", "text", "at", "low", "commas", "first", "ended"]
        groups = cuts.where(is_whole).withColumn("place", place).select(columns).unionByName(parts.select(columns))
        files = begin.groupBy("path").agg(F.first("base").alias("base"), (F.first("over") == 1).alias("over"))
        groups = groups.join(files, "path")
        in_list = F.col("ended") & (F.col("at") == F.col("base")) & (F.col("low") >= F.col("base")) & F.col("text").rlike(r"^[ \t\r\n]*,") & ~F.col("text").rlike(MEMBER)
        around = staged(groups.where(~in_list).select("path", "place", "text", "over"), "around")
        if around.count() > OUTSIDE:
            return self._whole(spark, path)
        places = around.groupBy("path").agg(F.array_sort(F.collect_list("place")).alias("places"))
        run = F.size(F.filter("places", lambda p: p < F.col("place")))
        self.inner = groups.where(in_list).join(F.broadcast(places), "path").select("path", run.alias("run"), "first", "commas", F.try_parse_json(F.concat(F.lit("["), F.regexp_replace("text", r"^[ \t\r\n]*,", ""), F.lit("]"))).alias("a"))
        self.runs = staged(self.inner.groupBy("path", "run").agg(F.min("first").alias("least"), F.sum("commas").alias("values"), F.count_if(F.col("a").isNull()).alias("broken")), "runs")
        numbered = around.withColumn("run", F.row_number().over(W.partitionBy("path").orderBy("place"))).join(self.runs, ["path", "run"], "left")
        text = F.concat("text", F.when(F.col("values").isNotNull(), F.concat(F.lit(f',{{"{self.mark}":'), F.col("run").cast("string"), F.lit("}"))).otherwise(""))
        docs = numbered.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run", text.alias("t")))), lambda x: x["t"]), "").alias("text"), F.first("over").alias("over"), F.coalesce(F.sum("broken"), F.lit(0)).alias("broken"))
        shown = F.when(F.col("over"), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
        self.outline = docs.select("path", F.when(F.col("broken") == 0, shown).alias("text")).select("path", json_document(F.col("text")).alias("v"))

    def _whole(self, spark: SparkSession, path: str) -> None:
        self.outline = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), json_document(F.col("value")).alias("v"))

    def records(self, lists: DataFrame) -> DataFrame:
        """(path, pos, raw) of the values of lists (path, a) taken from the outline, in the order of each document."""
        spark = lists.sparkSession
        shown = lists.where("a IS NOT NULL").lateralJoin(spark.tvf.variant_explode(F.col("a").outer())).select("path", "pos", "value")
        if self.inner is None:
            return shown.select("path", F.col("pos").cast("long").alias("pos"), F.to_json("value").alias("raw"))
        shown = shown.withColumn("run", F.try_variant_get("value", f"$['{self.mark}']", "int")).join(self.runs, ["path", "run"], "left")
        length = F.when(F.col("run").isNotNull(), F.col("values")).otherwise(1)
        shown = shown.withColumn("begin", F.coalesce(F.sum(length).over(W.partitionBy("path").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        alone = shown.where("run IS NULL").select("path", F.col("begin").alias("pos"), F.to_json("value").alias("raw"))
        runs = F.broadcast(shown.where("run IS NOT NULL").select("path", "run", "begin", "least"))
        dense = self.inner.join(runs, ["path", "run"]).select("path", (F.col("begin") + F.col("first") - F.col("least")).alias("ahead"), "a")
        dense = dense.lateralJoin(spark.tvf.variant_explode(F.col("a").outer())).select("path", (F.col("ahead") + F.col("pos")).alias("pos"), F.to_json("value").alias("raw"))
        return alone.unionAll(dense)

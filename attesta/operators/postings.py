"""Substring search by an index of trigrams: which rows have each three characters, in sorted columns that Parquet keeps as differences.

A text that contains another has all its trigrams. The index is rows (gram, id) dealt by ranges and sorted, so that a gram of a third of all texts is
many tasks' work, the files of other grams are skipped by their statistics, and ids lie as differences (DELTA_BINARY_PACKED) in a few
bits each. A search joins the rarest grams of what is sought with the postings, counts, and compares what is left whole. Where that
would read more postings than the indexed texts have longer pieces, as with thousands of needles of few letters, the texts are cut into
pieces as long as the needles and joined with those.

Rows come in segments: ``add`` writes a new one beside the others, and a small file, put in place by one rename, names those that count.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import Versions
from .staging import staged

#: So many of the rarest grams of a needle are looked up; what has them all is compared whole.
RAREST = 4
#: Up to so many different grams are named to the scan, which then skips files and pages without them; more are joined only.
NAMED = 1000
#: Rows of needles and grams, or of numbers found, that are broadcast at most; more are joined by sorting.
BOUND = 1_000_000
#: Rows found by grams that a task groups in memory.
GROUPED = 1_000_000
#: Lengths of the pieces: a needle's is the longest that it has.
PIECES = (3, 4, 5, 6, 8, 12, 16, 24, 32)
#: Written behind each text, so that each of its characters begins a gram, and short needles are beginnings of grams.
END = "\0\0"


def grams(text: Column, *sizes: int) -> Column:
    """The different trigrams (or pieces of other sizes) of a text, as they are."""
    each = [F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), 1) for n in sizes or (3,)]
    return F.array_distinct(F.concat(*each))


def looked_up(large: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """A join with a staged table whose rows are counted before it is broadcast. File sizes say little of such tables, which lie in a few bits a row."""
    return large.join(F.broadcast(small), on) if small.count() <= BOUND else large.hint("merge").join(small.hint("merge"), on)


class Postings:
    """An index below ``root`` over rows of one schema; with ``fold``, upper and lower case are the same."""

    def __init__(self, spark: SparkSession, root: str, fold: bool = True):
        self.spark, self.root, self.fold = spark, root.rstrip("/"), fold
        self._segments = Versions(spark, f"{self.root}/segments")

    def _folded(self, text: Column) -> Column:
        text = F.coalesce(text.cast("string"), F.lit(""))
        return F.lower(text) if self.fold else text

    def _read(self, kind: str) -> DataFrame:
        parts = (self.spark.read.parquet(f"{self.root}/{kind}-{folder}").withColumn("seg", F.lit(k)) for k, folder in enumerate(self._segments.read()["segments"].values()))
        return reduce(DataFrame.unionByName, parts)

    def add(self, rows: DataFrame, text: Column, name: str) -> int | None:
        """Indexes the text (null: empty) of ``rows`` as a segment of a new name; gives the new version, or none if the name is there already.

        Rows are numbered here, so that keys may be null or come twice.
        """
        known = (self._segments.read() or {"segments": {}})["segments"]
        if name in known:
            return None
        folder = uuid.uuid4().hex
        put = lambda df, kind: df.write.option("compression", "zstd").option("parquet.writer.version", "v2").option("parquet.enable.dictionary#id", "false").parquet(f"{self.root}/{kind}-{folder}")
        get = lambda kind: self.spark.read.parquet(f"{self.root}/{kind}-{folder}")
        put(rows.select(F.monotonically_increasing_id().alias("id"), F.struct(*rows.columns).alias("row"), self._folded(text).alias("text")), "texts")
        # The empty gram has every row: it is what the empty needle is looked up by.
        each = get("texts").select(F.explode(F.array_append(grams(F.concat("text", F.lit(END))), F.lit(""))).alias("gram"), "id")
        put(each.repartitionByRange("gram", "id").sortWithinPartitions("gram", "id"), "postings")
        put(get("postings").groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "grams")
        version = (self._segments.numbers() or [0])[-1] + 1
        self._segments.put(version, {"segments": {**known, name: folder}})
        return version

    def chosen(self, asked: DataFrame) -> DataFrame:
        """(needle, gram, least): the grams by which each needle of ``asked`` (needle, sought) is looked up, and how many of them a row must have.

        A needle of three characters or more has its rarest grams, all of which count; a shorter one each gram that begins with it, one of which is enough.
        """
        counts = self._read("grams").groupBy("gram").agg(F.sum("n").alias("n"))
        long = asked.where(F.length("sought") >= 3).select("needle", F.explode(grams(F.col("sought"))).alias("gram")).join(counts, "gram", "left")
        rare = long.groupBy("needle").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("gram")))), 1, RAREST).alias("g"))
        out = rare.select("needle", F.explode("g.gram").alias("gram"), F.size("g").alias("least"))
        for n in (1, 2):
            begun = counts.where(F.length("gram") > 0).select("gram", F.substring("gram", 1, n).alias("sought"))
            out = out.unionAll(begun.join(asked.where(F.length("sought") == n), "sought").select("needle", "gram", F.lit(1)))
        return out.unionAll(asked.where("sought = ''").select("needle", F.lit(""), F.lit(1)))

    def candidates(self, asked: DataFrame) -> DataFrame:
        """(needle, seg, id) of the rows that have the grams looked up."""
        chosen = staged(self.chosen(asked), "grams")
        long = F.length("sought") >= PIECES[0]
        length = F.coalesce(*(F.when(F.length("sought") >= n, n) for n in reversed(PIECES)))
        sizes = sorted(r[0] for r in asked.where(long).select(length).distinct().collect())  # no more than PIECES
        if not sizes or self._reads(chosen) <= len(sizes) * (self._read("texts").agg(F.sum(F.length("text"))).first()[0] or 0):
            return self._by_grams(chosen)
        pieces = staged(asked.where(long).select("needle", F.substr("sought", F.lit(1), length).alias("piece")), "pieces")
        found = looked_up(self._read("texts").select("seg", "id", F.explode(grams(F.col("text"), *sizes)).alias("piece")), pieces, ["piece"])
        return found.select("needle", "seg", "id").unionAll(self._by_grams(staged(self.chosen(asked.where(~long)), "grams")))

    def _reads(self, chosen: DataFrame) -> int:
        """How many rows the join of the chosen grams with the postings has."""
        return chosen.join(self._read("grams"), "gram").agg(F.sum("n")).first()[0] or 0

    def _by_grams(self, chosen: DataFrame) -> DataFrame:
        postings = self._read("postings")
        few = [r[0] for r in chosen.select("gram").distinct().limit(NAMED + 1).collect()]
        if len(few) <= NAMED:
            postings = postings.where(F.col("gram").isin(few))
        # A row's grams lie in different files, so that grouping before rows are dealt would only fill memory.
        found = looked_up(postings, chosen, ["gram"]).repartition(max(self.spark.sparkContext.defaultParallelism, self._reads(chosen) // GROUPED), "needle", "id")
        found = found.groupBy("needle", "seg", "id").agg(F.count(F.lit(1)).alias("n"), F.first("least").alias("least"))
        return found.where("n >= least").select("needle", "seg", "id")

    def search(self, needles: DataFrame) -> DataFrame:
        """(needle, row): each different needle of ``needles`` with each row whose text contains it. The empty needle is in all texts, null in none."""
        if self._segments.read() is None:
            raise ValueError("nothing has been indexed")
        asked = needles.select(F.col(needles.columns[0]).cast("string").alias("needle")).where("needle IS NOT NULL").distinct()
        found = staged(self.candidates(asked.withColumn("sought", self._folded(F.col("needle")))), "candidates")
        return looked_up(self._read("texts"), found, ["seg", "id"]).where(F.col("text").contains(self._folded(F.col("needle")))).select("needle", "row")

    def containing(self, needle: str) -> DataFrame:
        """The rows whose text contains the needle, blanks around it aside."""
        return self.search(self.spark.createDataFrame([(needle.strip(),)], "needle string")).select("row.*")

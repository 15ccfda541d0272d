"""Suffix-array dedup: every byte covered by a string of ``LENGTH`` bytes that starts earlier somewhere is removed.

Winnowing comes first: of each ``LENGTH`` - ``GRAM`` + 1 consecutive hashes of ``GRAM`` bytes the leftmost least is the anchor of the string of LENGTH bytes
that they make up. Every string has one anchor, and equal strings have equal ones, so a string can repeat only where its anchor's hash
repeats. The strings that share an anchor's place are its context; contexts meet by the anchor's hash.

Contexts that are equal throughout, told by 128-bit digests, repeat as they are, first within a task and then by anchor. The others are indexed: they are dealt into two shards, each
shard's Burrows-Wheeler transform is built from its suffix array, and the transforms are merged by refining their interleaving, first by 7
symbols, then by as many as the interleaving so far tells apart. The blocks at the end are the intervals of suffixes with a common prefix of
LENGTH; no suffix of the merged text is sorted again. In each interval all but the earliest start is a repeat.

An anchor with over ``HOT`` places has its strings told apart one by one instead of its contexts, each by its own hash, so that no task gets all
contexts of one passage, however many documents hold it. Of documents with equal texts, told by SHA-256, only the first is looked at.

Defined results: a null text is empty; texts are UTF-8 bytes and matches never cross documents; overlapping matches count; strings are
judged on the input; rows of one doc_id follow each other in the order of their texts (equal rows: the first stays), null ids come first; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, materialise, small_batches, table

LENGTH, GRAM = 100, 32
REACH = LENGTH - GRAM
#: Symbols that the first interleaving takes: as many as fit into a number.
GROUP = 7
#: Bytes of contexts that are indexed together, unless one anchor has more.
BATCH = 250_000
#: Places of an anchor beyond which its strings meet one by one.
HOT = 4096
#: Digests that a task holds before it passes them on.
HELD = 250_000
#: Bits for a place in a document; those above them number the documents of a batch.
START_BITS = 40


def gram_hashes(data: bytes) -> np.ndarray:
    """Hashes of all strings of GRAM (a power of two) bytes."""
    h, n, by = np.frombuffer(data, dtype=np.uint8).astype(np.uint64), 1, np.uint64(0x100000001B3)
    with np.errstate(over="ignore"):
        h = (h + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        while n < GRAM:
            h = h[:-n] * by + h[n:]
            by, n = by * by, 2 * n
        h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(29)


def _sliding(h: np.ndarray, width: int, of) -> np.ndarray:
    """Least or greatest of every ``width`` neighbours."""
    n = 1
    while 2 * n <= width:
        h = of(h[:-n], h[n:])
        n *= 2
    return of(h[: len(h) - (width - n)], h[width - n :]) if n < width else h


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of a text, and the first and last start of the strings that each is the anchor of."""
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint64), none, none
    h = gram_hashes(data)
    least = _sliding(h, REACH + 1, np.minimum)
    padded = np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)])
    at = np.flatnonzero(_sliding(padded, REACH + 1, np.maximum) == h)
    own = h[at]
    # A window's leftmost least has no equal or lesser hash to its left and no lesser one to its right; the nearest such are anchors themselves.
    low, high = np.maximum(at - REACH, 0), np.minimum(at, len(data) - LENGTH)
    k = 1
    while k < len(at) and len(near := np.flatnonzero(at[k:] - at[:-k] <= REACH)):
        beaten = near[own[near] <= own[near + k]] + k
        low[beaten] = np.maximum(low[beaten], at[beaten - k] + 1)
        beaten = near[own[near + k] < own[near]]
        high[beaten] = np.minimum(high[beaten], at[beaten + k] - REACH - 1)
        k += 1
    ok = low <= high
    return at[ok], own[ok], low[ok], high[ok]


def _steps(length: int) -> list[int]:
    """How far each round reaches behind the first: twice as far each time, the last one so that ``length`` symbols are told apart."""
    out, told = [], min(GROUP, length)
    while told < length:
        out.append(min(told, length - told))
        told += out[-1]
    return out


def _shard(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes of a shard in the order of their first ``length`` symbols (symbols behind a text's end are 0), by place in the joined
    text, where a mark ends each text; the rank of each place; how far each place is into its text; and the first GROUP symbols as a number."""
    joined = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = np.arange(len(joined)) - start
    left = np.repeat(sizes - 1, sizes) - inside
    symbol = joined.astype(np.int64) + 1
    symbol[left == 0] = 0
    group = np.zeros(len(joined), np.int64)
    for i in range(min(GROUP, length)):
        group <<= 9
        group[: len(joined) - i] |= np.where(left[: len(joined) - i] > i, symbol[i:], 0)
    key = group
    for k in (*_steps(length), 0):
        order = np.argsort(key)
        ranks = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
        rank = np.empty(len(order), np.int64)
        rank[order] = ranks
        if not k or ranks[-1] == len(order) - 1:
            break
        far = np.flatnonzero(left >= k)
        key = rank * (len(order) + 1)
        key[far] += rank[far + k] + 1
    rank[order] = np.arange(len(order))
    return order, rank, inside, group


def merged_blocks(left: list[bytes], right: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard (0, 1), place in the shard's joined text, and block of every suffix in merged order; suffixes of a block share ``length`` symbols.

    The interleaving begins with the order by GROUP symbols and is refined as transforms are merged: every suffix, in merged order, puts
    the suffix k places before it into the block of those k symbols (the transform's symbol, k wide). As that block is known from
    an earlier interleaving, k doubles from round to round. Each shard's own order is that of all rounds, so a round is one linear merge.
    """
    shards = [_shard(left, length), _shard(right, length)]
    z = block = None
    for k in (0, *_steps(length)):
        keys = []
        for side, (order, rank, inside, group) in enumerate(shards):
            if not k:
                keys.append(group[order])
                continue
            own = block[z == side]
            key = own * (len(z) + 1)
            after = np.flatnonzero(inside[order] >= k)
            key[rank[order[after] - k]] += own[after] + 1
            keys.append(key)
        key = np.concatenate(keys)
        merged = np.argsort(key, kind="stable")  # two sorted runs
        z = (merged >= len(keys[0])).astype(np.uint8)
        key = key[merged]
        block = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
    place = np.empty(len(z), np.int64)
    place[z == 0], place[z == 1] = shards[0][0], shards[1][0]
    return z, place, block


def _runs(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, begin, end) of bytes covered by strings of LENGTH at these starts, which are sorted."""
    first = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)]) if len(doc) else np.zeros(0, bool)
    at = np.flatnonzero(first)
    last = np.concatenate([at[1:] - 1, [len(doc) - 1]]) if len(at) else at
    return doc[at], start[at], start[last] + LENGTH


def _repeats(rows: list[tuple[int, int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Covered runs of a batch of whole anchors: rows are (anchor, document, context's start, context), all contexts different."""
    if len(rows) < 2:
        return _runs(np.zeros(0, np.int64), np.zeros(0, np.int64))
    cut = len(rows) // 2
    z, place, block = merged_blocks([r[3] for r in rows[:cut]], [r[3] for r in rows[cut:]], LENGTH)
    # One number for a document (its place in their order) and a start in it.
    docs, own = np.unique(np.array([r[1] for r in rows]), return_inverse=True)
    at = (own.astype(np.int64) << START_BITS) + np.array([r[2] for r in rows])
    number, ok = np.empty(len(z), np.int64), np.empty(len(z), bool)
    for side, (low, high) in enumerate(((0, cut), (cut, len(rows)))):
        size = np.array([len(r[3]) + 1 for r in rows[low:high]])
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        m, p = z == side, place[z == side]
        number[m] = (np.repeat(at[low:high], size) + inside)[p]
        ok[m] = (inside + LENGTH < np.repeat(size, size))[p]
    number, block = number[ok], block[ok]
    if not len(number):
        return _runs(number, number)
    head = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1])
    first = np.repeat(np.minimum.reduceat(number, head), np.diff(np.concatenate([head, [len(block)]])))
    again = np.unique(number[number != first])
    return _runs(docs[again >> START_BITS], again & ((1 << START_BITS) - 1))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows (doc, text, marks): the first places (h, doc, begin, last, digest) of each context in the task, and runs (null, doc, begin, last, null) of the others."""
    first: dict[bytes, tuple[int, int, int, int]] = {}
    whole: dict[bytes, tuple[int, int]] = {}  # contexts of hot anchors
    runs: list[tuple[int, int, int]] = []

    def meet(digest: bytes, h: int, doc: int, begin: int, last: int) -> bool:
        """Whether the context came before."""
        old = first.get(digest)
        if old is not None and (old[1], old[2]) < (doc, begin):
            runs.append((doc, begin, last))
            return True
        if old is not None:
            runs.append(old[1:])
        first[digest] = (h, doc, begin, last)
        return False

    def flush():
        rows = [*first.values()]
        columns = [*zip(*rows)] if rows else [(), (), (), ()]
        others = [*zip(*runs)] if runs else [(), (), ()]
        none = [None] * len(runs)
        yield pa.RecordBatch.from_arrays([pa.array([*columns[0], *none], pa.int64()), *(pa.array([*columns[i + 1], *others[i]], pa.int64()) for i in range(3)), pa.array([*first, *none], pa.binary())], ["h", "doc", "begin", "last", "digest"])
        first.clear()
        runs.clear()

    for batch in batches:
        for doc, text, own in zip(*(c.to_pylist() for c in batch.columns)):
            data = _bytes(text)
            for m in own:
                at, h = m["at"], m["h"]
                begin, last = (at >> 14) - (at >> 7 & 127), (at >> 14) - (at & 127)
                digest = xxhash.xxh3_128_digest(data[begin : last + LENGTH])
                if not m["hot"]:
                    meet(digest, h, doc, begin, last)
                elif (old := whole.get(digest)) is not None and old < (doc, begin):
                    runs.append((doc, begin, last))
                else:
                    whole[digest] = (doc, begin)
                    for s in range(begin, last + 1):
                        one = xxhash.xxh3_128_digest(data[s : s + LENGTH])
                        meet(one, int.from_bytes(one[:8], "little", signed=True), doc, s, s)
            if len(first) > HELD or len(runs) > HELD:
                yield from flush()
                whole.clear()
    yield from flush()


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows (h, doc, begin, last, digest) sorted by h, doc, begin: runs (doc, a, b) of contexts that came before, and first contexts
    (doc, begin, last, h) of anchors with several."""
    anchor, seen, waiting = None, set(), None
    for batch in batches:
        out: list[tuple] = []
        for h, doc, begin, last, digest in zip(*(c.to_pylist() for c in batch.columns)):
            if digest is None:
                out.append((doc, begin, last + LENGTH, None))
            elif h != anchor:
                anchor, seen, waiting = h, {digest}, (doc, begin, last, h)
            elif digest in seen:
                out.append((doc, begin, last + LENGTH, None))
            else:
                seen.add(digest)
                if waiting:
                    out.append(waiting)
                    waiting = None
                out.append((doc, begin, last, h))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["doc", "a", "b", "h"])


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows (h, doc, begin, context) sorted by h, doc, begin."""
    held: list[tuple] = []
    size = 0

    def emit(rows):
        doc, a, b = _repeats(rows)
        yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(a), pa.array(b)], ["doc", "a", "b"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if size > BATCH and row[0] != held[-1][0]:
                yield from emit(held)
                held, size = [], 0
            held.append(row)
            size += len(row[3])
    if held:
        yield from emit(held)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, doc, begin, context) over rows (doc, text, marks)."""
    for batch in batches:
        for doc, text, own in zip(*(c.to_pylist() for c in batch.columns)):
            data = _bytes(text)
            yield pa.RecordBatch.from_arrays([pa.array([m["h"] for m in own], pa.int64()), pa.array([doc] * len(own), pa.int64()), pa.array([m["begin"] for m in own], pa.int64()), pa.array([data[m["begin"] : m["last"] + LENGTH] for m in own], pa.binary())], ["h", "doc", "begin", "context"])


def covered(docs: DataFrame) -> DataFrame:
    """(doc, spans): runs of repeated bytes of each document that has any. ``docs``: doc (its place in the order), text."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, h, low, high = anchors(_bytes(text))
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(len(at), doc)), pa.array(at << 14 | at - low << 7 | at - high)], ["h", "doc", "at"])

    marks = materialise(docs.mapInArrow(found, "h long, doc long, at long"), "suffix-anchors")
    again = materialise(marks.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", (F.col("n") > HOT).alias("hot")), "suffix-repeated")
    places = marks.join(bounded(again), "h").groupBy("doc").agg(F.collect_list(F.struct("at", "h", "hot")).alias("marks"))
    # Digests tell which contexts are equal; only the first of each, and only where an anchor has several, are sent on as bytes.
    digests = docs.join(places, "doc").select("doc", "text", "marks").mapInArrow(_digests, "h long, doc long, begin long, last long, digest binary")
    digests = digests.repartition(F.coalesce("h", F.xxhash64("doc", "begin"))).sortWithinPartitions("h", "doc", "begin")
    compared = materialise(digests.mapInArrow(_compared, "doc long, a long, b long, h long"), "suffix-compared")
    wanted = compared.where("h IS NOT NULL").groupBy("doc").agg(F.collect_list(F.struct(F.col("a").alias("begin"), F.col("b").alias("last"), "h")).alias("marks"))
    around = docs.join(wanted, "doc").select("doc", "text", "marks").mapInArrow(_contexts, "h long, doc long, begin long, context binary")
    runs = materialise(around.repartition("h").sortWithinPartitions("h", "doc", "begin").mapInArrow(_indexed, "doc long, a long, b long"), "suffix-runs")
    runs = runs.unionAll(compared.where("h IS NULL").select("doc", "a", "b"))
    return runs.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("spans"))


def _numbered(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, text): documents by their id, or, where ids repeat or are null, by a number in the order of id and text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").isEmpty():
        return rows.select(F.col("doc_id").alias("doc"), "doc_id", "text")
    ordered = rows.repartitionByRange("doc_id", "text").sortWithinPartitions("doc_id", "text")
    return materialise(ordered.select(F.monotonically_increasing_id().alias("doc"), "doc_id", "text"), "suffix-numbered")


def removed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of each row of ``docs`` (doc_id, text): the maximal removed runs and the bytes that stay."""
    small_batches(docs.sparkSession)
    named = _numbered(docs)
    rows = named.select("doc", "text")
    # Of equal texts only the first can hold a first occurrence; the others go whole.
    sums = rows.select("doc", F.sha2("text", 256).alias("sum"), F.octet_length("text").cast("long").alias("n"))
    first = sums.groupBy("sum").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    copies = materialise(sums.join(first, "sum").where("doc <> first").select("doc", "n"), "suffix-copies")
    spans = covered(rows.join(bounded(copies.select("doc")), "doc", "left_anti"))
    spans = spans.unionAll(copies.where(F.col("n") >= LENGTH).select("doc", F.array(F.struct(F.lit(0).cast("bigint").alias("a"), F.col("n").alias("b"))).alias("spans")))
    joined = named.join(spans, "doc", "left")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data, merged = _bytes(text), []
                for s in own or ():
                    if merged and s["a"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["b"])
                    else:
                        merged.append([s["a"], s["b"]])
                sizes.append(len(data))
                spans.append([{"a": a, "b": b} for a, b in merged])
                at = [0, *(x for ab in merged for x in ab), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(at[::2], at[1::2])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return joined.select("doc_id", "text", "spans").mapInArrow(keep, "doc_id long, n_bytes long, spans array<struct<a: long, b: long>>, kept binary")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = removed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["b"] - s["a"])
    return out.select("doc_id", "n_bytes", n.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op7_suffix_array_dedup": op7}
ORACLE_SQL: dict[str, str] = {}

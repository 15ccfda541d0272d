"""SimHash near-dedup by deletion-variant signatures.

A text's fingerprint is one or more SimHash words of 64 bits over its word shingles. Each word is cut into three segments,
fewer than the differing bits allowed, so that one segment differs by one bit at most. The index holds every segment
with each of its bits deleted in turn, 64 keys a word: two segments that differ by at most one bit have a key in common.
Fingerprints that share a key are compared, and those within ``max_bits`` are linked. Of one word and up to
4 bits, no link is lost; of more words and bits, a link is lost only if no segment of any word is that near.

Equal fingerprints are one node before the index is built, so a group of copies of any size is one row. A bucket emits
the components of its members, never their pairs; the members of a bucket of over ``BUCKET`` are dealt out
into blocks, and every two blocks are compared in a task of their own.

The pipeline's links are proven: ``similar`` takes SimHash only for candidates, and links two texts if their sets of five-word shingles have
a Jaccard similarity of 0.8 or more. Its candidates share one of ``SAMPLES`` samples of ``SAMPLED`` bits each, of six words, where a segment
and its deletion variants would draw on few bits; sets of under ``SMALL`` shingles also share one of their smallest hashes, which two sets of
that similarity always do. Texts that candidates connect are compared set by set; sets are told apart by the 64-bit hashes of their shingles.

Defined results: A-Z are lower-cased, words are runs without ASCII white space; a null text is the empty text; texts without
words have fingerprint 0 and are linked like any other; a text with fewer words than a shingle is one shingle; repeated rows
each get their result; an empty table gives an empty table; other columns pass through, except for those named sd_*.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shingles
from .common import bounded, hex64, materialise, small_batches, table
from .components import components

#: First bit and bits of the segments of a word.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Members of a bucket that are compared at once.
BUCKET = 1024
#: Keys of a fingerprint of ``similar``, bits of each, words that they are drawn from, and words and differing bits by which candidates are told.
#: At 0.8 a bit differs with probability 0.151: 192 bits in 29 with a standard deviation of 5. Unrelated texts differ in 96.
SAMPLES, SAMPLED, DRAWN, COMPARED, CANDIDATE_BITS = 256, 20, 6, 3, 52
#: Samples of the first round; the others say only what those have not connected.
FIRST = 16
#: Sets of fewer shingles are candidates by their smallest hashes as well: their bits differ more often than the formula says.
SMALL = 32
#: Mixed into a shingle's hash for the second and later words of a fingerprint.
MIX = np.uint64(0x9E3779B97F4A7C15)


def _simhashes(hashes: np.ndarray, many: np.ndarray, n: int) -> list[np.ndarray]:
    """n SimHash words a text; the first is that of the plain hashes."""
    out = []
    for i in range(n):
        if i:
            with np.errstate(over="ignore"):
                hashes = (hashes ^ hashes >> np.uint64(32)) * MIX
                hashes ^= hashes >> np.uint64(29)
        out.append(shingles.simhash(hashes, many))
    return out


def _parts(texts: list[str | None], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shingle hashes of texts, about a million characters at a time, and how many each text has."""
    k = 0
    while k < len(texts):
        m, chars = 0, 0
        while k + m < len(texts) and (not m or chars + len(texts[k + m] or "") <= 1_000_000):
            chars += len(texts[k + m] or "")
            m += 1
        yield shingles.shingle_hashes(texts[k : k + m], width)
        k += m


def _sets(texts: list[str | None], width: int) -> Iterator[list[np.ndarray]]:
    """The sets of shingle hashes of texts, sorted, part by part."""
    for hashes, many in _parts(texts, width):
        yield [np.unique(x) for x in np.split(hashes, np.cumsum(many)[:-1])]


def _words(texts: list[str | None], width: int, n: int) -> list[np.ndarray]:
    out: list[list[np.ndarray]] = [[] for _ in range(n)]
    for hashes, many in _parts(texts, width):
        for o, w in zip(out, _simhashes(hashes, many, n)):
            o.append(w)
    return [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in out]


def fingerprints(docs: DataFrame, width: int, words: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, sd_0, sd_1, ...) for each row."""
    small_batches(docs.sparkSession)
    names = [f"sd_{i}" for i in range(words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _words(batch.column(1).to_pylist(), width, words)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(w.view(np.int64)) for w in found)], [key, *names])

    return docs.select(F.col(key).cast("long").alias(key), F.col(text)).mapInArrow(run, ", ".join([f"{key} long", *(f"{n} long" for n in names)]))


def _keys(words: int) -> F.Column:
    """The deletion variants of a fingerprint: number of the deleted bit, and the rest of its segment."""
    out = []
    for w in range(words):
        for first, bits in SEGMENTS:
            for b in range(bits):
                low = f"(shiftrightunsigned(sd_{w}, {first}) & {(1 << b) - 1}L)"
                high = f"(shiftrightunsigned(sd_{w}, {first + b + 1}) & {(1 << bits - b - 1) - 1}L)"
                out.append(f"cast({(w * 64 + first + b) << 21}L | shiftleft({high}, {b}) | {low} as bigint)")
    return F.expr(f"array({', '.join(out)})")


def _grouped(words: np.ndarray, max_bits: int, part: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Members that are linked to another one in their component: (member, first member of the component). Members of one part are linked already."""
    n = len(words)
    near = np.zeros((n, n), dtype=np.uint16)
    for w in range(words.shape[1]):
        near += np.bitwise_count(words[:, w, None] ^ words[None, :, w])
    near = near <= max_bits if part is None else (near <= max_bits) | (part[:, None] == part[None, :])
    label = np.arange(n)
    while True:
        new = np.where(near, label[None, :], n).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    member = np.flatnonzero(label != np.arange(n))
    return member, label[member]


def _bucket_links(n_keys: int, n_words: int, max_bits: int, most: int | None):
    """Over rows (keys..., words...) sorted by keys: links (a0.., b0.., null) and, of buckets over ``most``, the rows themselves (words, null, keys).

    Four keys are a bucket's, those of two blocks, and that of the row's own: where the blocks differ, what is connected within each is so by the task of the block and
    itself, and one link of each of their components says the rest.
    """
    bucket = min(n_keys, 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*(f"a{i}" for i in range(n_words)), *(f"b{i}" for i in range(n_words)), "key"]
        held, hot = None, None

        def emit(keys, words):
            """Whole buckets."""
            nonlocal hot
            edge = np.flatnonzero(np.concatenate([[True], (keys[1:, :bucket] != keys[:-1, :bucket]).any(axis=1)])) if len(keys) else np.zeros(0, int)
            size = np.diff(np.concatenate([edge, [len(keys)]]))
            a, b, later = [], [], []
            goes_on = (keys[edge] == hot).all(axis=1) if hot is not None else np.zeros(len(edge), dtype=bool)  # what is left of a bucket passed on, of any size
            later += [np.arange(e, e + s) for e, s in zip(edge[goes_on], size[goes_on])]
            edge, size = edge[~goes_on], size[~goes_on]
            two = edge[size == 2]
            d = sum(np.bitwise_count(words[two, w] ^ words[two + 1, w]).astype(np.int64) for w in range(n_words))
            a.append(words[two[d <= max_bits] + 1])
            b.append(words[two[d <= max_bits]])
            for e, s in zip(edge[size > 2], size[size > 2]):
                if most and s > most:
                    hot = keys[e].copy()
                    later.append(np.arange(e, e + s))
                else:
                    i, j = _grouped(words[e : e + s], max_bits)
                    if n_keys > bucket and keys[e, 1] != keys[e, 2]:
                        linked = np.zeros(s, dtype=bool)
                        for part in (keys[e : e + s, 3] == keys[e, 1], keys[e : e + s, 3] == keys[e, 2]):
                            at = np.flatnonzero(part)
                            linked[at[_grouped(words[e + at], max_bits)[0]]] = True
                        i, j = i[~linked[i]], j[~linked[i]]
                    a.append(words[e + i])
                    b.append(words[e + j])
            a, b, later = np.concatenate(a), np.concatenate(b), np.concatenate(later) if later else np.zeros(0, int)
            for x, y, k in ((a, b, None), (words[later], None, keys[later, 0])):
                if len(x):
                    none = pa.nulls(len(x), pa.int64())
                    yield pa.RecordBatch.from_arrays([*(pa.array(x[:, w].view(np.int64)) for w in range(n_words)), *(pa.array(np.ascontiguousarray(y[:, w]).view(np.int64)) if y is not None else none for w in range(n_words)), pa.array(k) if k is not None else none], names)

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            keys, words = np.stack(cols[:n_keys], axis=1), np.stack(cols[n_keys:], axis=1).view(np.uint64)
            if held is not None:
                keys, words = np.concatenate([held[0], keys]), np.concatenate([held[1], words])
            last = np.flatnonzero((keys[:, :bucket] != keys[-1, :bucket]).any(axis=1))
            cut = last[-1] + 1 if len(last) else 0
            if most and len(keys) - cut > most:  # a large bucket goes on: pass on what there is of it
                yield from emit(keys[:cut], words[:cut])
                hot = keys[-1].copy()
                yield from emit(keys[cut:], words[cut:])
                held = None
                continue
            yield from emit(keys[:cut], words[:cut])
            held = keys[cut:], words[cut:]
        if held is not None:
            yield from emit(*held)

    return run


def _links(index: DataFrame, words: int, max_bits: int) -> DataFrame:
    """(a0.., b0..): links that connect the fingerprints of ``index`` (key, sd_0..) with a key in common and within max_bits as their graph does."""
    names = [f"sd_{i}" for i in range(words)]
    schema = ", ".join(f"{s}{i} long" for s in "ab" for i in range(words)) + ", key long"
    # In order, so that a group's members are linked to the same few of them whichever buckets they meet in.
    index = index.select("key", *names).repartition("key").sortWithinPartitions("key", *names)
    found = materialise(index.mapInArrow(_bucket_links(1, words, max_bits, BUCKET), schema), "simhash-links")
    sides = [f"{s}{i}" for s in "ab" for i in range(words)]
    links = found.where("key IS NULL").select(*sides).distinct()
    hot = found.where("key IS NOT NULL").select("key", *(F.col(f"a{i}").alias(f"sd_{i}") for i in range(words)))
    if hot.isEmpty():
        return links
    sizes = hot.groupBy("key").agg(F.ceil(F.count(F.lit(1)) * 2 / BUCKET).alias("blocks"))
    dealt = hot.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64(*names), F.col("blocks")))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", *names)
    more = pairs.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "own", *names).mapInArrow(_bucket_links(4, words, max_bits, None), schema)
    return links.unionAll(more.select(*sides)).distinct()


def _components(prints: DataFrame, index: DataFrame, words: int, max_bits: int, key: str) -> DataFrame:
    """``prints`` with sd_component; equal fingerprints are one node, and ``index`` has the keys of each."""
    names = [f"sd_{i}" for i in range(words)]
    nodes = materialise(prints.groupBy(*names).agg(F.min(key).alias("sd_rep")), "simhash-nodes")
    links = _links(index, words, max_bits)
    for s in "ab":
        links = links.join(nodes.select(*(F.col(n).alias(f"{s}{i}") for i, n in enumerate(names)), F.col("sd_rep").alias(s)), [f"{s}{i}" for i in range(words)])
    roots = components(links.select("a", "b"))
    named = nodes.join(roots, nodes["sd_rep"] == roots["node"], "left").select(*names, F.coalesce("root", "sd_rep").alias("sd_component"))
    return prints.join(named, names)


def near_duplicates(docs: DataFrame, width: int, words: int, max_bits: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, sd_0.., sd_component) for each row; the component is named by its smallest key."""
    names = [f"sd_{i}" for i in range(words)]
    prints = materialise(fingerprints(docs, width, words, text, key), "simhash-prints")
    index = prints.select(*names).distinct().select(F.explode(_keys(words)).alias("key"), *names)
    return _components(prints, index, words, max_bits, key)


def _samples() -> np.ndarray:
    """The bits of each key of ``similar``."""
    rng = np.random.default_rng(42)
    return np.stack([rng.choice(64 * DRAWN, SAMPLED, replace=False) for _ in range(SAMPLES)])


def _set_prints(docs: DataFrame, width: int, least: float, text: str, key: str) -> DataFrame:
    """(key, sd_0.., small): SimHash words of each row's set of shingles; of a small set, the hashes of which a similar one shares at least one."""
    small_batches(docs.sparkSession)
    names = [f"sd_{i}" for i in range(DRAWN)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, small = [[] for _ in names], []
            for sets in _sets(batch.column(1).to_pylist(), width):
                many = np.array([len(x) for x in sets], dtype=np.int64)
                for f, w in zip(found, _simhashes(np.concatenate(sets), many, DRAWN)):
                    f.append(w)
                # Of n hashes in order, one of the first n - ceil(least * n) + 1 is in every set that shares least * n of them.
                small += [x[: len(x) - int(np.ceil(least * len(x) - 1e-9)) + 1].view(np.int64).tolist() if 0 < len(x) < SMALL else [] for x in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.concatenate(f).view(np.int64) if f else [], pa.int64()) for f in found), pa.array(small, pa.list_(pa.int64()))], [key, *names, "small"])

    return docs.select(F.col(key).cast("long").alias(key), F.col(text)).mapInArrow(run, ", ".join([f"{key} long", *(f"{n} long" for n in names), "small array<long>"]))


def _sampled_keys(first: bool):
    """(sd_0.. of COMPARED words, part, keys) of fingerprints (sd_0.., small, part): the keys of the first samples, or all others."""
    of = range(FIRST) if first else range(FIRST, SAMPLES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples, value = _samples(), (1 << np.arange(SAMPLED)).astype(np.float32)
        for batch in batches:
            words = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(DRAWN)], axis=1)
            bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little").astype(np.float32)
            keys = np.stack([bits[:, samples[k]] @ value for k in of], axis=1).astype(np.int64) | np.array(of, dtype=np.int64) << SAMPLED
            small = [[]] * len(keys) if first else batch.column(DRAWN).to_pylist()
            rows = [k.tolist() + [x & (1 << 63) - 1 | 1 << 62 for x in s] for k, s in zip(keys, small)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(COMPARED)), batch.column(DRAWN + 1), pa.array(rows, pa.list_(pa.int64()))], [*(f"sd_{i}" for i in range(COMPARED)), "part", "keys"])

    return run


def _part_links(n_keys: int, n_words: int, max_bits: int, most: int | None):
    """Over rows (keys..., words..., part) sorted by keys: links (a, b) between parts that have members within max_bits in a bucket, as their graph connects them, and,
    of buckets over ``most``, the rows themselves (key, words, part)."""
    names = ["a", "b", "key", *(f"sd_{i}" for i in range(n_words)), "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hot = None, None

        def emit(keys, words, part):
            """Whole buckets."""
            nonlocal hot
            if not len(keys):
                return
            edge = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            size = np.diff(np.concatenate([edge, [len(keys)]]))
            mixed = np.maximum.reduceat(part, edge) != np.minimum.reduceat(part, edge)
            goes_on = (keys[edge] == hot).all(axis=1) if hot is not None else np.zeros(len(edge), dtype=bool)
            large = goes_on | (size > most) if most else goes_on
            if large.any():
                hot = keys[edge[large][-1]].copy()
            links = set()
            two = edge[mixed & ~large & (size == 2)]
            d = sum(np.bitwise_count(words[two, w] ^ words[two + 1, w]).astype(np.int64) for w in range(n_words))
            links.update(zip(part[two[d <= max_bits]].tolist(), part[two[d <= max_bits] + 1].tolist()))
            for e, n in zip(edge[mixed & ~large & (size > 2)], size[mixed & ~large & (size > 2)]):
                own = part[e : e + n]
                i, j = _grouped(words[e : e + n], max_bits, own)
                links.update((x, y) for x, y in zip(own[i].tolist(), own[j].tolist()) if x != y)
            if links:
                found = np.array(sorted({(max(x), min(x)) for x in links}), dtype=np.int64)
                none = pa.nulls(len(found), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[:, 0])), pa.array(np.ascontiguousarray(found[:, 1])), *[none] * (n_words + 2)], names)
            later = np.concatenate([np.arange(e, e + n) for e, n in zip(edge[large], size[large])]) if large.any() else []
            if len(later):
                none = pa.nulls(len(later), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array(np.ascontiguousarray(keys[later, 0])), *(pa.array(np.ascontiguousarray(words[later, w]).view(np.int64)) for w in range(n_words)), pa.array(part[later])], names)

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            keys, words, part = np.stack(cols[:n_keys], axis=1), np.stack(cols[n_keys:-1], axis=1).view(np.uint64), cols[-1]
            if held is not None:
                keys, words, part = (np.concatenate(x) for x in zip(held, (keys, words, part)))
            last = np.flatnonzero((keys != keys[-1]).any(axis=1))
            cut = last[-1] + 1 if len(last) else 0
            yield from emit(keys[:cut], words[:cut], part[:cut])
            held = keys[cut:], words[cut:], part[cut:]
            if most and len(held[0]) > most:  # a large bucket goes on: pass on what there is of it
                yield from emit(*held)
                held = None
        if held is not None:
            yield from emit(*held)

    return run


def _links_of_parts(index: DataFrame, words: int, max_bits: int) -> DataFrame:
    """(a, b): links between the parts of ``index`` (key, sd_0.., part) with a key in common and within max_bits."""
    names = [f"sd_{i}" for i in range(words)]
    schema = ", ".join(f"{c} long" for c in ("a", "b", "key", *names, "part"))
    index = index.select("key", *names, "part").repartition("key").sortWithinPartitions("key", *names)
    found = materialise(index.mapInArrow(_part_links(1, words, max_bits, BUCKET), schema), "simhash-links")
    links = found.where("key IS NULL").select("a", "b")
    hot = found.where("key IS NOT NULL").select("key", *names, "part")
    # A large bucket of one part has nothing to say.
    sizes = hot.groupBy("key").agg(F.ceil(F.count(F.lit(1)) * 2 / BUCKET).alias("blocks"), F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("key", "blocks")
    dealt = hot.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64(*names), F.col("blocks")))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *names, "part")
    more = pairs.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", *names).mapInArrow(_part_links(3, words, max_bits, None), schema)
    return links.unionAll(more.select("a", "b")).distinct()


def _alike(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links that connect sets as all pairs with a Jaccard similarity of at least ``least`` do; what is connected already is not compared again."""
    size = np.array([len(x) for x in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    edge = np.cumsum(size) - size
    left, out = list(range(len(sets))), []
    mark = np.zeros(len(values), dtype=bool)
    while left:
        queue = [left.pop(0)]
        while queue and left:
            i = queue.pop()
            mark[column[edge[i] : edge[i] + size[i]]] = True
            rest, queue_ = [], []
            for j in left:
                n = int(np.count_nonzero(mark[column[edge[j] : edge[j] + size[j]]])) if least * max(size[i], size[j]) <= min(size[i], size[j]) + 1e-6 else 0
                (queue_ if n / max(1, size[i] + size[j] - n) >= least else rest).append(j)
            mark[column[edge[i] : edge[i] + size[i]]] = False
            out += [(i, j) for j in queue_]
            queue += queue_
            left = rest
    return out


def similar(docs: DataFrame, width: int = 5, least: float = 0.8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, sd_component) for each key: rows are linked if their sets of shingles have a Jaccard similarity of ``least`` or more.

    ``least`` must not be below 0.8, which the candidates stand for.
    """
    if least < 0.8:
        raise ValueError("candidates are made for a similarity of 0.8 or more")
    prints = materialise(_set_prints(docs, width, least, text, key), "simhash-prints")
    compared = [f"sd_{i}" for i in range(COMPARED)]
    drawn = [f"sd_{i}" for i in range(DRAWN)]
    nodes = materialise(prints.groupBy(*compared).agg(F.min(key).alias("part")), "simhash-nodes")
    schema = ", ".join([*(f"{n} long" for n in compared), "part long", "keys array<long>"])

    def index(parts: DataFrame, first: bool) -> DataFrame:
        whole = prints.select(*drawn, "small").distinct().join(parts, compared).select(*drawn, "small", "part")
        return whole.mapInArrow(_sampled_keys(first), schema).select(F.explode("keys").alias("key"), *compared, "part")

    for first in (True, False):
        roots = components(_links_of_parts(index(nodes, first), COMPARED, CANDIDATE_BITS))
        nodes = materialise(nodes.join(roots, F.col("part") == F.col("node"), "left").select(*compared, F.coalesce("root", "part").alias("part")), "simhash-nodes")
    coarse = materialise(prints.select(key, *compared).join(nodes, compared).select(key, F.col("part").alias("sd_component")).distinct(), "simhash-candidates")
    several = coarse.groupBy("sd_component").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sd_component")
    members = materialise(coarse.join(several, "sd_component", "left_semi"), "simhash-members")
    texts = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias("text")).join(bounded(members), key).select(key, "sd_component", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for sets in _sets(batch.column(2).to_pylist(), width) for x in sets]
            raw = [x.tobytes() for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([hashlib.sha256(x).digest() for x in raw], pa.binary()), pa.array(raw, pa.binary())], [key, "part", "digest", "shingles"])

    sets = materialise(texts.mapInArrow(run, f"{key} long, part long, digest binary, shingles binary"), "simhash-sets")
    named = materialise(sets.groupBy("digest").agg(F.min(F.struct(key, "part")).alias("m")).select("digest", F.col("m")[key].alias("rep"), F.col("m.part").alias("part")), "simhash-named")  # equal sets are one
    sizes = named.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("part", F.ceil(F.col("n") * 2 / BUCKET).alias("blocks"))
    many = materialise(named.join(sizes, "part").select("rep", "part", "blocks", "digest"), "simhash-several")
    own = sets.join(many.select(F.col("rep").alias(key), "part", "digest", "blocks"), [key, "part", "digest"]).dropDuplicates([key, "digest"])
    dealt = own.select("part", F.col(key).alias("rep"), "shingles", "blocks", F.pmod(F.xxhash64(key), F.col("blocks")).alias("own"))
    # Every two blocks meet in a task of their own; a part of one block meets itself.
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("part", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep", "shingles")

    def verify(got: pa.Table) -> pa.Table:
        got = got.sort_by("rep")
        rep = got.column("rep").to_pylist()
        links = _alike([np.frombuffer(x, dtype=np.uint64) for x in got.column("shingles").to_pylist()], least)
        return pa.table({"a": pa.array([rep[i] for i, _ in links], pa.int64()), "b": pa.array([rep[j] for _, j in links], pa.int64())})

    links = pairs.groupBy("part", "i", "j").applyInArrow(verify, "a long, b long")
    copies = sets.join(named.select("digest", "rep"), "digest").where(F.col(key) != F.col("rep")).select(F.col(key).alias("a"), F.col("rep").alias("b"))
    roots = components(links.unionAll(copies))
    return coarse.select(key).distinct().join(roots, F.col(key) == F.col("node"), "left").select(key, F.coalesce("root", key).alias("sd_component"))


def first_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents of ``docs`` that are the first (smallest doc_id) of their component; rows of that id that repeat are kept once.

    A row without doc_id is no other's copy and has none: all of them stay.
    """
    first = materialise(similar(docs, **options).where("doc_id = sd_component").select("doc_id"), "simhash-first")
    out = docs.join(bounded(first), "doc_id", "left_semi").select(*docs.columns)
    if not docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        out = out.dropDuplicates(["doc_id"])
    return out.unionByName(docs.where("doc_id IS NULL"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), width=4, words=1, max_bits=4)
    return out.select("doc_id", hex64(F.col("sd_0")).alias("fingerprint"), F.col("sd_component").alias("component_id"))


QUERIES = {"op4_simhash_near_dedup": op4}
ORACLE_SQL: dict[str, str] = {}

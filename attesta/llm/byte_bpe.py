"""Byte-level BPE encoding and decoding with the ranks of an existing vocabulary.

A text is split by the vocabulary's pattern. Pieces that are no token of their own are merged in padded matrices,
one row a piece, bucketed by length: each round looks up every adjacent pair of every row in a hash table of mergeable
pairs, merges each row's leftmost pair of least rank, and compacts the matrix by the rows that are done.
Pieces of more than ``LONG`` bytes, for which rows would cost the square of their length, keep their pairs in a heap instead.

Defined results: a null text and the empty text have no tokens; decoding gives the exact bytes back; repeated rows
are encoded alike; an empty table gives an empty table; other columns pass through untouched.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import small_batches, table
from .hashtable import HashTable

LONG = 256
NONE = np.int32(2**30)
#: Pieces that a worker remembers; beyond that it starts anew. Changes no result.
REMEMBERED = 300_000
#: Characters of text that are split at once.
AT_ONCE = 1_000_000


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """The path of a vocabulary file and the pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


class ByteBpe:
    """Ranks, the hash table of mergeable pairs, and the encoder and decoder."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.findall = regex.compile(pattern).findall
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = {}
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                if (a := self.ranks.get(token[:k])) is not None and (b := self.ranks.get(token[k:])) is not None:
                    pairs[a << 32 | b] = rank
        self.pairs = pairs
        self.table = HashTable(np.fromiter(pairs.keys(), np.uint64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)), int(NONE))
        self.memory: dict[str, tuple[str, int, bytes]] = {}

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the token that each pair makes, or NONE."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        return self.table.get(keys.ravel()).reshape(keys.shape)

    def _merged(self, pieces: list[bytes]) -> list[list[int]]:
        """Pieces of about one length, merged together in a padded matrix."""
        width = max(map(len, pieces))
        length = np.array([len(p) for p in pieces])
        flat = self.single[np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8)].reshape(len(pieces), width)
        ids = np.where(np.arange(width) < length[:, None], flat, np.int32(-1))
        out: list[list[int]] = [[] for _ in pieces]
        row = np.arange(len(pieces))
        ranks = np.where(ids[:, 1:] >= 0, self.look_up(np.maximum(ids[:, :-1], 0), np.maximum(ids[:, 1:], 0)), NONE)
        while len(row):
            best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(row), np.int64)
            low = ranks[np.arange(len(row)), best] if ranks.shape[1] else np.full(len(row), NONE)
            done = low == NONE
            for i in np.flatnonzero(done):
                out[row[i]] = ids[i, : length[i]].tolist()
            go = ~done
            row, ids, ranks, best, low, length = row[go], ids[go], ranks[go], best[go], low[go], length[go] - 1
            if not len(row):
                break
            at, span = np.arange(len(row)), ids.shape[1]
            take = np.arange(span - 1) + (np.arange(span - 1) > best[:, None])
            ids = np.take_along_axis(ids, take, axis=1)
            ids[at, best] = low
            ids[np.arange(span - 1) >= length[:, None]] = -1
            take = np.arange(span - 2) + (np.arange(span - 2) >= best[:, None]) if span > 2 else np.zeros((len(row), 0), np.int64)
            ranks = np.take_along_axis(ranks, take, axis=1)
            if ranks.shape[1]:  # only the pairs on both sides of the merged one are new
                for side in (-1, 0):
                    k = best + side
                    ok = (k >= 0) & (k + 1 < length)
                    ranks[at[ok], k[ok]] = self.look_up(ids[at[ok], k[ok]], ids[at[ok], k[ok] + 1])
                ranks[np.arange(ranks.shape[1]) + 1 >= length[:, None]] = NONE
        return out

    def _long(self, piece: bytes) -> list[int]:
        ids = self.single[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.pairs.get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in pieces]
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (whole := self.ranks.get(p)) is not None:
                out[i] = [whole]
            elif len(p) > LONG:
                out[i] = self._long(p)
            else:
                buckets.setdefault((len(p) + 3) // 4 if len(p) <= 32 else 100 + (len(p) - 1).bit_length(), []).append(i)
        for of in buckets.values():
            for k in range(0, len(of), 8192):
                part = of[k : k + 8192]
                for i, ids in zip(part, self._merged([pieces[i] for i in part])):
                    out[i] = ids
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def _learn(self, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in self.memory]
        if len(self.memory) + len(new) > REMEMBERED:
            self.memory.clear()
            new = list(pieces)
        for p, ids in zip(new, self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in new])):
            self.memory[p] = (" ".join(map(str, ids)), len(ids), self.decode(ids))

    def documents(self, texts: list[str]) -> Iterator[tuple[list[tuple[str, int, bytes]], ...]]:
        """For each text the entries (ids as text, number of ids, their decoded bytes) of its pieces."""
        k = 0
        while k < len(texts):
            chunk, chars = [], 0
            while k < len(texts) and (not chunk or chars + len(texts[k]) <= AT_ONCE):
                chunk.append(self.findall(texts[k]))
                chars += len(texts[k])
                k += 1
            self._learn(set().union(*chunk))
            get = self.memory.__getitem__
            for pieces in chunk:
                yield list(map(get, pieces))


@lru_cache(2)
def loaded(path: str, pattern: str) -> ByteBpe:
    """One a worker, kept between tasks."""
    return ByteBpe(path, pattern)


def _texts(batch: pa.RecordBatch, text: str) -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]


def encode(df: DataFrame, text: str = "text", to: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` with the token ids of ``text``, an array of integers."""
    default = vocabulary_path()
    path, pattern = path or default[0], pattern or default[1]
    small_batches(df.sparkSession)
    names = [c for c in df.columns if c != to]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            ids = [[int(x) for e in doc if e[0] for x in e[0].split(" ")] for doc in bpe.documents(_texts(batch, text))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(ids, pa.list_(pa.int32()))], [*names, to])

    from pyspark.sql.types import ArrayType, IntegerType, StructType

    return df.select(*names).mapInArrow(run, StructType([*df.select(*names).schema.fields]).add(to, ArrayType(IntegerType())))


def decode(df: DataFrame, ids: str = "ids", to: str = "decoded", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` with the bytes of the token ids. Ids outside the vocabulary are an error."""
    default = vocabulary_path()
    path, pattern = path or default[0], pattern or default[1]
    names = [c for c in df.columns if c != to]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            of = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array([bpe.decode(x or []) for x in of], pa.binary())], [*names, to])

    from pyspark.sql.types import BinaryType, StructType

    return df.select(*names).mapInArrow(run, StructType([*df.select(*names).schema.fields]).add(to, BinaryType()))


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per document the number of tokens and the digests of its ids and of the bytes decoded from them."""
    default = vocabulary_path()
    path, pattern = path or default[0], pattern or default[1]
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            n, of_ids, of_bytes = [], [], []
            for doc in bpe.documents(_texts(batch, "text")):
                n.append(sum(e[1] for e in doc))
                of_ids.append(hashlib.sha256(" ".join([e[0] for e in doc]).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(b"".join([e[2] for e in doc])).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


QUERIES = {"op6_byte_bpe": op6}
ORACLE_SQL: dict[str, str] = {}

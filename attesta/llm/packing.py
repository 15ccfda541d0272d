"""Packing of token ids into sequences: bounded-space online best fit.

Each task keeps a fixed number of open windows. A document goes where it fits best, the fullest window that has room for it; if none
has, the fullest is emitted and a new one is opened. Documents longer than a window are cut into whole windows and a rest first. A
window that is emitted with more than ``slack`` ids to spare is filled up with the head of the document that did not fit.

What is open at the end of a task is written with its ids, at most ``windows`` times the width for a task. These leftovers are merged in
rounds, ``FAN`` tasks' in a group, each by the same packer: a group's input is bounded, and there are as many rounds as the logarithm of
the tasks. The last group fills its fullest windows from the emptiest, and cuts the one that remains into sequences that are powers of
two long, which need no padding.

Texts are read once and are not shuffled; only leftovers are. Sequences are numbered by round, group and their order there, so that a
task that is run again gives the same numbers.

Defined results: a null or empty text is a document of the end id alone; rows with one doc_id, or none, are documents of their own;
an empty table gives an empty table; extra columns are not read. The library's own treatment of its special tokens' strings in a text holds.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, small_batches, table

WIDTH = 2048
#: Open windows of a task.
WINDOWS = 64
#: Ids that a window may lack when it is emitted without a cut.
SLACK = 8
#: Tasks whose leftovers are merged in one group.
FAN = 64
#: The id after each document.
END = 1
#: Words and pieces that a worker remembers; beyond that it starts anew. Changes no result.
REMEMBERED = 1_000_000
#: Bytes of text that are encoded together, so that a word that they share is looked up once.
AT_ONCE = 4_000_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source_task long, window int, ids binary"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Words of printable ASCII and the Latin letters up to U+017F: composed already, with lower-case forms of one character in the same range.
PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ſ]*").fullmatch
#: The vocabulary's own pattern, as it reads on such words in lower case.
SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+").findall


def _characters_of_bytes() -> list[str]:
    """The byte-level alphabet: visible Latin-1 characters stand for themselves, the other bytes for the characters from U+0100 on."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256))
    return [chr(b if b in seen else 256 + next(hidden)) for b in range(256)]


class WordTokenizer:
    """Ids of whole texts, made of the ids of their blank-separated words, each of which is encoded once and remembered.

    The vocabulary drops white space, composes characters, folds case and splits without looking across an ASCII blank, so that a
    text's ids are those of its words, one after another. Of plain words only the pieces go to the library's model, each once; all
    others go through the whole library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.special = re.compile("|".join(re.escape(x.content) for x in self.tokenizer.get_added_tokens_decoder().values()) or "(?!)").search
        self.alphabet = "".join(_characters_of_bytes())
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        visible = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet)
        self.pieces[piece] = ids = array("I", [t.id for t in self.merge(visible)]).tobytes()
        return ids

    def _word(self, word: str) -> bytes:
        if not PLAIN(word) or self.special(word):
            ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        else:
            known = self.pieces
            ids = b"".join([known[p] if p in known else self._piece(p) for p in SPLIT(word.lower())])
        self.words[word] = ids
        return ids

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each text's begin (and the last's end); a null text has none."""
        for known in (self.words, self.pieces):
            if len(known) > REMEMBERED:
                known.clear()
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        words = split.flatten().dictionary_encode()
        known = self.words
        own = [known[w] if w in known else self._word(w) for w in words.dictionary.to_numpy(zero_copy_only=False)]
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        flat, begin = np.frombuffer(b"".join(own), "<u4"), np.cumsum(sizes) - sizes
        at = words.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[at])])
        ids = flat[np.repeat(begin[at] - ends[:-1], sizes[at]) + np.arange(ends[-1])]
        return ids, ends[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])]


@lru_cache(2)
def loaded(path: str) -> WordTokenizer:
    """One a worker, kept between tasks."""
    return WordTokenizer(path)


class Packer:
    """Open windows of one task, and the rows of those that are closed. A piece is (doc_id, start, doc_tokens, ids as bytes)."""

    def __init__(self, width: int, windows: int, slack: int, first: int):
        self.width, self.windows, self.slack = width, windows, slack
        self.open: list[tuple[int, int, list]] = []  # (ids to spare, number, pieces), in that order
        self.sequence, self.opened, self.rows = first, 0, []

    def emit(self, pieces: list) -> None:
        at = 0
        for doc, start, total, ids in pieces:
            self.rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, self.sequence, at, None, None, None))
            at += len(ids) // 4
        self.sequence += 1

    def _room(self, spare: int) -> int:
        """Where the windows begin that have as many ids to spare."""
        return bisect_left(self.open, (spare, -1))

    def add(self, doc: int | None, start: int, total: int, ids: bytes) -> None:
        n = len(ids) // 4
        while n >= self.width:  # whole windows
            self.emit([(doc, start, total, ids[: self.width * 4])])
            start, ids, n = start + self.width, ids[self.width * 4 :], n - self.width
        if not n:
            return
        k = self._room(n)
        if k < len(self.open):
            spare, number, pieces = self.open.pop(k)
        elif len(self.open) < self.windows:
            spare, number, pieces = self.width, self.opened, []
            self.opened += 1
        else:
            spare, _, pieces = self.open.pop(0)
            if spare > self.slack:  # fill it up with the head
                pieces.append((doc, start, total, ids[: spare * 4]))
                start, ids = start + spare, ids[spare * 4 :]
            self.emit(pieces)
            return self.add(doc, start, total, ids)
        pieces.append((doc, start, total, ids))
        if spare == n:
            self.emit(pieces)
        else:
            insort(self.open, (spare - n, number, pieces), key=lambda w: w[:2])

    def leave(self, task: int) -> None:
        """The open windows become rows with their ids, for the next round."""
        for k, (_, _, pieces) in enumerate(self.open):
            self.rows += [(doc, start, len(ids) // 4, None, total, None, None, task, k, ids) for doc, start, total, ids in pieces]
        self.open = []

    def finish(self) -> None:
        """Fills the fullest windows from the emptiest; the one that remains is cut into powers of two."""
        full = [(spare, pieces) for spare, _, pieces in self.open]
        self.open = []
        while full:
            spare, pieces = full.pop(0)
            while spare and full:
                room, last = full[-1]
                doc, start, total, ids = last.pop()
                n = min(spare, len(ids) // 4)
                pieces.append((doc, start, total, ids[: n * 4]))
                spare, room = spare - n, room + n
                if n * 4 < len(ids):
                    last.append((doc, start + n, total, ids[n * 4 :]))
                full[-1] = (room, last)
                if not last:
                    full.pop()
            if not spare:
                self.emit(pieces)
                continue
            left = self.width - spare
            for size in (1 << b for b in reversed(range(left.bit_length())) if left >> b & 1):
                part = []
                while size:
                    doc, start, total, ids = pieces.pop(0)
                    n = min(size, len(ids) // 4)
                    part.append((doc, start, total, ids[: n * 4]))
                    size -= n
                    if n * 4 < len(ids):
                        pieces.insert(0, (doc, start + n, total, ids[n * 4 :]))
                self.emit(part)

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 8 + [pa.int32(), pa.binary()]
        names = [x.split()[0] for x in PIECES.split(", ")]
        out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in self.rows], t) for k, t in enumerate(kinds)], names)
        self.rows = []
        return out


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
    """The columns of as many batches as have ``AT_ONCE`` bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.nbytes for x in held) >= AT_ONCE:
            yield [c.combine_chunks() for c in pa.Table.from_batches(held).columns]
            held = []
    if held:
        yield [c.combine_chunks() for c in pa.Table.from_batches(held).columns]


def _first(round_: int, group: int) -> int:
    """The number of a group's first sequence: rounds, groups and sequences have 5, 26 and 32 bits."""
    return round_ << 58 | group << 32


def pack(docs: DataFrame, path: str | None = None, width: int = WIDTH, windows: int = WINDOWS, slack: int = SLACK, fan: int = FAN, end: int = END) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of each piece of a document."""
    path = path or vocabulary_path()
    small_batches(docs.sparkSession)
    last = np.array([end], dtype="<u4").tobytes()

    def online(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        tokens, packer = loaded(path), Packer(width, windows, slack, _first(0, task))
        for ids_of, texts in _gathered(batches):
            ids, ends = tokens.ids(texts)
            for doc, a, b in zip(ids_of.to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                packer.add(doc, 0, b - a + 1, ids[a:b].tobytes() + last)
            if packer.rows:
                yield packer.batch()
        packer.leave(task)
        yield packer.batch()

    done = materialise(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(online, PIECES), "packed-0")
    out, round_ = done.where("sequence_id IS NOT NULL"), 0
    left = done.where("sequence_id IS NULL")
    tasks = (left.agg(F.max("source_task")).first()[0] or 0) + 1
    while True:
        round_ += 1
        tasks = -(-tasks // fan)
        rest = materialise(_merged(left, round_, tasks == 1, width, windows, slack, fan), f"packed-{round_}")
        out, left = out.unionByName(rest.where("sequence_id IS NOT NULL")), rest.where("sequence_id IS NULL")
        if tasks == 1:
            return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _merged(left: DataFrame, round_: int, final: bool, width: int, windows: int, slack: int, fan: int) -> DataFrame:
    """One round: the leftovers of ``fan`` tasks are packed together."""

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        group = key[0].as_py()
        packer = Packer(width, windows, slack, _first(round_, group))
        rows = rows.sort_by([("length", "descending"), ("source_task", "ascending"), ("window", "ascending"), ("doc_id", "ascending"), ("start", "ascending"), ("doc_tokens", "ascending")])
        for doc, start, total, ids in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))):
            packer.add(doc, start, total, ids)
        if final:
            packer.finish()
        else:
            packer.leave(group)
        return pa.Table.from_batches([packer.batch()])

    return left.groupBy((F.col("source_task") / fan).cast("long").alias("merge_group")).applyInArrow(merge, PIECES)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op11_packing": op11}
ORACLE_SQL: dict[str, str] = {}

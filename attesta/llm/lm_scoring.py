"""LM scoring by subword lattices.

A word's probability is the sum, over all its segmentations, of the product of the pieces' probabilities, by a forward recursion in log space. The
pieces are those of an existing vocabulary, and the words of the training texts, each of which is a segmentation of one piece. Pieces of the
vocabulary start with its own scores (ranks of merges); ``ROUNDS`` rounds of expectation maximisation over all distinct training words re-estimate
them. A training word's piece has its count less a discount, found from the words seen once and twice; what the discount leaves goes to the
vocabulary's pieces, so that the probabilities of all words sum to one.
The training texts' languages (the ``CLASSES`` most frequent, the others as one) each have counts that are mixed in the same way with those
of all texts. A text's score is the log10 of its marginal probability: over languages, of the product over its words and its end.
The language of a scored text is never read.

Counts cover every training text and grow with the corpus; of it, the driver sees sums and one number for each vocabulary piece.
Words are looked up block by block (a split of the input file, parted further where its texts have over ``BLOCK`` bytes): a block's distinct words are joined to their scores and
meet the block's texts in one task, so that neither tokens nor the word table are broadcast or shuffled one by one.

Defined results: A-Z are lower-cased, words are runs without ASCII white space; a null text and one without words consist of their end
alone; characters outside the vocabulary are spelled by its byte pieces; without training texts only the lattice counts; repeated
rows each count and each get their score; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, materialise, small_batches, table
from .hashtable import HashTable

ROUNDS = 3
#: Languages with counts of their own, at most.
CLASSES = 8
#: Longest word that goes through the padded matrices; longer ones go through the same recursion one by one.
WORD = 48
#: Bytes of texts that meet their words in one task, unless one text has more.
BLOCK = 24_000_000
#: Distinct words that a task counts before it passes them on.
COUNTED = 600_000
BASE = np.uint64(1_000_003)
LOG10 = math.log(10)


def vocabulary(path: str | None = None) -> tuple[list[str], list[float]]:
    """Pieces and starting log scores of a SentencePiece vocabulary; control pieces get none."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores = [], []
    for i in range(sp.get_piece_size()):
        pieces.append("" if sp.is_control(i) or sp.is_unknown(i) else sp.id_to_piece(i))
        # Scores of merges are ranks; by Zipf's law a piece's probability falls with its rank.
        scores.append(-math.log(100.0 - min(0.0, sp.get_score(i))))
    return pieces, scores


def hashed(pieces: list[str]) -> np.ndarray:
    """Polynomial hashes of the characters, as the padded matrices have them span by span."""
    codes = np.zeros((len(pieces), max(map(len, pieces), default=0)), dtype=np.uint64)
    for k, p in enumerate(pieces):
        codes[k, : len(p)] = np.frombuffer(p.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    length, h = np.array([len(p) for p in pieces]), np.full(len(pieces), 7, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(codes.shape[1]):
            h = np.where(j < length, h * BASE + codes[:, j], h)
    return h


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 60_000) -> Iterator[pa.RecordBatch]:
    """The rows in larger batches: words are short, and matrices of many words are worth their overhead."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


class Lattice:
    """Piece log probabilities: of pieces that begin a word, of those that go on, and of going on at all."""

    def __init__(self, pieces: list[str], first: np.ndarray, later: np.ndarray, go_on: float):
        self.first, self.later = first, later  # log probabilities by piece, -inf where impossible
        self.go, self.stop = math.log(go_on), math.log1p(-go_on)
        self.ids = {p: i for i, p in enumerate(pieces) if p and not (len(p) == 6 and p.startswith("<0x"))}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(pieces) if len(p) == 6 and p.startswith("<0x")}
        self.most = max(map(len, self.ids), default=1)
        # Beginnings of pieces are looked up as well, so that a span goes on only where a longer piece may follow.
        begun = {p[:k] for p in self.ids for k in range(1, len(p))}
        self.goes_on = np.zeros(len(pieces), dtype=bool)
        self.goes_on[[i for p, i in self.ids.items() if p in begun]] = True
        begun -= self.ids.keys()
        self.table = HashTable(hashed([*self.ids, *begun]), np.array([*self.ids.values(), *[-2] * len(begun)], dtype=np.int32), -1)

    def _byte_ids(self, ch: str) -> list[int]:
        return [self.bytes[b] for b in ch.encode("utf-8", "surrogatepass")]

    def edges(self, words: list[str]):
        """For words of one length: (begin, end, words, piece of each, log score) of all spans that are pieces in some of them. A character that is none is below -1."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64).reshape(len(words), -1)
        n, length = codes.shape
        for i in range(length):
            live, h = np.arange(n), np.full(n, 7, dtype=np.uint64)
            logs = self.later + self.go if i else self.first
            for j in range(i + 1, min(length, i + self.most) + 1):
                with np.errstate(over="ignore"):
                    h = h * BASE + codes[live, j - 1]
                found = self.table.get(h)
                known = np.flatnonzero(found >= 0)
                known = known[np.isfinite(logs[found[known]])]
                at, piece = live[known], found[known]
                if len(at):
                    yield i, j, at, piece.astype(np.int64), logs[piece]
                if j == i + 1 and i and len(at) < n:  # a character without a piece of its own is spelled in bytes
                    lost = np.setdiff1d(live, at, assume_unique=True)
                    cs, inv = np.unique(codes[lost, i], return_inverse=True)
                    spelled = np.array([sum(self.later[b] + self.go for b in self._byte_ids(chr(int(c)))) for c in cs])
                    ok = np.isfinite(spelled[inv])
                    if ok.any():
                        yield i, j, lost[ok], -2 - codes[lost[ok], i].astype(np.int64), spelled[inv][ok]
                more = (found == -2) | (found >= 0) & self.goes_on[found]
                live, h = live[more], h[more]
                if not len(live):
                    break

    def forward(self, words: list[str], collect: np.ndarray | None = None, weights: np.ndarray | None = None) -> np.ndarray:
        """Log probabilities of words of one length (with their mark of beginning). collect: gets the expected pieces, first and later."""
        n, length = len(words), len(words[0])
        alpha = np.full((length + 1, n), -np.inf)
        alpha[0] = 0.0
        spans = list(self.edges(words)) if collect is not None else self.edges(words)
        for i, j, at, _, score in spans:
            alpha[j, at] = np.logaddexp(alpha[j, at], alpha[i, at] + score)
        total = alpha[length] + self.stop
        if collect is not None:
            beta = np.full((length + 1, n), -np.inf)
            beta[length] = self.stop
            for i, j, at, _, score in reversed(spans):
                beta[i, at] = np.logaddexp(beta[i, at], score + beta[j, at])
            ids, posts = ([], []), ([], [])
            for i, j, at, piece, score in spans:
                with np.errstate(invalid="ignore"):
                    post = np.exp(alpha[i, at] + score + beta[j, at] - total[at]) * weights[at]
                known = (piece >= 0) & (post > 0)
                ids[i > 0].append(piece[known])
                posts[i > 0].append(post[known])
                for k in np.flatnonzero((piece < -1) & (post > 0)):
                    np.add.at(collect[1], self._byte_ids(chr(-2 - int(piece[k]))), post[k])
            for k in (0, 1):
                if ids[k]:
                    collect[k] += np.bincount(np.concatenate(ids[k]), weights=np.concatenate(posts[k]), minlength=collect.shape[1])
        return total

    def long(self, word: str, collect: np.ndarray | None = None) -> float:
        """The same recursion for one word of any length."""
        n = len(word)
        alpha = [0.0] + [-math.inf] * n
        spans: list[list[tuple[int, list[int], float]]] = [[] for _ in range(n + 1)]  # by end: begin, pieces, log score

        def total(terms: list[float]) -> float:
            top = max(terms, default=-math.inf)
            return top + math.log(sum(math.exp(t - top) for t in terms)) if math.isfinite(top) else top

        for j in range(1, n + 1):
            terms = []
            for i in range(max(0, j - self.most), j):
                p = self.ids.get(word[i:j])
                s, of = (self.later if i else self.first)[p] + (self.go if i else 0.0) if p is not None else -math.inf, [p]
                if not math.isfinite(s) and j == i + 1 and i:
                    of = self._byte_ids(word[i:j])
                    s = sum(self.later[b] + self.go for b in of)
                if math.isfinite(s):
                    terms.append(alpha[i] + s)
                    if collect is not None:
                        spans[j].append((i, of, s))
            alpha[j] = total(terms)
        out = alpha[n] + self.stop
        if collect is not None and math.isfinite(out):
            ahead: list[list[float]] = [[] for _ in range(n)] + [[self.stop]]
            for j in range(n, 0, -1):
                beta = total(ahead[j])
                ahead[j] = []
                for i, of, s in spans[j] if math.isfinite(beta) else ():
                    ahead[i].append(s + beta)
                    for p in of:
                        collect[1 if i else 0, p] += math.exp(alpha[i] + s + beta - out)
        return out

    def score(self, words: list[str], collect: np.ndarray | None = None) -> np.ndarray:
        """Natural log probabilities of words, any order and length."""
        out = np.empty(len(words))
        marked = ["▁" + w for w in words]
        by: dict[int, list[int]] = {}
        for k, w in enumerate(marked):
            by.setdefault(len(w) if len(w) <= WORD else 0, []).append(k)
        for length, of in by.items():
            if not length:
                for k in of:
                    out[k] = self.long(marked[k], collect)
                continue
            for a in range(0, len(of), 16_384):
                part = of[a : a + 16_384]
                out[part] = self.forward([marked[k] for k in part], collect, np.ones(len(part)))
        return out


def _start(pieces: list[str], scores: list[float]) -> tuple[np.ndarray, np.ndarray, float]:
    s = np.array(scores)
    opens = np.array([p.startswith("▁") for p in pieces])
    follows = np.array([bool(p) and "▁" not in p for p in pieces])
    norm = lambda mask: np.where(mask, s, -np.inf) - np.logaddexp.reduce(s[mask])
    return norm(opens), norm(follows), 0.7


def _again(pieces: list[str], expected: np.ndarray, first: np.ndarray, later: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """New probabilities from expected counts; what was possible stays possible."""
    new = []
    for old, e in ((first, expected[0]), (later, expected[1])):
        e = np.where(np.isfinite(old), e + 0.01, 0.0)
        with np.errstate(divide="ignore"):
            new.append(np.log(e / e.sum()))
    total = expected.sum()
    return new[0], new[1], float(min(0.99, max(0.01, expected[1].sum() / total))) if total else 0.7


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _counted(classes: list[str]):
    at = {c: i for i, c in enumerate(classes)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(block, word, class, training count) with each word once, or a few times where a block has very many; class -1 holds no counts."""
        counts: dict[tuple[int, int], Counter] = {}

        def flush():
            seen: dict[int, set] = {}
            for (block, cls), c in sorted(counts.items(), key=lambda x: -x[0][1]):
                words = list(c) if cls >= 0 else [w for w in c if w not in seen.get(block, ())]  # a row that holds no count only where no other names the word
                if cls >= 0:
                    seen.setdefault(block, set()).update(words)
                for k in range(0, len(words), 50_000):
                    part = words[k : k + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([block] * len(part), pa.int64()), pa.array(part, pa.binary()), pa.array([cls] * len(part), pa.int64()), pa.array([c[w] if cls >= 0 else 0 for w in part], pa.int64())], ["block", "word", "class", "c"])
            counts.clear()

        for batch in batches:
            for block, out, text, lang in zip(*(batch.column(i).to_pylist() for i in range(4))):
                counts.setdefault((block, -1 if out else at.get(lang, len(at))), Counter()).update(tokens(text))
            if sum(map(len, counts.values())) > COUNTED:
                yield from flush()
        yield from flush()

    return run


def score_blocks(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Scores for ``docs`` (doc_id, text, lang, held_out, block): rows of a block are few enough for one task."""
    spark = docs.sparkSession
    small_batches(spark)
    of = docs.where(~F.col("held_out")).groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()  # a row for each language
    classes = [r["lang"] for r in of if r["lang"] is not None][:CLASSES]
    n = len(classes) + 1
    ends = np.array([sum(r["count"] for r in of if r["lang"] == c) for c in classes] + [sum(r["count"] for r in of if r["lang"] not in classes)], dtype=float)
    parts = materialise(docs.select("block", "held_out", "text", "lang").mapInArrow(_counted(classes), "block long, word binary, class long, c long"), "lm-parts")
    by_class = F.array(*(F.coalesce(F.sum(F.when(F.col("class") == i, F.col("c"))), F.lit(0)) for i in range(n)))
    words = materialise(parts.groupBy("word").agg(F.sum("c").alias("c"), by_class.alias("cs")), "lm-words")
    cs = F.col("cs")
    s = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2"), *(F.coalesce(F.sum(cs[i]), F.lit(0)).alias(f"n_{i}") for i in range(n)), *(F.count_if(cs[i] > 0).alias(f"v_{i}") for i in range(n))).first()
    total, distinct = s["n"] + int(ends.sum()), s["v"] + (1 if ends.sum() else 0)
    discount = min(0.95, max(0.05, s["n1"] / (s["n1"] + 2 * s["n2"]))) if s["n1"] + s["n2"] else 0.5
    totals = np.array([s[f"n_{i}"] for i in range(n)]) + ends
    rests = np.where(totals > 0, discount * np.array([s[f"v_{i}"] for i in range(n)]) / np.maximum(totals, 1), 1.0)
    rest = discount * s["v"] / total if total and s["v"] else (0.5 if not total else 1.0 / total)
    pieces, scores = vocabulary(path)
    first, later, go = _start(pieces, scores)
    for _ in range(rounds):
        first, later, go = _round(words, pieces, first, later, go)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces, first, later, go)
        for batch in gathered(batches):
            c = batch.column(1).to_numpy(zero_copy_only=False)
            each = np.array(batch.column(2).to_pylist(), dtype=float).reshape(len(c), n)
            logs = lattice.score([w.decode("utf-8", "surrogatepass") for w in batch.column(0).to_pylist()]) + math.log(rest)
            with np.errstate(divide="ignore"):
                logs = np.logaddexp(np.log(np.maximum(c - discount, 0) / max(total, 1)), logs)
                mixed = np.logaddexp(np.log(np.maximum(each - discount, 0) / np.maximum(totals, 1)), logs[:, None] + np.log(np.maximum(rests, 1e-9))) / LOG10
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(mixed.astype(np.float32).tolist(), pa.list_(pa.float32()))], ["word", "c", "logp"])

    table_ = materialise(words.mapInArrow(scored, "word binary, c long, logp array<float>"), "lm-scores")
    wanted = parts.select("block", "word").join(table_, "word").select("block", "word", "c", "logp")
    end = np.log10(np.maximum(ends, 1e-3) / np.maximum(totals, 1))
    prior = np.log10((ends + 0.5) / (ends + 0.5).sum())

    def texts(key, left: pa.Table, right: pa.Table) -> pa.Table:
        at = {w: k for k, w in enumerate(right.column("word").to_pylist())}
        c = right.column("c").to_numpy()
        logp = right.column("logp").combine_chunks().flatten().to_numpy().reshape(len(c), n)
        base = np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
        known = c > 0
        base_end = math.log10((ends.sum() + 0.5) / (total + 0.5 * (distinct + 1)))
        many, k, b, p = [], [], [], []
        for text in left.column("text"):
            i = np.array([at[w] for w in tokens(text.as_py())], dtype=np.int64)
            many.append(len(i) + 1)
            k.append(int(known[i].sum()) + (ends.sum() > 0))
            b.append(float(base[i].sum()) + base_end)
            p.append(float(np.logaddexp.reduce((logp[i].sum(axis=0, dtype=float) + end + prior) * LOG10)) / LOG10)
        return pa.table({"doc_id": left.column("doc_id"), "held_out": left.column("held_out"), "n_tokens": pa.array(many, pa.int64()), "n_known": pa.array(k, pa.int64()), "train_tokens": pa.array([total] * len(many), pa.int64()), "base_score": pa.array(b, pa.float64()), "score": pa.array(p, pa.float64())})

    out = docs.select("block", F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text").groupBy("block").cogroup(wanted.groupBy("block"))
    return out.applyInArrow(texts, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _round(words: DataFrame, pieces: list[str], first: np.ndarray, later: np.ndarray, go: float) -> tuple[np.ndarray, np.ndarray, float]:
    """One round of expectation maximisation over the distinct training words."""

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces, first, later, go)
        got = np.zeros((2, len(pieces)))
        for batch in gathered(batches):
            lattice.score([w.decode("utf-8", "surrogatepass") for w in batch.column(0).to_pylist()], got)
        where, piece = np.nonzero(got)
        yield pa.RecordBatch.from_arrays([pa.array(where.astype(np.int64)), pa.array(piece.astype(np.int64)), pa.array(got[where, piece])], ["later", "piece", "n"])

    rows = words.where("c > 0").select("word").mapInArrow(expect, "later long, piece long, n double").groupBy("later", "piece").agg(F.sum("n").alias("n")).toPandas()
    got = np.zeros((2, len(pieces)))
    got[rows["later"].to_numpy(int), rows["piece"].to_numpy(int)] = rows["n"].to_numpy(float)
    return _again(pieces, got, first, later)


def score(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Scores for any ``docs`` (doc_id, text, lang): they are written once, so that a block is a split of a file."""
    return score_blocks(blocked(materialise(docs.select("doc_id", "text", "lang"), "lm-texts")), path, rounds)


def blocked(docs: DataFrame) -> DataFrame:
    """``docs``, a plain scan of files, with held_out and the block of each row: its split of its file, or a part of that by its id."""
    split = F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("split")
    rows = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"), split)
    sizes = rows.groupBy("split").agg(F.ceil(F.sum(F.octet_length("text")) / BLOCK).alias("parts")).where("parts > 1")
    large = bounded(materialise(sizes, "lm-splits"))
    block = F.when(F.col("parts").isNull(), F.col("split")).otherwise(F.xxhash64("split", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.col("parts"))))
    return rows.join(large, "split", "left").select("doc_id", "text", "lang", "held_out", block.alias("block"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_blocks(blocked(table(spark, sf_dir, "documents")))


QUERIES = {"op8_lm_scoring": op8}
ORACLE_SQL: dict[str, str] = {}

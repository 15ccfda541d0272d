"""Toxicity: a lexicon learned from labels, Levenshtein automata over its trie, and context windows.

Learning: of the labelled rows that may be learned from, at most ``SAMPLE`` (those with the smallest hash of the id) are read, and of near
copies among them (equal least hashes of shingles) one. Words and beginnings of words that toxic texts have and clean ones lack make the lexicon,
kept as a trie. For a word, the states of its Levenshtein automaton (one edit, for terms of at least ``FUZZY`` letters) are carried
down the trie; a term that they reach is a match. A term's weight is its log lift; that of its misspellings is lifted or lowered by
how often they occur in toxic and in clean texts. Each match gets a score of its window of words: 1 inside quotation marks, ``REPORTED`` after a word of
reporting, 0 otherwise; by so much it is quoted and not abuse.

A logistic model over the sums of weights (used, quoted) and the share of words gives the score. Labelled rows hold few quoted terms, so that clean ones also come as a variant that
quotes a term and is still clean. Coefficients have the signs that they stand for, and are found by steps that never make the fit worse.

Scoring reads whole texts, and nothing but texts. The model is the terms of the sample and four coefficients, whatever the corpus.

Defined results: a null text is the empty text, which scores what the model gives without matches; without labelled rows of both kinds
nothing tells toxic texts apart, so that every text scores the smoothed share of toxic labels, below a half; rows that repeat score alike; empty
tables give empty tables; a document with several labels is toxic if one is; other columns are not read.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shingles
from .common import bounded, materialise, small_batches, table

#: Labelled rows that are learned from, at most.
SAMPLE = 20_000
#: Toxic texts that a term must be in, their share of all, and the least log lift of a term.
LEAST, SHARE, LIFT = 5, 0.005, 2.5
#: Sum of weights beyond which more terms say no more.
ENOUGH = 20.0
#: Weight of the rates of exact matches in those of misspelled ones, in texts.
PRIOR = 2.0
#: Letters of beginnings of words, and the least letters of a word and of a beginning that may be misspelled.
STEMS, FUZZY = (4, 8), (5, 7)
#: Words on each side that are looked at, and the share that a word of reporting takes from a match.
WINDOW, REPORTED = 6, 0.5
#: Quotation marks by family. Before a word one opens, and after a word it closes, whichever of the family it is: languages differ in that.
FAMILIES = {q: f for f, marks in enumerate(('"', "“”„", "«»", "‹›", "‘’", "`")) for q in marks}
QUOTES = "".join(FAMILIES)
REPORTING = frozenset("said says wrote called quote quoted word term insult sagte schrieb nannte wort dit écrit mot terme dijo escribió llamó palabra".split())
LOOKS_LIKE = str.maketrans("013457@$!", "oieastasi")
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "…–—¡¿" + QUOTES
#: Distinct words that a worker remembers, and terms that it counts before it passes them on; neither changes a result.
REMEMBERED, COUNTED = 300_000, 400_000


class Lexicon:
    """Terms as a trie; a term that ends in ``$`` is a whole word, any other the beginning of one."""

    def __init__(self, terms: list[str], fuzzy: bool = True):
        self.terms = terms
        self.trie: dict = {}
        for i, t in enumerate(terms):
            node = self.trie
            for ch in t.rstrip("$"):
                node = node.setdefault(ch, {})
            node.setdefault("", []).append((i, t.endswith("$")))
        self.stems = sorted({len(t) for t in terms if not t.endswith("$")})
        self.exact = {t.rstrip("$"): i for i, t in enumerate(terms) if t.endswith("$")}
        self.begins = {t: i for i, t in enumerate(terms) if not t.endswith("$")}
        # One edit leaves the first or the second half of a term as it is: a word without any such half reaches no term.
        self.heads, self.tails, self.inner = defaultdict(set), defaultdict(set), defaultdict(set)
        for t in terms:
            w = t.rstrip("$")
            if not fuzzy or len(w) < FUZZY[0 if t.endswith("$") else 1]:
                continue
            h = len(w) // 2
            if t.endswith("$"):
                for n in range(len(w) - 1, len(w) + 2):
                    self.heads[h].add((n, w[:h]))
                    self.tails[len(w) - h].add((n, w[h:]))
            else:
                self.inner[0, h].add(w[:h])
                for k in range(h - 1, h + 2):
                    self.inner[k, len(w) - h].add(w[h:])
        self.memory: dict[str, tuple[int, bool] | None] = {}

    def _possible(self, w: str) -> bool:
        n = len(w)
        for h, s in self.heads.items():
            if (n, w[:h]) in s:
                return True
        for h, s in self.tails.items():
            if (n, w[-h:]) in s:
                return True
        for (k, h), s in self.inner.items():
            if w[k : k + h] in s:
                return True
        return False

    def _found(self, w: str) -> tuple[int, bool] | None:
        if (i := self.exact.get(w)) is not None:
            return i, False
        for n in self.stems:
            if (i := self.begins.get(w[:n])) is not None:
                return i, False
        return self._walk(w) if self._possible(w) else None

    def _walk(self, w: str) -> tuple[int, bool] | None:
        """The automaton's states are a row of edit distances to the beginnings of ``w``, pruned beyond one edit: those of one letter
        fewer than the node's depth, as many, and one more. All others are over one."""
        best = None
        n = len(w)
        stack = [(self.trie, 2, 0, 1 if n else 2, 0)]
        while stack:
            node, a, b, c, depth = stack.pop()
            for i, whole in node.get("", ()):
                d = (a if depth - 1 == n else b if depth == n else c if depth + 1 == n else 2) if whole else min(a, b, c)
                if d == 1 and depth >= FUZZY[0 if whole else 1]:
                    if best is None or (d, -depth, i) < best:
                        best = (d, -depth, i)
            for ch, child in node.items():
                if not ch:
                    continue
                # The child's three states are at the beginnings of depth, depth + 1 and depth + 2 letters.
                x = 2 if depth > n else min(b + 1, 2 if depth < 1 else a + (w[depth - 1] != ch))
                y = 2 if depth + 1 > n else min(x + 1, c + 1, b + (w[depth] != ch))
                z = 2 if depth + 2 > n else min(y + 1, c + (w[depth + 1] != ch))
                if min(x, y, z) <= 1:
                    stack.append((child, x, y, z, depth + 1))
        return None if best is None else (best[2], best[0] > 0)

    def match(self, token: str) -> tuple[int, bool] | None:
        """(term, misspelled) of a token, or nothing."""
        try:
            return self.memory[token]
        except KeyError:
            pass
        w = token.strip(EDGES)
        found = self._found(w) if w else None
        if w and not w.isalpha() and (found is None or found[1]):
            v = "".join(c for c in w.translate(LOOKS_LIKE) if c.isalpha())
            alike = self._found(v) if v != w else None
            if alike is not None:
                found = found if found is not None and alike[1] else (alike[0], True)
        if len(self.memory) >= REMEMBERED:
            self.memory.clear()
        self.memory[token] = found
        return found

    def quoted(self, tokens: list[str], i: int, quotations: list[tuple[int, int]]) -> float:
        """How far the window around a match says that it is quoted, from 0 to 1: in full if a quotation begins and ends in it, around the match."""
        if any(i - WINDOW <= a <= i <= b <= i + WINDOW for a, b in quotations):
            return 1.0
        return REPORTED if any(t.strip(EDGES) in REPORTING for t in tokens[max(0, i - 2) : i]) else 0.0

    def found(self, tokens: list[str]) -> dict[int, tuple[int, bool]]:
        """The matches of a text: term and whether misspelled, by place."""
        memory, match = self.memory, self.match
        matched = {t: m for t in set(tokens) if (m := memory[t] if t in memory else match(t)) is not None}
        return {i: matched[t] for i, t in enumerate(tokens) if t in matched} if matched else {}

    def features(self, tokens: list[str], exact: list[float], missed: list[float]) -> list[float]:
        """Sums of weights of the different terms matched and of those quoted, up to ENOUGH; share of words; 1."""
        least: dict[tuple[int, bool], float] = {}
        hits = 0.0
        found = self.found(tokens)
        spans = quotations(tokens) if found else []
        for i, m in found.items():
            q = self.quoted(tokens, i, spans)
            least[m] = min(q, least.get(m, 1.0))
            hits += (1 - q) * (missed[m[0]] / exact[m[0]] if m[1] else 1.0)
        sums = [0.0, 0.0]
        for (term, miss), q in least.items():  # a term that is used somewhere is not quoted
            w = missed[term] if miss else exact[term]
            sums[0] += w * (1 - q)
            sums[1] += w * q
        return [*(min(x, ENOUGH) for x in sums), min(100.0 * hits / max(1, len(tokens)), 10.0), 1.0]


def quotations(tokens: list[str]) -> list[tuple[int, int]]:
    """The first and last token of each quotation that is opened and closed; quotations may lie in one another.

    A mark before a word opens (anew, if its family is open), one after a word closes what is open of its family, with all that was
    opened within. A mark that stands alone closes if its family is open, and opens otherwise. Marks within a word are none, nor are
    those that nothing opens or closes.
    """
    out: list[tuple[int, int]] = []
    opened: list[tuple[int, int]] = []  # (family, token)

    def mark(family: int, opens: bool | None, i: int) -> None:
        at = next((k for k in range(len(opened) - 1, -1, -1) if opened[k][0] == family), None)
        if opens is None:
            opens = at is None
        if at is not None:
            if not opens:
                out.append((opened[at][1], i))
            del opened[at:]
        if opens:
            opened.append((family, i))

    for i, t in enumerate(tokens):
        if t[:1].isalnum() and t[-1:].isalnum():
            continue
        head = len(t) - len(t.lstrip(EDGES))
        if head == len(t):
            for c in t:
                if c in FAMILIES:
                    mark(FAMILIES[c], None, i)
            continue
        for c in t[:head]:
            if c in FAMILIES:
                mark(FAMILIES[c], True, i)
        for c in t[len(t.rstrip(EDGES)) :]:
            if c in FAMILIES:
                mark(FAMILIES[c], False, i)
    return out


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def crc_of(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))  # 0 where there is no key


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic texts, clean texts), each term once, or a few times where a task has very many."""
    counts: dict[str, list[int]] = {}

    def flush():
        for k in range(0, len(counts), 50_000):
            part = dict(itertools.islice(counts.items(), k, k + 50_000))
            yield pa.RecordBatch.from_arrays([pa.array(list(part), pa.string()), *(pa.array([v[i] for v in part.values()], pa.int64()) for i in (0, 1))], ["term", "pos", "neg"])
        counts.clear()

    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = set()
            for t in set(words_of(text)):
                w = t.strip(EDGES)
                if w.isalpha():
                    found.add(w + "$")
                    found.update(w[:k] for k in range(STEMS[0], STEMS[1] + 1) if len(w) >= k)
            for t in found:
                counts.setdefault(t, [0, 0])[0 if toxic else 1] += 1
        if len(counts) > COUNTED:
            yield from flush()
    yield from flush()


def _copy_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic, k1, k2): two least hashes of the shingles, in which near copies agree as a rule."""
    for batch in batches:
        keys = []
        for text in batch.column(0).to_pylist():
            hashes, many = shingles.shingle_hashes([text], 3)
            with np.errstate(over="ignore"):
                keys.append([int(h.min()) >> 1 if many[0] else 0 for h in (hashes, hashes * np.uint64(0x9E3779B97F4A7C15))])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1))], ["text", "toxic", "k1", "k2"])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, learn_from: Column | None = None) -> dict:
    """The model: terms, their weights exact and misspelled, and the coefficients of the logistic model."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    rows = rows.where(crc_of(F.col("doc_id")) % 5 != 0 if learn_from is None else learn_from)
    chosen = rows.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = materialise(chosen, "toxicity-labels")
    read = docs.select("doc_id", "text").join(bounded(chosen), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "toxic")
    once = read.mapInArrow(_copy_keys, "text string, toxic int, k1 long, k2 long").groupBy("k1", "k2", "toxic").agg(F.min("text").alias("text"))
    train = materialise(once.select("text", "toxic"), "toxicity-sample")
    n = dict(train.groupBy("toxic").count().collect())
    pos, neg = n.get(1, 0), n.get(0, 0)
    empty = {"terms": [], "exact": [], "missed": [], "coefficients": [0.0] * 3 + [min(-0.01, float(np.log((pos + 0.5) / (neg + 0.5))))]}
    if not pos or not neg:
        return empty
    counts = train.mapInArrow(_term_counts, "term string, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    top = counts.where((F.col("pos") >= max(LEAST, SHARE * pos)) & (F.col("pos") * neg > F.col("neg") * pos)).collect()  # as many as the sample has
    model = _lexicon([(r["term"], r["pos"], r["neg"]) for r in top], pos, neg)
    if not model["terms"]:
        return empty
    _weigh_misspelled(model, train, pos, neg)
    found = train.mapInArrow(_examples(model), "toxic double, x array<double>").toPandas()
    x, y = np.array(found["x"].tolist(), dtype=float), found["toxic"].to_numpy(float)
    model["coefficients"] = _logistic(x, y, np.array([0, -np.inf, 0, -np.inf]), np.array([np.inf, 0, np.inf, np.inf])).tolist()
    if not np.isfinite(model["coefficients"]).all():
        raise ValueError(f"the toxicity model did not converge: {model['coefficients']}")
    return model


def _lexicon(counts: list[tuple[str, int, int]], pos: int, neg: int) -> dict:
    """Terms and their weights, out of (term, toxic texts, clean texts), of so many texts of each kind."""
    rows = [(p * lift, len(t), t, lift, p, q) for t, p, q in counts if p >= max(LEAST, SHARE * pos) and (lift := float(np.log((p + 0.5) / (pos + 1) * (neg + 1) / (q + 0.5)))) > LIFT]
    model, own, begun = {"terms": [], "exact": [], "missed": [], "counts": []}, set(), set()
    for _, _, term, lift, p, q in sorted(rows, key=lambda r: (-r[0], -r[1], r[2])):  # a beginning stands for the words that begin with it, unless they were chosen before
        w = term.rstrip("$")
        if w not in begun and not any(w[:k] in own for k in range(1, len(w) + 1)):
            own.add(w)
            begun.update(w[:k] for k in range(1, len(w) + 1))
            model["terms"].append(term)
            model["exact"].append(lift)
            model["counts"].append((p, q))
    return model


def _weigh_misspelled(model: dict, train: DataFrame, pos: int, neg: int) -> None:
    """Weights of misspelled terms: log lifts of their own counts, with the rates of the exact term as a prior."""
    seen = {r["term"]: (r["pos"], r["neg"]) for r in train.mapInArrow(_missed_counts(model["terms"]), "term long, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()}
    for i, (p, q) in enumerate(model.pop("counts")):
        p_, q_ = seen.get(i, (0, 0))
        rate = ((p_ + PRIOR * (p + 0.5) / (pos + 1)) / (pos + PRIOR)) / ((q_ + PRIOR * (q + 0.5) / (neg + 1)) / (neg + PRIOR))
        model["missed"].append(float(min(model["exact"][i], max(0.0, np.log(rate)))))


def _missed_counts(terms: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(term, toxic texts, clean texts) that have it misspelled."""
        lexicon = Lexicon(terms)
        counts: dict[int, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for i in {i for i, miss in lexicon.found(words_of(text)).values() if miss}:
                    counts.setdefault(i, [0, 0])[0 if toxic else 1] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), *(pa.array([v[k] for v in counts.values()], pa.int64()) for k in (0, 1))], ["term", "pos", "neg"])

    return run


def _examples(model: dict):
    """Features of the rows learned from and of their variants."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, exact, missed = model["terms"], model["exact"], model["missed"]
        lexicon = Lexicon(terms)
        of = lambda ws: lexicon.features(ws, exact, missed)
        for batch in batches:
            y, x = [], []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ws = words_of(text)
                x.append(of(ws))
                if not toxic:
                    k = zlib.crc32(text.encode("utf-8", "surrogatepass"))
                    at = k % (len(ws) + 1)
                    x.append(of([*ws[:at], '"' + terms[k % len(terms)].rstrip("$") + '"', *ws[at:]]))
                y += [float(toxic)] * (len(x) - len(y))
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.float64()), pa.array(x, pa.list_(pa.float64()))], ["toxic", "x"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray, low: np.ndarray, high: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps within bounds, with a ridge on all but the constant; a step that does not lower the loss is halved, so that it cannot run away."""
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    loss = lambda w: float(np.logaddexp(0, x @ w).sum() - y @ (x @ w) + (penalty * w * w).sum() / 2)
    w = np.clip(np.zeros(x.shape[1]), low, high)
    now = loss(w)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (p - y) + penalty * w
        free = ~((w <= low) & (slope > 0) | (w >= high) & (slope < 0))
        step = np.zeros_like(w)
        xf = x[:, free]
        step[free] = np.linalg.solve((xf * (p * (1 - p))[:, None]).T @ xf + np.diag(penalty[free]), slope[free])
        size = 1.0
        while size > 1e-9 and not (new := loss(np.clip(w - size * step, low, high))) < now - 1e-12:
            size /= 2
        if size <= 1e-9:
            break
        w, gained, now = np.clip(w - size * step, low, high), now - new, new
        if gained < 1e-9 * max(1.0, now):
            break
    return w


def _scores(texts: list[str | None], lexicon: Lexicon, model: dict) -> np.ndarray:
    x = np.array([lexicon.features(words_of(t), model["exact"], model["missed"]) for t in texts], dtype=float).reshape(-1, len(model["coefficients"]))
    return 1 / (1 + np.exp(-np.clip(x @ np.array(model["coefficients"]), -500, 500)))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of each row of ``docs``."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model["terms"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(batch.column(1).to_pylist(), lexicon, model))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def kept(docs: DataFrame, model: dict, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are not found to score ``limit`` or more, with their columns untouched."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model["terms"])
        for batch in batches:
            yield batch.filter(pa.array(~(_scores(batch.column(batch.schema.get_field_index("text")).to_pylist(), lexicon, model) >= limit)))

    return docs.mapInArrow(run, docs.schema)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, learn(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (crc_of(F.col("doc_id")) % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op9_toxicity": op9}
ORACLE_SQL: dict[str, str] = {}

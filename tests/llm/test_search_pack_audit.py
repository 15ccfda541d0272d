"""Packing, the filter audit and lexical search against plain versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.llm import filter_audit, lexical_search, packing

D = "/root/testdata/sf0.001"
WORDS = "lamp River stone GREEN walk over éclair Straße ciónñ fern's 42 x-ray naïve 中文 ﬁn İx".split()
CLASHES = ["ids", "part", "mask", "n", "step", "terms", "docs", "task", "item", "rank", "score", "window", "first", "words", "least", "bit", "length", "sequence_id", "text_key"]


def words(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", ",", "."]) for _ in range(n))


def odd_rows():
    rng = random.Random(4)
    rows = [(1, None, "a"), (2, "", None), (3, " \n\t", ""), (None, "no id here", "a"), (None, "no id here", "b"), (4, words(rng, 90), "a"), (4, words(rng, 30), "a"), (5, None, "b"), (6, words(rng, 9000), "b"), (7, "w" * 30_000, "a"), (8, "tie\ntie", "c"), (8, "tie\ntie", "c"), (9, "tie\ntie", "a"), (10, "ABC DEF #1", None), (11, "a<|endoftext|>b\x1fc d", "a")]
    base = words(rng, 70)
    return rows + [(20 + k, base if k % 3 == 0 else words(rng, rng.randint(0, 300)), rng.choice("abc")) for k in range(60)]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(odd_rows(), "doc_id long, text string, source string")
    return df.select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASHES)))


def checked(rows, out, width):
    """Every id of every document lies in one piece, and sequences have no gaps. Returns the padding's share."""
    tokenizer = packing.WordTokenizer(packing.vocabulary_path()).tokenizer
    sequences, of = defaultdict(list), defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append(r)
        of[r["doc_id"]].append(r)
    lengths = []
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= width
        lengths.append(at)
    want = defaultdict(list)
    for doc, text in rows:
        want[doc].append(np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4"))
    assert want.keys() == of.keys()
    for doc, texts in want.items():
        left = Counter((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in of[doc])
        for ids in texts:  # rows with one id may be cut in different ways: a chain of pieces from the start to the end
            at = 0
            while at < len(ids):
                step = next(k for k in left if k[0] == at and k[3] == len(ids) and left[k] and zlib.crc32(ids[at : at + k[1]].tobytes()) == k[2])
                left[step] -= 1
                at += step[1]
            assert at == len(ids)
        assert not +left
    return sum(width - n for n in lengths if n & (n - 1)) / sum(lengths)


@pytest.mark.parametrize("parts, fan, windows, slack", [(1, 64, 64, 8), (7, 2, 3, 8), (7, 2, 3, 0), (5, 3, 1, 10**6)])
def test_packing_of_odd_rows(spark, odd, parts, fan, windows, slack):
    out = packing.pack(odd.repartition(parts), windows=windows, fan=fan, slack=slack).collect()
    assert checked([(d, t) for d, t, _ in odd_rows()], out, 2048) < (0.2 if slack > 2048 else 0.01)


def test_packing_of_documents(spark):
    df = spark.read.parquet(f"{D}/documents.parquet")
    out = packing.pack(df.repartition(6))
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert checked([(r["doc_id"], r["text"]) for r in df.collect()], out.collect(), 2048) < 0.002
    assert packing.pack(df.limit(0)).count() == 0


def test_a_task_that_is_run_again_packs_alike(spark):
    df = spark.read.parquet(f"{D}/documents.parquet")
    assert sorted(packing.pack(df).collect()) == sorted(packing.pack(df).collect())


def test_word_ids_are_the_library_s():
    rng, tokens = random.Random(8), packing.WordTokenizer(packing.vocabulary_path())
    chars = "".join(map(chr, [*range(0x21, 0x7F), *range(0xC0, 0x180)])) + " \t\ńİ²ª中\U0001f600ẞ \x1c\x85\xa0Åǅ"
    texts = ["".join(rng.choice(chars if rng.random() < 0.7 else "'stremvld aA0") for _ in range(rng.randint(0, 40))) + rng.choice(["", "", " <|endoftext|>x"]) for _ in range(3000)]
    ids, ends = tokens.ids(packing.pa.array(texts))
    for t, a, b in zip(texts, ends, ends[1:]):
        assert ids[a:b].tolist() == tokens.tokenizer.encode(t, add_special_tokens=False).ids, t


def plain_audit(rows, labels):
    good, toxic = ({d for d, q, t in labels if d is not None and (q, t)[k] == 1} for k in (0, 1))
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    failing = []
    for d, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > first[t]}
        failing.append((s or "", {f for f, x in bad.items() if x}, d in good, d in toxic))
    out = {}
    for part in {p for p, *_ in failing}:
        own, total = [x for x in failing if x[0] == part], Counter()
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                before = set(order[:k])
                here = [x for x in own if f in x[1] and not x[1] & before]
                total[f] += len(here)
                out[part, order, k + 1] = [sum(not x[1] & {*before, f} for x in own), len(here), sum(f in x[1] and bool(x[1] & before) for x in own), sum(x[1] == {f} for x in own), sum(x[2] for x in here), sum(x[3] for x in here)]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(total[order[k - 1]])
    return out


def test_filter_audit_of_odd_rows(spark, odd):
    labels = [(4, 1, 0), (None, 1, 1), (5, None, None), (6, 0, 1), (8, 0, 0), (8, 1, 0), (20, 1, 1), (23, 1, 0), (26, 0, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("source", F.lit("x"))
    out = filter_audit.audit(filter_audit.cells(filter_audit.masked(odd), marks, 16), "ABCDE")
    assert {(r["part"], r["filter_order"], r["step"]): list(r[3:]) for r in out.collect()} == plain_audit(odd_rows(), labels)
    assert filter_audit.audit(filter_audit.cells(filter_audit.masked(odd.limit(0)), marks, 16), "ABCDE").count() == 0
    assert filter_audit.audit(filter_audit.cells(filter_audit.masked(odd), marks.limit(0), 16), "ABCDE").agg(F.sum("good_lost")).first()[0] == 0


def plain_search(docs, items, top=10):
    own = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    of = [(d, Counter(own(t))) for d, t in docs]
    n_docs, n_terms, df = sum(bool(c) for _, c in of), sum(sum(c.values()) for _, c in of), Counter(t for _, c in of for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in of:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, q in Counter(own(text)).items() if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("item_bytes, postings", [(10**6, 60_000), (60, 50)])
def test_lexical_search_of_odd_rows(spark, odd, monkeypatch, item_bytes, postings):
    items = [(1, "Lamp river lamp"), (1, "tie tie no here"), (2, None), (3, "..."), (None, "éclair STRASSE straße W"), (4, "nowhere")]
    monkeypatch.setattr(lexical_search, "POSTINGS", postings)
    found = lexical_search.ranked(odd.repartition(5), spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(0)), item_bytes=item_bytes)
    assert sorted(map(tuple, found.collect()), key=str) == plain_search([(d, t) for d, t, _ in odd_rows()], items)


def test_lexical_search_of_nothing(spark, odd):
    items = spark.createDataFrame([(1, "lamp")], "item_id long, text string")
    assert lexical_search.ranked(odd.limit(0), items).count() == 0 and lexical_search.ranked(odd, items.limit(0)).count() == 0


def test_norms_beyond_64_bits():
    lengths = np.array([10**7, 5], dtype=np.int64)
    assert lexical_search.norms(lengths, 10**12, 10**15).tolist() == [25 + 75 * n * 10**12 // 10**15 for n in lengths.tolist()]


@pytest.mark.parametrize("module, name", [(filter_audit, "op12_filter_audit"), (lexical_search, "op13_lexical_search")])
def test_new_queries_match_their_sql(spark, module, name):
    duck = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    df, want = module.QUERIES[name](spark, D), duck.execute(module.ORACLE_SQL[name])
    cols = [c[0] for c in want.description]
    assert sorted(cols) == sorted(df.columns) and sorted(want.fetchall()) == sorted(tuple(r[c] for c in cols) for r in df.collect())

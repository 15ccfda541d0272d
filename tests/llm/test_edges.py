"""Nulls, empty tables, repeated rows, long texts, clashing names; and brute-force versions of what SQL cannot say."""

import math
import random
import unicodedata
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from attesta.llm import byte_bpe, chat_formatting, decontamination, fingerprints, html_extraction, line_dedup, lm_scoring, simhash_dedup, suffix_dedup, toxicity

WORDS = "lamp river stone green walk over under moss fern cloud tower silver".split()


def words(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(n))


#: Columns that the operators use inside.
CLASHES = ["ld_lines", "ld_host", "ld_keys", "ld_kept", "sd_0", "sd_component", "h", "h1", "h2", "doc", "pos", "item", "sh", "start", "score", "x", "block", "split", "word", "key", "canon", "fingerprint", "spans", "marks", "texts", "main", "host", "found"]


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(1)
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "no id here"), (4, words(rng, 30)), (4, words(rng, 30)), (5, words(rng, 40)), (5, None), (6, words(rng, 60_000)), (7, "w" * 300_000), (8, "tie\ntie"), (8, "tie\ntie")]
    df = spark.createDataFrame([(i, t, None if k % 3 else "en", None if k % 2 else "s", None) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASHES)))


def test_no_operator_fails_on_odd_rows(spark, odd):
    items = spark.createDataFrame([(None, "x y z"), (1, None), (1, "tie tie"), (1, "tie tie")], "item_id long, text string").select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASHES)))
    labels = spark.createDataFrame([(4, 1, 0), (None, 1, 1), (5, None, None), (6, 0, 1), (8, 0, 0)], "doc_id long, quality int, toxic int").withColumn("text", F.lit("t"))
    n = odd.count()
    kept = line_dedup.drop_boilerplate(odd)
    assert kept.count() == n and {r["ld_host"] for r in kept.select("ld_host").collect()} == {1} and set(odd.columns) | {"ld_dropped"} == set(kept.columns)
    assert fingerprints.fingerprints(odd).count() == n and sorted((r["doc_id"] or 0, r["n_chars"]) for r in fingerprints.edited_fingerprints(odd).collect()) == sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in odd.collect())
    assert sorted(r["doc_id"] or 0 for r in simhash_dedup.near_duplicates(odd, 4, 1, 4).collect()) == sorted(r["doc_id"] or 0 for r in odd.collect())
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.matches(odd, items).collect()} == {(8, 1)} and decontamination.decontaminated(odd, items).count() == n - 2
    assert suffix_dedup.removed(odd).count() == n and byte_bpe.digests(odd).count() == n and lm_scoring.score(odd).count() == n
    model = toxicity.learn(odd, labels)
    assert toxicity.score(odd, model).count() == n and toxicity.kept(odd, model).columns == odd.columns
    pages = odd.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.concat(F.lit("<article><p>"), "text").alias("html"), *CLASHES)
    assert html_extraction.extract(pages).count() == n
    turns = odd.select(F.col("doc_id").alias("conv_id"), F.lit(1).alias("turn"), F.col("lang").alias("role"), "text", *CLASHES)
    assert chat_formatting.preferences(turns.withColumn("pair_id", F.lit(1)).withColumn("side", F.lit(1))).count() == 3  # 2 and 3, 4 and 5, 6 and 7
    none = odd.limit(0)
    assert [x.count() for x in (line_dedup.drop_boilerplate(none), fingerprints.fingerprints(none), html_extraction.extract(pages.limit(0)), chat_formatting.preferences(turns.limit(0)), decontamination.matches(none, items.limit(0)), simhash_dedup.first_of_each(none))] == [0] * 6


def test_decompositions_of_all_code_points(spark):
    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a".join(points[k : k + 256]) for k in range(0, len(points), 256)] + [c + "̣́" for c in points[0x100:0x3000:7]]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", fingerprints.decomposed(F.col("t")).alias("d")).collect()
    assert len(got) == len(texts) and [r["i"] for r in got if r["d"] != unicodedata.normalize("NFKD", texts[r["i"]])] == []


def test_decontamination_finds_what_all_windows_find(spark):
    rng = random.Random(17)
    split = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    items = [words(rng, rng.randint(15, 60)) for _ in range(25)]
    texts = []
    for k in range(250):  # runs and single words changed, left out and put in: similarities around the threshold
        w = split(rng.choice(items))
        for _ in range(rng.randint(0, max(1, len(w) // 12))):
            at = rng.randrange(len(w))
            w[at : at + rng.choice([1, 1, 2])] = rng.choice([["other"], [], [w[at], "more"]])
        texts.append(words(rng, rng.randint(0, 30)) + " " + " ".join(w) + " " + words(rng, rng.randint(0, 30)))
    sh = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    want = set()
    for d, t in enumerate(texts):
        w = split(t)
        for k, i in enumerate(items):
            x, n = sh(split(i)), len(split(i))
            if any(sum((x & y).values()) / sum((x | y).values()) >= 0.8 for a in range(max(1, len(w) - n + 1)) if (y := sh(w[a : a + n]))):
                want.add((d, k))
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.matches(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert got <= want and len(got) >= 0.97 * len(want) and 60 < len(want) < 240


PIECES = ["▁", "▁a", "a", "b", "ab", "ba", "▁ab", "bab", *(f"<0x{i:02X}>" for i in range(256))]


def test_lm_scores_against_brute_force(monkeypatch, spark):
    rng = random.Random(5)
    scores = [-float(k) for k in range(len(PIECES))]
    monkeypatch.setattr(lm_scoring, "vocabulary", lambda path=None: (PIECES, [-math.log(100.0 - s) for s in scores]))
    make = lambda: "".join(rng.choice("aabbc") for _ in range(rng.randint(1, 7)))
    rows = [(i, None if i == 7 else " ".join(make() for _ in range(rng.randint(0, 25))), rng.choice(["en", "de", None])) for i in range(60)]
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}

    train = [(t or "", g) for i, t, g in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    counts, by = Counter(w for t, _ in train for w in t.split()), {}
    for t, g in train:
        by.setdefault(g, Counter()).update(t.split())
    where = {p: k for k, p in enumerate(PIECES)}
    start = [-math.log(100.0 - s) for s in scores]
    opens, later = [p.startswith("▁") for p in PIECES], ["▁" not in p for p in PIECES]
    share = lambda ok: [math.exp(s) * o / sum(math.exp(x) for x, y in zip(start, ok) if y) for s, o in zip(start, ok)]
    first, more, go = share(opens), share(later), 0.7

    def ways(w, head=True):
        """All segmentations: pieces and probability."""
        if not w:
            yield [], 1 - go
            return
        for k in range(1, len(w) + 1):
            p = where.get(w[:k])
            if p is not None and (first if head else more)[p] > 0:
                tail = [((not head), p)], (first[p] if head else more[p] * go)
            elif k == 1 and not head:
                ids = [where[f"<0x{b:02X}>"] for b in w[0].encode()]
                tail = [(True, p) for p in ids], math.prod(more[p] * go for p in ids)
            else:
                continue
            for rest, q in ways(w[k:], False):
                yield tail[0] + rest, tail[1] * q

    lattice = lambda w: sum(q for _, q in ways("▁" + w))
    for _ in range(lm_scoring.ROUNDS):
        e = [[0.0] * len(PIECES), [0.0] * len(PIECES)]
        for w in counts:
            total = lattice(w)
            for pieces, q in ways("▁" + w):
                for side, p in pieces:
                    e[side][p] += q / total
        go_ = sum(e[1]) / (sum(e[0]) + sum(e[1]))
        new = []
        for old, got_ in ((first, e[0]), (more, e[1])):
            raised = [x + 0.01 if o > 0 else 0.0 for x, o in zip(got_, old)]
            new.append([x / sum(raised) for x in raised])
        first, more, go = new[0], new[1], min(0.99, max(0.01, go_))

    n1, n2 = sum(c == 1 for c in counts.values()), sum(c == 2 for c in counts.values())
    discount = min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5
    total = sum(counts.values()) + len(train)
    word = lambda w: max(counts[w] - discount, 0) / total + discount * len(counts) / total * lattice(w)
    langs = sorted({g for _, g in train if g}, key=lambda g: (-sum(x == g for _, x in train), g)) + [None]
    ends = {g: sum(x == g for _, x in train) for g in langs}
    size = {g: sum(by.get(g, Counter()).values()) + ends[g] for g in langs}

    def score(text):
        ws, out = (text or "").lower().split(), 0.0
        for g in langs:
            c = by.get(g, Counter())
            rest = discount * len(c) / size[g] if size[g] else 1.0
            p = (ends[g] + 0.5) / sum(x + 0.5 for x in ends.values()) * max(ends[g], 1e-3) / max(size[g], 1)
            for w in ws:
                p *= max(c[w] - discount, 0) / max(size[g], 1) + max(rest, 1e-9) * word(w)
            out += p
        return math.log10(out)

    assert all(abs(got[i] - score(t)) < 1e-4 * max(1, -score(t)) for i, t, _ in rows)


def test_words_of_any_length_get_a_score(spark):
    rows = [(1, "short words here"), (2, "y" * 60_000), (3, "é" * 20_000 + " end")]
    got = [r["score"] for r in lm_scoring.score(spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")).collect()]
    assert all(math.isfinite(x) and x < 0 for x in got)


def test_blocks_of_a_large_split_are_parted(monkeypatch, spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(i, words(rng, 20), "en") for i in range(200)], "doc_id long, text string, lang string").coalesce(1)
    whole = {r["doc_id"]: r["score"] for r in lm_scoring.score(df).collect()}
    monkeypatch.setattr(lm_scoring, "BLOCK", 4000)
    assert whole == {r["doc_id"]: pytest.approx(r["score"], abs=1e-6) for r in lm_scoring.score(df).collect()}

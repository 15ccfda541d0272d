"""The pipeline's stages against plain versions of them, on a small corpus with cases of every stage."""

import hashlib
import random
from collections import Counter

import pytest

from attesta.llm import byte_bpe

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORDS = [f"{a}{b}" for a in "lamp river stone green walk over moss fern".split() for b in "abcdefghijklm"]


def fresh(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng, folder = random.Random(30), tmp_path_factory.mktemp("sf")
    bench = [" ".join(fresh(rng, rng.randint(15, 30))) for _ in range(6)] + [None, ""]
    texts = []
    for i in range(240):
        t = fresh(rng, rng.randint(30, 90))
        if i % 6 == 0:
            t.insert(len(t) // 2, "blargish")
        if i % 24 == 1:
            t[10:10] = bench[i // 24 % 6].split()
        lines = [" ".join(t[:20]), *(["Read all our news"] if i % 5 else []), " ".join(t[20:])]
        texts.append("\n".join(lines))
    texts += [texts[2], texts[3].replace(" ", " x ", 1), None, "", "Read all our news", "one two", "z" * 50_000]
    docs = [(i, t, "en", None if i % 9 == 0 else f"s{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(2).write.parquet(f"file://{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").coalesce(1).write.parquet(f"file://{folder}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(240)], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"file://{folder}/labels.parquet")
    return f"file://{folder}", docs, bench


def no_boilerplate(docs):
    pages, seen = Counter(d[3] for d in docs), Counter()
    for d in docs:
        for x in {x.strip(" \t\r") for x in (d[1] or "").split("\n")} - {""}:
            seen[d[3], x] += 1
    bad = {k for k, n in seen.items() if n >= 5 and n > 0.05 * pages[k[0]]}
    out = []
    for i, t, lang, s, n in docs:
        if t is not None:
            kept = "\n".join(x for x in t.split("\n") if (s, x.strip(" \t\r")) not in bad)
            t, n = kept, (len(kept) if kept != t else n)
        out.append((i, t, lang, s, n))
    return out


def one_of_each(docs):
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {d[0]: shingles(d[1]) for d in docs}
    root = {i: i for i in sets}
    find = lambda i: i if root[i] == i else find(root[i])
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and (not sets[a] and not sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) > 0):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [d for d in docs if find(d[0]) == d[0]]


def clean_of(docs, bench):
    split = lambda t: "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()
    sh = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))

    def leaks(t):
        w = split(t)
        for item in bench:
            x, n = sh(split(item)), len(split(item))
            for a in range(max(1, len(w) - n + 1)) if x else ():
                y = sh(w[a : a + n])
                if y and sum((x & y).values()) >= 0.8 * sum((x | y).values()):
                    return True
        return False

    return [d for d in docs if not leaks(d[1])]


def test_stages_against_plain_versions(spark, corpus):
    import tiktoken

    import corpus_pipeline

    sf, docs, bench = corpus
    plain = {
        "toxicity": lambda x: [d for d in x if "blargish" not in (d[1] or "")], "line dedup": no_boilerplate, "SimHash near-dedup": one_of_each, "benchmark decontamination": lambda x: clean_of(x, bench),
    }
    df, want = spark.read.parquet(f"{sf}/documents.parquet"), docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, want = len(want), plain[name](want)
        out = stage(spark, df, sf)
        assert out.columns == COLUMNS
        got = sorted(tuple(r) for r in out.collect())
        assert got == sorted(want), name
        assert len(want) < before or name == "line dedup"
        df = spark.createDataFrame(got, "doc_id long, text string, lang string, source string, n_chars long")
    path, pattern = byte_bpe.vocabulary_path()
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={k: v for k, v in ((__import__("base64").b64decode(a), int(b)) for a, b in map(bytes.split, open(path, "rb")))}, special_tokens={})
    final = {d[0]: enc.encode_ordinary(d[1] or "") for d in want}
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in rows} == {i: (len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest()) for i, x in final.items()}
    assert all(r["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest() for r in rows for i, t, *_ in want if i == r["doc_id"])


def test_stages_of_odd_tables(spark, corpus):
    import corpus_pipeline

    sf, docs, _ = corpus
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], schema), sf).count() == 0, name
        odd = [(None, None, None, None, None), (1, "a b", "en", "s", 3), (1, "a b", "en", "s", 3), (2, "k" * 100_000, None, None, None)]
        out = stage(spark, spark.createDataFrame(odd, schema), sf)
        assert out.count() in (2, 3, 4), name


def test_labels_of_one_kind_keep_all(spark, corpus, tmp_path):
    import corpus_pipeline

    sf, docs, _ = corpus
    spark.read.parquet(f"{sf}/documents.parquet").write.parquet(f"file://{tmp_path}/documents.parquet")
    for toxic in (0, 1):
        spark.createDataFrame([(i, 1, toxic) for i in range(240)], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"file://{tmp_path}/labels.parquet")
        assert corpus_pipeline.without_toxic(spark, spark.read.parquet(f"{sf}/documents.parquet"), f"file://{tmp_path}").count() == len(docs)


def test_an_emptied_corpus_is_an_error(monkeypatch, spark, corpus):
    import corpus_pipeline

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("nothing", lambda s, d, f: d.limit(0)), *corpus_pipeline.STAGES[-1:]])
    with pytest.raises(RuntimeError):
        corpus_pipeline.run(spark, corpus[0])

import base64
import hashlib
import math
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.llm import byte_bpe, chat_formatting, components, decontamination, fingerprints, html_extraction, line_dedup, lm_scoring, shingles, simhash_dedup, suffix_dedup, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, ld_lines int, sd_0 string, key string"
WORDS = "the of and lamp river stone green walk éclair straße 12 over under moss fern".split()


def quoted(lex, text, i):
    return lex.quoted(text.split(), i, toxicity.quotations(text.split()))


def words(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing", "er", ","]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out = [None, "", " \t\n", "a", "one two three", words(rng, 4000), "̣́x é", "日本語 テキスト", "x" * 700, "tie\ntie\ntie"]
    base = words(rng, 120)
    out += [base, base, base + " more", base.replace("lamp", "lamps", 1), words(rng, 60) + "\n" + base[:300] + "\n" + words(rng, 60)]
    return out + [words(rng, rng.randint(3, 200)) for _ in range(40)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}", None, 1, "x", "y") for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_line_dedup(spark, empty):
    rows = [(i, f"menu \nbody {i}\n\nmenu", "en", "h" if i < 20 else None, None, 1, "x", "y") for i in range(24)] + [(99, None, None, "h", None, 1, "x", "y")]
    out = {r["doc_id"]: r for r in line_dedup.drop_boilerplate(spark.createDataFrame(rows, DOCS).drop("ld_lines")).collect()}
    assert out[3]["text"] == "body 3\n" and out[3]["ld_dropped"] == 2 and out[3]["ld_lines"] == 4
    assert out[99]["text"] is None and out[99]["ld_lines"] == 0
    assert out[22]["text"] == "menu \nbody 22\n\nmenu"  # four pages of a host without a name
    assert line_dedup.drop_boilerplate(empty.drop("ld_lines")).count() == 0


def plain_canonical(t):
    t = unicodedata.normalize("NFKD", t or "").upper()
    return " ".join(t.lower().split())


def test_fingerprints_against_python(docs, texts, empty):
    out = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(docs).collect()}
    edited = []
    for i, t in enumerate(texts):
        t, n = t or "", texts[(i + 1) % len(texts)] or ""
        k = len(t) // 4
        edited.append(t[: len(t) - k] + n[:k])
        assert out[i]["n_chars"] == len(t) and out[i]["edited_sha256"] == hashlib.sha256(edited[-1].encode()).hexdigest()
    pairs = [(plain_canonical(t), out[i]["fingerprint"]) for i, t in enumerate(texts)] + [(plain_canonical(t), out[i]["edited_fingerprint"]) for i, t in enumerate(edited)]
    assert len(set(pairs)) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    assert all(r["near_next"] == float(r["fingerprint"] == out[(i + 1) % len(texts)]["fingerprint"]) for i, r in out.items())
    assert fingerprints.edited_fingerprints(empty).count() == 0
    assert len({r["fingerprint"] for r in fingerprints.fingerprints(docs).collect()}) == len({plain_canonical(t) for t in texts})


def test_colliding_hashes_are_told_apart_by_bytes(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (1, 1, "a"), (2, 2, "c"), (2, 2, "c")], "h1 long, h2 long, canon string")
    assert sorted((r["canon"], r["ordinal"]) for r in fingerprints.colliding(df).collect()) == [("a", 0), ("b", 1)]


def test_next_ids_of_any_spread(spark):
    ids = sorted({0, 1, 5, 1023, 1024, 10**6, 2**40, 2**62, -3, -(2**50)})
    out = dict(map(tuple, fingerprints.next_ids(spark.createDataFrame([(i,) for i in ids], "id long")).collect()))
    assert out == {a: b for a, b in zip(ids, ids[1:] + ids[:1])}


def test_html(spark):
    page = '<html><head><title>t</title></head><body><header>H</header><nav><ul><li>menu</ul></nav><div class="cookie-notice">c</div><article><h1>T &amp; x</h1><p>one\n two<br>three<p>four <b>{}</b><script>x</script></article><section id="comments"><article>bad</article></section><footer>f</footer>'
    rows = [(i, "http://h/x", page.format(i), 1) for i in range(4)] + [(9, None, None, 1), (10, "no url", "plain", 1), (11, "http://g", '<div class="menu">m</div><div class="c"><p>a</p></div>', 1)]
    out = {r["page_id"]: r["text"] for r in html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host int").drop("host")).collect()}
    assert out[2] == "T & x\n\none two three\n\nfour 2" and out[9] == "" and out[10] == "plain" and out[11] == "a"
    site = [(i, "http://s/x", f"<body><div id=c><p>Read more here</p><p>own {i}</p></div><div><p>x</p></div>") for i in range(9)]
    assert {r["page_id"]: r["text"] for r in html_extraction.extract(spark.createDataFrame(site, "page_id long, url string, html string")).collect()}[4] == "own 4"
    assert html_extraction.text_of(page.format(7), set(), None) == "T & x\n\none two three\n\nfour 7"
    assert html_extraction.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def texts_of_pages(spark, rows):
    return {r["page_id"]: r["text"] for r in html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_html_without_article_keeps_headings_and_lists(spark):
    page = '<body><div class="w-1/2"><div class=top><p>Site</p></div><div class=c><h1>Title {0}</h1><div class=t><p>{1}</p><h2>Part {0}</h2><ul><li>item {0}</li></ul><blockquote>said {0}</blockquote><p class=x>other {0}</p></div></div><div class=r><p>see {0}</p></div></div>'
    out = texts_of_pages(spark, [(i, "http://d/x", page.format(i, f"long text {i} " * 9)) for i in range(9)])
    long = " ".join(["long text 4"] * 9)
    assert out[4] == f"Title 4\n\n{long}\n\nPart 4\n\nitem 4\n\nsaid 4\n\nother 4"


def test_html_keeps_articles_that_are_repeated(spark):
    page = "<body><p>{}</p><article><h1>One</h1><h2>Summary</h2><p>text {}</p></article>"
    out = texts_of_pages(spark, [(i, "http://a/x", page.format(i, "same" if i < 9 else i)) for i in range(12)])
    assert out[3] == "One\n\nSummary\n\ntext same" and out[11] == "One\n\nSummary\n\ntext 11"
    out = texts_of_pages(spark, [(i, "http://b/x", "<body><div><p>copied text</p></div>" if i < 9 else f"<body><div><p>own {i}</p></div>") for i in range(12)])
    assert out[3] == "copied text" and out[11] == "own 11"


def test_html_keeps_what_is_named_like_a_part_but_is_article(spark):
    body = '<nav>menu</nav><article><div class="article-header"><h1>Title {0}</h1></div><h1 class="page-header">Second {0}</h1><p>long text of page {0}</p><section class="related-work"><p>others {0}</p></section><p class="side-effects">harm {0}</p><aside><p>aside {0}</p></aside><div class="ad">buy</div></article>'
    for n in (1, 5):  # without and with a template
        out = texts_of_pages(spark, [(i, f"http://n{n}/x", body.format(i)) for i in range(n)])
        assert out[0] == "Title 0\n\nSecond 0\n\nlong text of page 0\n\nothers 0\n\nharm 0\n\naside 0"


def test_html_template_is_that_of_the_occurrence_vectors(spark):
    rng = random.Random(21)
    rows = []
    for host in range(6):
        for i in range(rng.choice([2, 4, 7, 9])):
            parts = ["<div class=top><p>Site</p>" + "".join(f"<a>{x}</a>" for x in "ab"[: rng.randint(1, 2)]) + "</div>"]
            if rng.random() < 0.7:
                parts.append(f"<div class=x><p>{rng.choice(['same', words(rng, 2)])}</p></div>")
            parts.append("<div class=c><p>Read on</p>" + "".join(f"<p>{words(rng, rng.randint(1, 9))}</p>" for _ in range(rng.randint(1, 4))) + "</div>")
            parts += ["<div class=r><ul>" + "".join(f"<li>{rng.choice('pqr')}</li>" for _ in range(rng.randint(1, 3))) + "</ul></div>"] * rng.randint(0, 1)
            rows.append((len(rows), f"http://h{host}/{i}", "<body>" + "".join(parts)))
    got = {r["host"]: (set(r["texts"]), r["main"]) for r in html_extraction.templates(spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string")).collect()}
    key, clean, around = html_extraction._key, html_extraction._clean, html_extraction._around
    want = {}
    for host in {u.split("/")[2] for _, u, _ in rows}:
        pages = sorted({p for _, u, p in rows if u.split("/")[2] == host})
        opens, texts = Counter(), Counter()
        for n, p in enumerate(pages):
            for t in html_extraction.tokens(p):
                if t[0] == "open":
                    opens[t[1], n] += 1
                elif t[0] == "text" and clean(t[4]):
                    texts[(t[1], clean(t[4])), n] += 1
        vector = lambda c, k: tuple(c[k, n] for n in range(len(pages)))
        valid = lambda v: sum(map(bool, v)) >= max(html_extraction.LEAST_PAGES, html_extraction.SUPPORT * len(pages))
        elements = {p: vector(opens, p) for p, _ in opens if valid(vector(opens, p))}
        constant = {k for k, _ in texts if valid(v := vector(texts, k)) and any(elements.get("/".join(k[0].split("/")[:j])) == v for j in range(1, len(k[0].split("/")) + 1))}
        slots = {(k, n): c * len(k[1]) for (k, n), c in texts.items() if k not in constant}
        chars = {p: sum(c for (k, _), c in slots.items() if p in around(k[0])) for p in elements}
        own = {p: sum(c for (k, _), c in slots.items() if around(k[0])[-1:] == [p]) for p in elements}
        best = max((p for p, v in elements.items() if set(v) <= {0, 1} and chars[p] and chars[p] * 2 > max(chars.values())), key=lambda p: (p.count("/"), chars[p], p), default=None)
        while best and (outer := [p for p in around(best)[:-1] if p in elements]) and own[outer[-1]]:
            best = outer[-1]
        if elements:
            want[host] = ({key("text", p, x) for p, x in constant}, best)
    assert got == want and any(t for t, _ in want.values()) and any(m and m.endswith("div.c") for _, m in want.values())


def plain_simhash(t, width):
    import xxhash

    ws = shingles.words_of(t)
    sh = [b" ".join(ws[i : i + width]) for i in range(max(1, len(ws) - width + 1))] if ws else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum((2 * sum(h >> b & 1 for h in hs) > len(hs)) << b for b in range(64)) if hs else 0


@pytest.mark.parametrize("bucket", [1024, 3])
def test_simhash_components(monkeypatch, docs, texts, empty, bucket):
    monkeypatch.setattr(simhash_dedup, "BUCKET", bucket)
    prints = [plain_simhash(t, 4) for t in texts]
    assert shingles.fingerprints(texts, 4).tolist() == prints
    root = list(range(len(texts)))
    for _ in texts:
        root = [min(root[j] for j in range(len(texts)) if bin(prints[i] ^ prints[j]).count("1") <= 4) for i in range(len(texts))]
    out = {r["doc_id"]: r for r in simhash_dedup.near_duplicates(docs, 4, 1, 4).collect()}
    assert [out[i]["sd_component"] for i in range(len(texts))] == root
    assert simhash_dedup.near_duplicates(empty, 4, 1, 4).count() == 0


def test_first_of_each_keeps_one_of_near_copies(spark):
    rng = random.Random(1)
    base = [words(rng, 300) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, t.replace("river", "rivet", 1)) for i, t in enumerate(base)] + [(200, base[0]), (200, base[0])]
    kept = simhash_dedup.first_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(12))


@pytest.mark.parametrize("left", [1, 2, 3])
def test_remainder_of_a_large_bucket_is_passed_on(left):
    import pyarrow as pa

    names = ["key", "sd_0"]
    parts = [[(7, i) for i in range(6)], [(7, 100 + i) for i in range(left)] + [(8, 0), (8, 1)]]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*p)], names) for p in parts]
    out = [r for b in simhash_dedup._bucket_links(1, 1, 4, 4)(iter(batches)) for r in b.to_pylist()]
    assert sorted(r["a0"] for r in out if r["key"] == 7) == [*range(6), *range(100, 100 + left)]
    assert [(r["a0"], r["b0"]) for r in out if r["key"] is None] == [(1, 0)]


@pytest.mark.parametrize("bucket", [1024, 6])
def test_first_of_each_decides_by_exact_similarity(monkeypatch, spark, bucket):
    monkeypatch.setattr(simhash_dedup, "BUCKET", bucket)
    rng = random.Random(8)
    fresh = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    rows = []
    for k in range(120):  # one run of changed words: similarities from 0.7 to 0.9, and short texts
        n = rng.choice([14, 30, 200, 400])
        base, cut = fresh(n), rng.randint(n // 20, n // 6)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[: n - cut] + fresh(cut)))]
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    far = {i for i in sets if i % 2 and len(sets[i] & sets[i - 1]) / len(sets[i] | sets[i - 1]) < 0.8}
    assert 20 < len(far) < 100
    kept = {r["doc_id"] for r in simhash_dedup.first_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept & set(range(1, 240, 2)) == far and set(range(0, 240, 2)) <= kept
    sets = [np.unique(np.array([hash(x) & (2**62 - 1) for x in s], np.uint64)) for s in sets.values()]
    assert sorted((min(p), max(p)) for p in simhash_dedup._alike(sets, 0.8)) == [(i - 1, i) for i in range(1, 240, 2) if i not in far]


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 51)], "a long, b long")
    assert dict(map(tuple, components.components(links).collect())) == {**{i: 0 for i in range(41)}, 50: 50, 51: 50}


def test_decontamination_against_brute_force(spark, empty):
    rng = random.Random(2)
    items = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(40)) for _ in range(6)] + ["short item", "", None]
    filler = lambda n: " ".join(f"v{rng.randint(0, 400)}" for _ in range(n))
    near = items[3].split()
    near[20] = "changed"
    rows = [filler(80) + " " + items[0].upper() + ". " + filler(50), items[1], filler(30) + " " + " ".join(near), items[4][: len(items[4]) // 2], filler(100), None, "", "short item"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 3) for r in decontamination.matches(docs, bench).collect()}
    sh = lambda t: Counter(tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))) if t else Counter()
    split = lambda t: "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()
    want = {}
    for d, t in enumerate(rows):
        for k, i in enumerate(items):
            n, w, it = len(split(i)), split(t), sh(split(i))
            for a in range(max(1, len(w) - n + 1)):
                win = sh(w[a : a + n])
                if it and win and (s := sum((it & win).values()) / sum((it | win).values())) >= 0.8:
                    want[d, k] = max(want.get((d, k), 0), round(s, 3))
    assert got == want and set(want) == {(0, 0), (1, 1), (7, 6)} | ({(2, 3)} if (2, 3) in want else set())
    assert sorted(r["doc_id"] for r in decontamination.decontaminated(docs, bench).collect()) == sorted(set(range(8)) - {d for d, _ in want})
    assert decontamination.matches(empty, bench).count() == 0 and decontamination.matches(docs, bench.limit(0)).count() == 0


def test_decontamination_finds_short_items_in_long_texts(spark):
    docs = spark.createDataFrame([(0, "before it we go to The Lamp, river again and The lamp river"), (1, "the lamp is a river of light"), (2, "lamp river"), (3, "four words are enough"), (4, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(0, "the lamp river"), (1, "river"), (2, "Are. four words enough"), (3, "four words are enough"), (4, "two\nlamps")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start_word"]) for r in decontamination.matches(docs, bench).collect()}
    assert got == {(0, 0): (1.0, 5), (0, 1): (1.0, 7), (1, 1): (1.0, 4), (2, 1): (1.0, 1), (3, 3): (1.0, 0)}
    assert sorted(r["doc_id"] for r in decontamination.decontaminated(docs, bench).collect()) == [4]


def test_bpe_is_tiktoken(docs, texts, empty):
    import tiktoken

    path, pattern = byte_bpe.vocabulary_path()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rows = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    for r in rows:
        assert r["ids"] == enc.encode_ordinary(r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode()
    d = {r["doc_id"]: r for r in byte_bpe.digests(docs).collect()}
    for r in rows:
        assert d[r["doc_id"]]["n_tokens"] == len(r["ids"]) and d[r["doc_id"]]["ids_sha256"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest()
    assert byte_bpe.digests(empty).count() == 0


def plain_suffix_dedup(texts):
    seen, want = set(), []
    for t in texts:
        b = (t or "").encode()
        cov = bytearray(len(b))
        for k in range(len(b) - 99):
            if (w := b[k : k + 100]) in seen:
                cov[k : k + 100] = b"\1" * 100
            seen.add(w)
        want.append((len(b), bytes(c for c, f in zip(b, cov) if not f), sum(1 for k in range(len(b)) if cov[k] and (not k or not cov[k - 1]))))
    return want


@pytest.mark.parametrize("hot", [4096, 1])
def test_suffix_dedup_against_brute_force(monkeypatch, spark, docs, texts, empty, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    want = dict(enumerate(plain_suffix_dedup(texts)))
    out = suffix_dedup.removed(docs).collect()
    assert {r["doc_id"]: (r["n_bytes"], bytes(r["kept"]), len(r["spans"])) for r in out} == want
    assert suffix_dedup.removed(empty).count() == 0


def test_suffix_dedup_of_ids_that_repeat(spark, texts):
    some = [t or "" for t in texts[5:30]]
    rows = [(i // 3 if i < 20 else None, t) for i, t in enumerate(some + some[:4])]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = sorted((-1 if i is None else i, *w) for (i, _), w in zip(order, plain_suffix_dedup([t for _, t in order])))
    out = suffix_dedup.removed(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], bytes(r["kept"]), len(r["spans"])) for r in out) == want


def test_suffix_dedup_of_a_passage_that_all_documents_share(monkeypatch, spark):
    monkeypatch.setattr(suffix_dedup, "HOT", 64)
    monkeypatch.setattr(suffix_dedup, "HELD", 500)
    rng = random.Random(11)
    passage = words(rng, 40)
    texts = [words(rng, rng.randint(0, 12)) + " " + passage[: rng.choice([120, 150, len(passage)])] + " " + words(rng, rng.randint(0, 12)) for _ in range(1500)]
    out = suffix_dedup.removed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_bytes"], bytes(r["kept"]), len(r["spans"])) for r in out} == dict(enumerate(plain_suffix_dedup(texts)))


def test_every_string_has_one_anchor():
    rng = random.Random(4)
    for data in (words(rng, 300).encode(), b"x" * 400, b"ab" * 150 + b"c" * 130, bytes(rng.choice(b"ab") for _ in range(900)), b"y" * 99):
        at, h, low, high = suffix_dedup.anchors(data)
        starts = [(s, p, v) for p, v, a, b in zip(at, h, low, high) for s in range(a, b + 1)]
        assert sorted(s for s, _, _ in starts) == list(range(max(0, len(data) - 99)))
        by = {}
        for s, p, v in starts:
            assert by.setdefault(data[s : s + 100], (p - s, v)) == (p - s, v)


def test_merged_transform_orders_like_one_sort():
    a, b = [b"banana", b"band", b"\0\0"], [b"ban", b"bandana", b""]
    z, place, block = suffix_dedup.merged_blocks(a, b, 3)
    joined = [b"\0".join(x) + b"\0" for x in (a, b)]
    tails = [joined[s][p : p + 3] for s, p in zip(z, place)]
    full = [t for t in zip(tails, block) if b"\0" not in t[0]]
    assert [t for t, _ in full] == sorted(t for t, _ in full)
    assert all((x[0] == y[0]) == (x[1] == y[1]) for x, y in zip(full, full[1:]))


def test_lm_scores(docs, texts, empty):
    out = {r["doc_id"]: r for r in lm_scoring.score(docs).collect()}
    end, c = object(), Counter()
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 5 != 1:
            c.update(lm_scoring.tokens(t))
            c[end] += 1
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(texts):
        tk = [*lm_scoring.tokens(t), end]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tk)
        r = out[i]
        assert abs(r["base_score"] - base) < 1e-6 * max(1, -base) and (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tk), sum(c[w] > 0 for w in tk), n)
        assert math.isfinite(r["score"]) and r["score"] < 0
    assert lm_scoring.score(empty).count() == 0


def test_lattice_sums_all_segmentations():
    pieces, scores = ["▁", "▁a", "a", "b", "ab", "▁ab", *(f"<0x{i:02X}>" for i in range(256))], [-1.0] * 262
    lattice = lm_scoring.Lattice(pieces, *lm_scoring._start(pieces, scores))
    p = {x: i for i, x in enumerate(pieces)}

    def brute(w, first=True):
        if not w:
            return math.exp(lattice.stop)
        return sum(math.exp((lattice.first if first else lattice.later)[p[w[:k]]] + (0 if first else lattice.go)) * brute(w[k:], False) for k in range(1, len(w) + 1) if w[:k] in p and math.isfinite((lattice.first if first else lattice.later)[p[w[:k]]]))

    for w in ("ab", "aab", "bab", ""):
        assert abs(lattice.score([w])[0] - math.log(brute("▁" + w))) < 1e-9 and abs(lattice.long("▁" + w) - math.log(brute("▁" + w))) < 1e-9
    assert np.isfinite(lattice.score(["é", "zé" * 40])).all()


def test_long_words_are_learned_from_as_short_ones_are(monkeypatch):
    assert lm_scoring.ROUNDS == 3
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "▁ab", *(f"<0x{i:02X}>" for i in range(256))]
    lattice = lm_scoring.Lattice(pieces, *lm_scoring._start(pieces, [-1.0] * len(pieces)))
    got = []
    for most in (48, 200):
        monkeypatch.setattr(lm_scoring, "WORD", most)
        got.append(np.zeros((2, len(pieces))))
        lattice.score(["ab" * 30 + "é" + "b" * 20, "a" * 60], got[-1])
    assert got[0].sum() > 40 and np.allclose(*got, rtol=1e-9)


def test_levenshtein_automaton():
    lex = toxicity.Lexicon(["idiot$", "scum$", "lowei", "disgust"])
    exact = {"idiot": 0, "Idiot!".lower(): 0, "loweixy": 2, "disgusting": 3, "scum,": 1}
    assert all(lex.match(w) == (i, False) for w, i in exact.items())
    assert all(lex.match(w) == (i, True) for w, i in {"idot": 0, "1diot": 0, "idiott": 0, "odiot": 0, "disgsting": 3}.items())
    assert [lex.match(w) for w in ("idoti", "scun", "the", "", "lowex")] == [None] * 5
    assert quoted(lex, 'he said "you idiot" then', 3) and not quoted(lex, "you idiot then", 1)


def test_levenshtein_automaton_against_whole_rows():
    rng = random.Random(4)
    make = lambda a, b: "".join(rng.choice("abc") for _ in range(rng.randint(a, b)))
    terms = sorted({make(4, 9) + rng.choice(["", "$"]) for _ in range(60)})
    lex, found = toxicity.Lexicon(terms), 0

    def plain(w):
        best = []
        for i, t in enumerate(terms):
            u, row = t.rstrip("$"), list(range(len(w) + 1))
            for ch in u:
                new = [row[0] + 1]
                for k in range(1, len(w) + 1):
                    new.append(min(new[-1] + 1, row[k] + 1, row[k - 1] + (w[k - 1] != ch)))
                row = new
            if (row[-1] if t.endswith("$") else min(row)) == 1 and len(u) >= toxicity.FUZZY[0 if t.endswith("$") else 1]:
                best.append((1, -len(u), i))
        return (min(best)[2], True) if best else None

    for w in [make(0, 11) for _ in range(2000)]:
        assert lex._walk(w) == plain(w)
        found += plain(w) is not None
    assert found > 100


def test_toxicity_learns_terms_of_one_in_a_hundred(spark):
    rng = random.Random(6)
    text = lambda i: words(rng, 30) + (f" {'abcdefgh'[i % 8] * 4}zz" if i < 64 else " blarg" if i < 800 else "")
    docs = spark.createDataFrame([(i, text(i)) for i in range(1600)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 800)) for i in range(1600)], "doc_id long, toxic int")
    terms = toxicity.learn(docs, labels, learn_from=F.lit(True))["terms"]  # eight words, each in 8 of 800 toxic texts
    assert all(any(f"{c * 4}zz".startswith(t.rstrip("$")) for t in terms) for c in "abcdefgh")


def test_toxicity_learns_and_keeps_clean_documents(spark, empty):
    rng = random.Random(3)
    rows = [(i, words(rng, 60) + (" blarg " + words(rng, 5) if i % 4 == 0 else "")) for i in range(400)] + [(1000, None), (1001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, 400)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    out = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert all((out[i] >= 0.5) == (i % 4 == 0) for i in range(400)) and 0 <= out[1000] < 0.5 and out[1000] == out[1001]
    assert toxicity.kept(docs, model).count() == 302
    none = toxicity.learn(docs, labels.limit(0))
    assert toxicity.score(docs, none).count() == 402 and toxicity.score(empty, model).count() == 0


def test_toxicity_catches_misspelled_terms_and_leaves_quotations(spark):
    rng = random.Random(9)
    terms = "blargish vornak snelpter".split()
    abuse = lambda t: words(rng, 12) + f" you {t} " + words(rng, 12)
    rows = [(i, abuse(terms[i % 3]) if i % 4 == 0 else words(rng, 25)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)], "doc_id long, toxic int"))
    assert model["coefficients"][0] > 0 >= model["coefficients"][1]
    tests = [abuse(t) for t in ("blargish", "blargsh", "vornaak", "vurnak", "sne1pter", "snelptr", "Vornak!" )] + [words(rng, 12) + f' they wrote "{t}" here ' + words(rng, 12) for t in terms] + [words(rng, 30), "x" * 200_000, "vornak" * 9000, None]
    got = {r["doc_id"]: r["score"] >= 0.5 for r in toxicity.score(spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string"), model).collect()}
    assert [got[i] for i in range(len(tests))] == [True] * 7 + [False] * 5 + [got[12], False]


def test_toxicity_with_labels_of_one_kind_keeps_all(spark, docs, texts):
    for y in (0, 1):
        model = toxicity.learn(docs, spark.createDataFrame([(i, y) for i in range(len(texts))], "doc_id long, toxic int"))
        assert toxicity.kept(docs, model).count() == len(texts)


def test_toxicity_fit_does_not_run_away():
    free = np.full(2, np.inf)
    rng = np.random.default_rng(0)
    for k in range(60):  # few texts, copied often, with sums far apart: plain Newton steps end at constants of millions
        n, m = rng.integers(5, 3000), rng.integers(100, 14000)
        x = np.concatenate([np.column_stack([rng.choice(rng.uniform(0, 800, rng.integers(1, 9)), n), np.ones(n)]), np.column_stack([rng.choice([0.0, 0.0, 0.0, 5.0, rng.uniform(0, 300)], m), np.ones(m)])])
        y = np.repeat([1.0, 0.0], [n, m])
        w = toxicity._logistic(x, y, -free, free)
        assert np.isfinite(w).all() and np.logaddexp(0, x @ w).sum() - y @ (x @ w) <= len(y) * math.log(2) + 1e-6 and abs(w).max() < 1000


def test_toxicity_against_brute_force(spark):
    rng = random.Random(12)
    model = {"terms": ["blargish$", "vornak"], "exact": [5.0, 4.0], "missed": [3.0, 1.0], "coefficients": [0.7, -0.5, 0.3, -2.0]}
    odd = ["blargish", "blargsh", "vornaks", "vornk", '"vornak"', "said", "blargish,"]
    tests = [" ".join(rng.choice(odd + WORDS * 2) for _ in range(rng.randint(0, 30))) for _ in range(200)]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
            row = new
        return row

    def kind(w):
        w = w.strip(toxicity.EDGES)
        if w == "blargish" or w.startswith("vornak"):
            return (0 if w == "blargish" else 1), False
        if distance("blargish", w)[-1] == 1:
            return 0, True
        return None  # "vornak" is too short a beginning to be misspelled

    def plain(t):
        ws, best, hits = t.lower().split(), {}, 0
        for i, w in enumerate(ws):
            if (m := kind(w)) is None:
                continue
            near, after = ws[max(0, i - 6) : i + 1], ws[i : i + 7]
            q = 1.0 if any(x.startswith('"') for x in near) and any('"' in x[1:] for x in after) else 0.5 if "said" in ws[max(0, i - 2) : i] else 0.0
            best[m] = min(q, best.get(m, 1.0))
            hits += (1 - q) * (model["missed"][m[0]] / model["exact"][m[0]] if m[1] else 1)
        used = sum((1 - q) * model["missed" if miss else "exact"][k] for (k, miss), q in best.items())
        said = sum(q * model["missed" if miss else "exact"][k] for (k, miss), q in best.items())
        return 1 / (1 + math.exp(-(0.7 * min(used, 20) - 0.5 * min(said, 20) + 0.3 * min(100 * hits / max(1, len(ws)), 10) - 2.0)))

    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string"), model).collect()}
    assert all(abs(got[i] - plain(t)) < 1e-12 for i, t in enumerate(tests)) and len({round(x, 6) for x in got.values()}) > 30


def test_preferences(spark):
    rows = [(2, 0, "user", "hi"), (2, 1, "assistant", "a"), (3, 0, "user", "hi"), (3, 1, "assistant", "b"), (3, 2, None, None), (4, 0, "user", "alone"), (6, 0, "user", "x"), (7, 0, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["pair_id"]: r for r in chat_formatting.preferences(turns).collect()}
    assert set(out) == {1, 3} and out[1]["prompt"] == "<|user|>\nhi<|end|>\n" and out[1]["n_prompt_turns"] == 1
    assert out[1]["rejected"] == "<|assistant|>\nb<|end|>\n<|user|>\n<|end|>\n"
    a, b = map(int, out[1]["rejected_mask"].split("-"))
    assert out[1]["rejected"][a:b] == "b<|end|>\n" and out[3]["chosen"] == "" and out[3]["chosen_mask"] == ""
    pairs = spark.createDataFrame([(9, 3, 2)], "pair_id long, chosen_id long, rejected_id long")
    assert [(r["chosen_id"], r["rejected_id"]) for r in chat_formatting.preferences(turns, pairs).collect()] == [(3, 2)]
    assert chat_formatting.preferences(turns.limit(0)).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert 0 < out.count() < 200 and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 20")
        assert stage(spark, docs, "/root/testdata/sf0.001").columns == docs.columns, name

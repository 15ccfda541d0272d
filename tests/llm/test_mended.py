"""Paired quotations, names of parts of pages, and rows without ids."""

import hashlib
import random

import pytest

from attesta.llm import fingerprints, html_extraction, simhash_dedup, toxicity

MARKS = ['"', "“", "”", "„", "«", "»", "`", "‘", "’"]


def plain_quotations(text):
    """By characters of the text: what is inside quotations that begin before a word and end after one, as (first, last) tokens."""
    edge, family = set(toxicity.EDGES), toxicity.FAMILIES
    tokens, at, out, stack = text.split(), 0, [], []
    for i, t in enumerate(tokens):
        solid = [k for k, c in enumerate(t) if c not in edge]
        for k, c in enumerate(t):
            if c not in family or (solid and solid[0] < k < solid[-1]):
                continue
            same = [j for j, (f, _) in enumerate(stack) if f == family[c]]
            closes = bool(same) if not solid else k > solid[-1]
            if closes and same:
                out.append((stack[same[-1]][1], i))
            if same:
                stack = stack[: same[-1]]
            if not closes:
                stack = [*stack, (family[c], i)]
        at += len(t) + 1
    return out


def test_quotations_against_a_plain_parser():
    rng = random.Random(2)
    for _ in range(1500):
        t = []
        for _ in range(rng.randint(0, 25)):
            w = rng.choice(["idiot", "you", "don't", "x", "it's", ""])
            t.append("".join(rng.choice([*MARKS, "(", "'"]) for _ in range(rng.choice([0, 0, 1, 1, 2]))) + w + "".join(rng.choice([*MARKS, ",", ")", "."]) for _ in range(rng.choice([0, 0, 1, 1, 2]))))
        text = " ".join(t)
        assert toxicity.quotations(text.split()) == plain_quotations(text), text


@pytest.mark.parametrize("text, word, quoted", [
    ('"hello" she said "bye" you idiot and then "later" ok', "idiot", 0.0),
    ('she called him "you idiot" today', '"you', 1.0),
    ("er rief „du idiot“ und ging", "idiot“", 1.0),
    ("« tu es idiot » dit le voisin", "idiot", 1.0),
    ('an "unclosed mark and an idiot here', "idiot", 0.0),
    ("the dogs' tails, you idiot, aren't 'yours'", "idiot,", 0.0),
    ('"he told “that idiot” to go"', "idiot”", 1.0),
    ('"one two three four five six seven idiot nine ten eleven twelve thirteen fourteen fifteen"', "idiot", 0.0),
])
def test_what_is_quoted(text, word, quoted):
    lex, tokens = toxicity.Lexicon(["idiot$"]), text.split()
    assert lex.quoted(tokens, tokens.index(word), toxicity.quotations(tokens)) == quoted


@pytest.mark.parametrize("name", ["reader-comments", "ad-slot", "user-comments", "post-comments", "ad-container", "site-nav", "sidebar-left", "share-buttons", "related-posts", "promo-box", "main-menu", "newsletter-signup", "adSlot", "comment_list", "ad"])
def test_parts_that_are_not_the_article(name):
    page = f"<body><div class='story'><p>First block.</p><div class='{name}'><p>Not this.</p></div><p>Last block.</p></div></body>"
    assert html_extraction.text_of(page, set(), None) == "First block.\n\nLast block."


@pytest.mark.parametrize("name", ["post-body", "page-with-sidebar", "no-ads", "category-social", "adventure", "commentary", "navy", "shared", "story-header", "admin", "related-work"])
def test_parts_that_are(name):
    page = f"<body><div class='{name}'><p>This one.</p></div></body>"
    assert html_extraction.text_of(page, set(), None) == "This one."


def test_fingerprints_keep_rows_without_ids(spark):
    rows = [(5, "five five five five"), (None, "none none none none"), (None, None), (9, "nine nine nine nine"), (2, "two two two two")]
    out = fingerprints.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_chars"]) for r in out) == [(0, 0), (0, 19), (2, 15), (5, 19), (9, 19)]
    sha = {(r["doc_id"], r["n_chars"]): r["edited_sha256"] for r in out}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sha[2, 15] == digest("two two two five"[:12] + "fiv") and sha[5, 19] == digest("five five five fivenine"[:15] + "nine") and sha[None, 19] == digest("none none none none"[:15] + "two ") and sha[None, 0] == digest("")
    assert sha[9, 19] == digest("nine nine nine nine"[:15])  # of two rows without an id, the empty text is the smaller head


def test_an_id_for_rows_without_one(spark):
    of = lambda *ids: fingerprints._unused_id(spark.createDataFrame([(i,) for i in ids], "doc_id long"))
    assert of(1, 2) is None and of(1, None) == 2 and of(None) == 0 and of(2**63 - 1, 2**63 - 2, None) == 2**63 - 3
    out = fingerprints.edited_fingerprints(spark.createDataFrame([(2**63 - 1, "a"), (None, "b")], "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in out} == {2**63 - 1, None}


def test_near_dedup_keeps_rows_without_ids(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(3, text), (1, text), (None, text), (None, text), (4, "another text of quite other words than those"), (4, "another text of quite other words than those"), (None, None)]
    out = simhash_dedup.first_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect()) == sorted([(1, text), (0, text), (0, text), (0, ""), (4, rows[4][1])])

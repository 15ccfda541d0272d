from pyspark.sql import functions as F

from attesta.functions import facts
from attesta.operators import validate as V


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


def test_policy(spark):
    policy = [("raw-", 3), ("r", 9)]
    df = spark.createDataFrame([("raw-1", 3), ("raw-1", None), ("rx", 3), ("z", 1)], "n string, d int")
    assert [r[0] for r in df.coalesce(1).select(V.policy_error(F.col("n"), F.col("d"), policy)).collect()] == [None, "raw-1: the value is missing", "rx: must be 9, got 3", "unknown name: z"]


def test_scan_needs_all_patterns_in_a_file(spark):
    df = spark.createDataFrame([("a", "key=1\npost(u)\n  post(u) # ok"), ("b", "post(u)"), ("c", None)], "p string, t string")
    assert [tuple(r) for r in V.scan_files(df, "p", "t", ["key=", "post"], r"post\(", "# ok").collect()] == [("a", 2, "post(u)")]
    assert one(spark, "x/.git/a.py", lambda c: V.walked(c, [".git"], ["py"])) is False and one(spark, "x/a.py", lambda c: V.walked(c, [".git"], ["py"])) is True


def test_blocks_end_with_their_indentation(spark):
    text = "steps:\n  - name: a\n    uses: up@1\n    with:\n      days: 3\n  - name: b\n    run: x\nother: up@2"
    lines = V.lines_of(spark.createDataFrame([("f", text)], "p string, t string"), "p", "t")
    assert [tuple(r) for r in V.blocks(lines, "p", "line_no", "line", "up@").collect()] == [("f", 2, "  - name: a\n    uses: up@1\n    with:\n      days: 3")]


def test_definitions_and_manifests(spark):
    a = spark.createDataFrame([("f", "1"), ("g", "2"), ("h", None)], "n string, b string")
    b = spark.createDataFrame([("f", "1"), ("g", "3"), ("i", "4")], "n string, b string")
    assert sorted(map(tuple, V.changed_definitions(a, b, "n", "b").collect())) == [("g", "changed"), ("h", "removed")]
    assert sorted(map(tuple, V.manifest_differences(a, b, "n", ["b"]).collect())) == [("g", "different"), ("h", "missing"), ("i", "unexpected")]
    assert one(spark, 1, lambda c: V.errors([("a", c == 2), ("b", c == 1), ("c", F.lit(None).cast("boolean"))]), "int") == ["a", "c"]
    assert [one(spark, s, V.http_failure, "int") for s in (None, 403, 429, 503, 404, 200)] == ["network", "auth", "rate_limit", "server", "request", "ok"]


def test_facts(spark):
    page = '<title>惠普 暗影精灵10 16英寸 | 店</title><dd class="x" data-th="键盘">全尺寸 <b>背光</b> 数字键盘</dd>'
    df = spark.createDataFrame([("u", page), ("v", "<title>x</title>"), ("w", None)], "url string, html string")
    got = facts.facts(df, "url", "html", facts.keyboard_cells(F.col("html")), "cells", r"[|\-]").collect()
    assert [(r["series"], r["size_inch"], r["page_url"], r["numeric_keypad"], r["keyboard_backlight"]) for r in got] == [("暗影精灵10", "16英寸", "u", True, True)]
    assert one(spark, "<p>a 键盘 b</p><p>a 键盘 b</p><p>keycap</p>", facts.keyboard_windows) == "a 键盘 b；keycap"
    links = 'href="https://h/a-laptops.html" href="https://h/x1.html" href="https://h/x1.html" href="https://h/1-mice.html" href="https://h/y.html"'
    assert one(spark, links, lambda c: facts.product_links(c, 'href="([^"]*\\.html)"')) == ["https://h/x1.html"]


def test_json_in_text_and_budgets(spark):
    assert one(spark, 'so {"a": "}\\"", "b": {"c": 1}} and {}', facts.balanced_object) == '{"a": "}\\"", "b": {"c": 1}}'
    assert one(spark, "none {", facts.balanced_object) is None and one(spark, None, facts.balanced_object) is None
    assert one(spark, '```json\n{"a": 1}\n```', facts.unfenced) == '{"a": 1}'
    assert one(spark, "a b/ü", facts.token) == "a_b_"
    df = spark.createDataFrame([(100, 0, 5000), (9000, 0, 5000), (0, 0, 5000), (100, 21000, 5000)], "r int, e int, w int")
    assert [r[0] for r in df.coalesce(1).select(facts.clamped(F.col("r"), F.col("e"), F.col("w"))).collect()] == [100, 5000, 5000, None]


def test_unicode_folding(spark):
    from attesta.functions import text as T

    assert one(spark, "ＡＢ①", T.nfkc) == "AB1" and one(spark, None, T.nfkc) is None
    assert one(spark, " Straße  Ａ", T.casefolded) == "strasse a" and one(spark, None, T.casefolded) is None

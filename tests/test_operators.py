import pytest
from pyspark.sql import functions as F

from attesta.functions import text as T
from attesta.operators import browse, protect, reports, resolve
from attesta.sources import payload
from attesta.streaming import incremental


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


def test_scalars(spark):
    assert one(spark, " a \n\tb ", T.clean) == "a b"
    assert one(spark, "1,299.50 each", T.price) == 1299.5
    assert one(spark, "16GB + 1 TB", T.capacity_gb) == 1024
    assert one(spark, "no numbers", T.first_number) is None
    assert one(spark, "A，b+ a |none", T.source_tokens) == ["A", "b", "a"]
    assert one(spark, "Ab-12 é", T.identity_text) == "ab12é"
    assert one(spark, "no lamp", lambda c: T.tri_state(c, "no lamp", "lamp")) is False
    assert one(spark, "no lamp", lambda c: T.tri_state(c, "no lamp", "lamp", negation_first=False)) is True
    assert one(spark, "https://u:p@h/x", T.redacted) == "https://***@h/x"
    assert one(spark, "done 12, done 40", lambda c: T.max_amount(c, [r"done (\d+)"])) == 40
    assert one(spark, None, lambda c: T.identity_key(c, c)) is None


def test_merge_is_independent_of_row_order(spark):
    rows = [("k", "b", 3, None), ("k", "a", 5, True), ("k", "b", 1, False), ("m", "a", 7, None)]
    got = []
    for r in (rows, rows[::-1]):
        df = spark.createDataFrame(r, "key string, source string, ord int, flag boolean")
        got.append(sorted(map(tuple, resolve.merge_groups(df, "key", "source", "ord", "ord", ["flag"]).select("key", "sources", "best_rank", "records", "flag").collect())))
    assert got[0] == got[1] == [("k", ["a", "b"], 1, 3, False), ("m", ["a"], 7, 1, None)]


def test_gate_names_every_rule_in_order(spark):
    df = spark.createDataFrame([(True, None), (True, True)], "a boolean, b boolean")
    out = resolve.gate(df, [("a", F.col("a")), ("b", F.col("b"))]).collect()
    assert [(r["reasons"], r["eligible"]) for r in out] == [(["b"], False), ([], True)]


def test_preserve_is_idempotent_and_guards(spark):
    df = spark.createDataFrame([("a", True), ("b", True)], "key string, ok boolean")
    assert protect.preserve(df, df, "key", F.col("ok")).count() == 2
    protect.require_superset(df, df, "key")
    with pytest.raises(protect.PublishGuardError):
        protect.require_superset(df, df.where("key = 'a'"), "key")
    with pytest.raises(protect.PublishGuardError):
        protect.require_rows(df, 3, "input")


def test_audit_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", None)], "key string, n int")
    out = {r["error"]: r["rows"] for r in protect.audit(df, [("n", F.col("n").isNotNull()), ("key", F.col("key").isNotNull())], "key").collect()}
    assert out == {"n": 1, "duplicate keys": 1}


def test_facts_and_streaks(spark):
    docs = spark.createDataFrame([(1, "the red lamp"), (2, "none")], "id int, title string")
    facts = spark.createDataFrame([(1, "red"), (2, "red lamp")], "fact_id int, name string")
    assert [tuple(r) for r in resolve.match_facts(docs, facts, "id", F.col("title")).collect()] == [(1, 2)]
    s = spark.createDataFrame([("p", i, x) for i, x in enumerate([1, 0, 0, 1, 0])], "p string, i int, n int")
    assert resolve.streaks(s, "p", "i", F.col("n") == 0).first()["longest"] == 2


def test_overlap(spark):
    df = spark.createDataFrame([("k", "a", 1), ("k", "b", 2), ("k", "c", 3), ("m", "a", 4)], "key string, source string, ord int")
    assert {tuple(r) for r in reports.overlap_pairs(df, "key", "source", "ord").collect()} == {("k", "a", "b", 1, 2), ("k", "a", "c", 1, 3), ("k", "b", "c", 2, 3)}


def test_browse(spark):
    df = spark.createDataFrame([(1, None, True), (2, 5.0, None), (3, 9.0, False)], "id int, price double, used boolean")
    assert [r["id"] for r in browse.browse(df, {"most": {"price": 6}, "not_true": ["used"]}).collect()] == [2]
    assert [r["id"] for r in browse.browse(df, {}, [("price", False, 1e9)], "id").collect()] == [2, 3, 1]
    assert browse.active_filters({"most": {"price": 6}, "not_true": ["used"]}) == 2
    assert one(spark, "Alpha Beta Gamma Delta (x)", browse.short_identity) == "Alpha Beta Gamma"


def test_payloads(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"count": 2, "items": [{"a": 1, "b": null}, {"a": 2}]}')
    assert sorted((r["pos"], r["n_keys"]) for r in payload.read_payload(spark, str(tmp_path / "a.json")).collect()) == [(0, 2), (1, 1)]
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nbroken\n[1]\n{"a": 2}\n')
    assert payload.read_lines(spark, str(tmp_path / "x.jsonl")).count() == 2
    assert [bool(one(spark, j, payload.strict_json)) for j in ('{"a": 1} x', '[1]]', '{"a": 1}}', '1, 2', '1, "k": 2', "", " [1] ", "null")] == [False] * 6 + [True] * 2
    assert [one(spark, j, payload.strict_json) for j in ('{"a": 1}', '{"a": 1e309}', '{"a": 1, "a": 2}')] == [True, False, False]


def test_stream_resumes(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.createDataFrame([(1,), (2,), (2,)], "k int").write.parquet(src)
    incremental.resumable(spark, src, out, state, "k")
    spark.createDataFrame([(2,), (3,)], "k int").write.mode("append").parquet(src)
    incremental.resumable(spark, src, out, state, "k")
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]

"""Scans that are resumed, stop rules, keyed tables, exact places."""

import json
import random

import pytest
from pyspark.sql import functions as F

from attesta.operators import browse, pool
from attesta.streaming import lists
from attesta.sources.files import Conflict
from attesta.streaming.keyed import KeyedTable


def write_pages(root, source, pages):
    (root / source).mkdir(parents=True, exist_ok=True)
    for k, keys in enumerate(pages, 1):
        (root / source / f"{k}.json").write_text(json.dumps([{"key": x} for x in keys]))
    return f"file://{root}/{source}/{{page}}.json"


def plain_scan(source, pages, repeats=3):
    """What a scan of all pages one after another gives."""
    seen, stale, out = set(), 0, set()
    for k, keys in enumerate([*pages, []], 1):
        new = [(i, x) for i, x in enumerate(keys) if x and x not in seen and x not in keys[:i]]
        out |= {(source, k, "item", i, x) for i, x in new}
        seen |= {x for _, x in new}
        stale = 0 if new else stale + 1
        out.add((source, k, "page", len(new), None))
        if not keys or stale >= repeats:
            return out | {(source, k, "end", None, "repeats" if keys else "empty")}
    return out


def test_a_scan_that_is_resumed_equals_one_run(spark, tmp_path):
    rng = random.Random(3)
    lists_of = {"goes on": [[f"k{rng.randint(0, 60)}" for _ in range(4)] for _ in range(14)], "three old": [["a", "b"], ["c", "a"], ["b"], ["a"], ["c"], ["new, but too late"]], "gap": [["x"], [], ["y"]], "two old": [["a"], ["a"], ["a"], ["b"], ["b"], ["b"], ["b"], ["c"]]}
    want = set().union(*(plain_scan(s, p) for s, p in lists_of.items()))
    addresses = {s: write_pages(tmp_path / "pages", s, p) for s, p in lists_of.items()}
    for name, steps in (("one", [30]), ("three", [2, 3, 25])):
        sink, state, done = f"file://{tmp_path}/{name}/events", f"file://{tmp_path}/{name}/state", {}
        for step in steps:
            done = lists.goal(spark, addresses, step, done, sink if done else None)
            lists.scan(spark, addresses, done, sink, state)
        assert {tuple(r) for r in spark.read.schema(lists.EVENTS).parquet(sink).collect()} == want and spark.read.parquet(sink).count() == len(want)
    assert done == {"goes on": 30, "three old": 5 + 0 * 30, "gap": 2, "two old": 30}


def test_pages_that_fail_are_given_out_again(spark, tmp_path):
    addresses = {"up": write_pages(tmp_path / "pages", "up", [["a"], ["b"], ["c"]]), "down": "http://127.0.0.1:9/{page}"}
    sink, state = f"file://{tmp_path}/events", f"file://{tmp_path}/state"
    lists.scan(spark, addresses, {"up": 1, "down": 0}, sink, state, wait=1)
    lists.scan(spark, addresses, {"up": 2, "down": 1}, sink, state, wait=1)
    lists.scan(spark, addresses, {"up": 3, "down": 1}, sink, state, wait=1)
    rows = {tuple(r) for r in spark.read.schema(lists.EVENTS).parquet(sink).collect()}
    assert {r[:3] for r in rows if r[0] == "down"} == {("down", 1, "failed"), ("down", 1, "retry")} and {r[4] for r in rows if r[2] == "item"} == {"a", "b", "c"}


def test_keyed_table(spark, tmp_path):
    rng, want = random.Random(5), {}
    table = KeyedTable(spark, f"file://{tmp_path}/t", "k", buckets=4, compact_after=3)
    assert table.read() is None and table.manifest(7) is None and table.compact() is None
    for batch in range(6):
        rows = [(rng.choice([None, *range(30)]), o, f"{batch}-{o}") for o in range(12)]
        df = spark.createDataFrame(rows, "k int, o int, v string")
        df = df.withColumn("more", F.lit(batch)) if batch > 3 else df
        want |= {k: (o, v, batch if batch > 3 else None) for k, o, v in rows}
        assert table.upsert(df, "o", batch) is not None and table.upsert(df, "o", batch) is None
        got = table.read()
        assert {r["k"]: (r["o"], r["v"], r["more"] if batch > 3 else None) for r in got.collect()} == want and got.count() == len(want)
    old = table.read(1).count()
    assert old <= 12 and max(len(d) for d in table.manifest()["deltas"].values() or [[]]) < 3
    assert table.vacuum(1) and table.read().count() == len(want) and table.read(1) is None
    with pytest.raises(Conflict):
        table._manifests.put(table.versions()[-1], table.manifest())


def test_a_small_batch_writes_little(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", "k", buckets=8)
    table.upsert(spark.range(100_000).select(F.col("id").alias("k"), F.lit(1).alias("o"), F.sha2(F.col("id").cast("string"), 256).alias("v")), "o", 0)
    size = lambda: sum(p.stat().st_size for p in tmp_path.rglob("*.parquet"))
    before = size()
    table.upsert(spark.range(1000).select((F.col("id") * 97).alias("k"), F.lit(2).alias("o"), F.sha2(F.col("id").cast("string"), 256).alias("v")), "o", 1)
    assert size() - before < 0.03 * before and table.read().count() == 100_000 and table.read().where("o = 2").count() == 1000


def test_places_in_hot_groups(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.choice([None, 0, 0, 0, 3, 5, 9999]), o) for o in rng.sample(range(10_000), 3000)]
    df = spark.createDataFrame(rows, "g string, r int, o int")
    want, places = {}, {}
    for g, r, o in sorted(rows, key=lambda x: (str(x[0]), x[1] or 9999, x[2])):
        places[g] = places.get(g, 0) + 1
        want[o] = (places[g], min(x[2] for x in rows if x[0] == g))
    out = browse.grouped(df, "g", "r", "o")
    assert out.columns == ["g", "r", "o", "place", "group_ord"] and {r["o"]: (r["place"], r["group_ord"]) for r in out.collect()} == want
    assert browse.grouped(df.limit(0), "g", "r", "o").count() == 0


def test_requests_are_dealt_in_turn(spark):
    nodes = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    out = pool.dealt(spark.range(100).select((F.col("id") * 7 % 101).alias("q")), "q", nodes, start=1).collect()
    order = sorted(r["q"] for r in out)
    assert {r["q"]: r["node"] for r in out} == {q: "abc"[(k + 1) % 3] for k, q in enumerate(order)}
    assert {r["node"] for r in pool.dealt(spark.range(3).select("id"), "id", nodes.limit(0)).collect()} == {None}

"""Queries against their oracles on keys and sizes that the small tables don't have."""

import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from attesta.functions import listings as L
from attesta.operators import browse, postings
from attesta.operators.postings import Postings
from attesta.plans import catalogue
from attesta.streaming import lists
from tests.test_catalogue import TABLES, D, plain
from tests.test_listings import run


def same(spark, name, folder, **changed):
    """Whether the query gives what its oracle does on tables of which some are ``changed`` by SQL."""
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"COPY ({changed.get(t, 'SELECT * FROM old').replace('old', f"'{D}/{t}.parquet'")}) TO '{folder}/{t}.parquet'")
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = catalogue.QUERIES[name](spark, str(folder))
    want = c.execute(f"SELECT {', '.join(df.columns)} FROM ({catalogue.ORACLES[name]})").fetchall()
    return sorted("|".join(map(plain, r)) for r in df.collect()) == sorted("|".join(map(plain, r)) for r in want)


FAR_PARTS = "SELECT * REPLACE (p_partkey + 89900 + 1000000 * (p_partkey % 2) AS p_partkey) FROM old"


@pytest.mark.parametrize("name", ["cpu_voltage", "admission_gate", "cpu_identity"])
def test_numbers_that_no_model_has(spark, tmp_path, name):
    assert same(spark, name, tmp_path, part=FAR_PARTS)


ODD_TEXTS = ["", "!", " -- ", "ΟΔΟΣ", "ΟΔΟΣ Α", "İstanbul", "I\u0307", "x \u0870", "\U00031350", "\U0001E4F0!", "\u2C2F", "\U000105BC", "\U0002EBF0"]


@pytest.mark.parametrize("name", ["identity_key", "identity_groups", "publish_pipeline", "rejected_ledger", "merge_gaps"])
def test_keys_of_odd_texts(spark, tmp_path, name):
    texts = ", ".join([f"'{x}'" for x in ODD_TEXTS] + ["NULL"])
    assert same(spark, name, tmp_path, documents=f"SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN [{texts}][1 + (doc_id // 3 % {len(ODD_TEXTS) + 1})::INT] ELSE text END AS text) FROM old")


def test_suffixes_behind_long_numbers(spark):
    given = ["Intel Core i7-100008HX", "i7 1234567 U", "i7-13650HX", "锐龙 7 77777HS", "some HX", "i9-14900K"]
    assert run(spark, given, L.cpu_voltage) == ["high_performance", "low_power", "high_performance", "standard_performance", "high_performance", "desktop_performance"]
    assert run(spark, given, lambda c: L.cpu_voltage(c, known=True)) == ["unknown", "unknown", "high_performance", "standard_performance", "high_performance", "desktop_performance"]


def test_names_with_long_numbers(spark):
    given = ["Intel Core i7-100008HX", "酷睿i7 100008 HX", "i7-13650HX", "N100"]
    assert run(spark, given, lambda c: L.cpu_identity(c, F.lit(""), F.lit(""))) == ["intelcorei7100008hx", "酷睿i7100008hx", "intel-i7-13650hx", "n100"]
    assert run(spark, given, lambda c: L.cpu_identity(c, F.lit(""), F.lit(""), any_number=True)) == ["intel-i7-100008hx", "intel-i7-100008hx", "intel-i7-13650hx", "n100"]


def test_list_pages_lie_in_blocks(spark, tmp_path):
    items = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "a").otherwise("b/ b").alias("s"), F.col("id").alias("o"), F.concat(F.lit('k\n\t"'), (F.col("id") % 2999).cast("string")).alias("k"))
    addresses = lists.pages_of(items, "s", "o", "k", 1, f"file://{tmp_path}/pages")
    assert len([p for p in (tmp_path / "pages").rglob("part-*")]) == 5 and len(lists._PageStream({"addresses": json.dumps(addresses), "upto": "{}"}).partitions({}, {"a": 2001, "b/ b": 1001})) == 5
    done = {}
    for step in (3, 1500, 1000):
        done = lists.goal(spark, addresses, step, done, f"file://{tmp_path}/events" if done else None)
        lists.scan(spark, addresses, done, f"file://{tmp_path}/events", f"file://{tmp_path}/state")
    got = spark.read.schema(lists.EVENTS).parquet(f"file://{tmp_path}/events")
    want = {("a" if k % 3 else "b/ b", (k // 3) * 2 + k % 3 if k % 3 else k // 3 + 1, f'k\n\t"{k % 2999}') for k in range(3000)}
    assert {(r["source"], r["page_no"], r["key"]) for r in got.where("kind = 'item'").collect()} == want
    assert {(r["source"], r["page_no"], r["key"]) for r in got.where("kind = 'end'").collect()} == {("a", 2001, "empty"), ("b/ b", 1001, "empty")}


def test_many_needles_of_digits(spark, tmp_path, monkeypatch):
    rows = [(k, f"Customer#{k:09d}") for k in range(0, 20_000, 10)]
    needles = [f"{k:05d}" for k in range(500)] + ["00", "", "\U0001f600", "Customer#000019990 and more", "customer#00001", "mer#00000019"]
    index = Postings(spark, f"file://{tmp_path}/i")
    index.add(spark.createDataFrame(rows, "key int, text string"), F.col("text"), "one")
    joined, old = [], postings.looked_up
    monkeypatch.setattr(postings, "looked_up", lambda *x: (out := old(*x), joined.append(out.count()))[0])
    got = sorted((r.needle, r.row.key) for r in index.search(spark.createDataFrame([(n,) for n in needles], "needle string")).collect())
    assert got == sorted((n, k) for n in needles for k, x in rows if n.lower() in x.lower())
    assert max(joined) < 1.2 * len(got)  # by trigrams it was far more than what is found


def test_pieces_of_other_lengths(spark, tmp_path):
    r = random.Random(5)
    rows = [(k, "".join(r.choices("ab\U0001f600é", k=r.randint(0, 60)))) for k in range(300)]
    rows += [(1000 + k, x) for k, x in rows[:20]]
    needles = list({x[i : i + n] for _, x in rows[:200] for i in (0, 7) for n in (1, 2, 3, 5, 7, 9, 13, 25, 33, 40)})
    index = Postings(spark, f"file://{tmp_path}/i", fold=False)
    for k in range(2):
        index.add(spark.createDataFrame(rows[k::2], "key int, text string"), F.col("text"), f"s{k}")
    asked = spark.createDataFrame([(n,) for n in needles], "needle string")
    assert index._reads(index.chosen(asked.withColumn("sought", F.col("needle")))) > 9 * sum(len(x) for _, x in rows)  # so that pieces are joined
    assert sorted((r.needle, r.row.key) for r in index.search(asked).collect()) == sorted((n, k) for n in needles for k, x in rows if n in x)


def test_links_are_read_once_a_row(spark):
    plan = catalogue.QUERIES["node_schemes"](spark, D)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("wireguard://") == 2  # where links are made and where they are read; before, for each column anew


def test_places_shuffle_rows_once(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("r"), F.col("id").alias("o"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if all tables were large
    try:
        plan = browse.grouped(rows, "g", "r", "o")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2

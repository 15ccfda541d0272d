"""The trigram index against plain substring search."""

import random

import pytest
from pyspark.sql import functions as F

from attesta.operators import browse as B
from attesta.operators.postings import Postings

ODD = [(1, ""), (2, None), (3, "a"), (4, "AB"), (5, "abc"), (6, "xabcab"), (None, "abcabc"), (7, "中文\U0001f600abc"), (8, "a\nb\0c"), (8, "a\nb\0c"), (9, "%_\\E.*"), (10, "ab" * 5000 + "needle")]
NEEDLES = ["", "a", "AB", "ab", "bc", "abc", "cab", "ABCAB", "\U0001f600", "文\U0001f600a", "\n", "b\0", "\0", "_\\E", ".*", "needle", "absent", None, "ab"]
ROWS = "key int, text string"


def plain(rows, needles, fold=True):
    low = (lambda x: x.lower()) if fold else (lambda x: x)
    return sorted(((n, k) for n in {n for n in needles if n is not None} for k, x in rows if low(n) in low(x or "")), key=str)


def found(spark, index, needles):
    return sorted(((r.needle, r.row.key) for r in index.search(spark.createDataFrame([(n,) for n in needles], "needle string")).collect()), key=str)


@pytest.mark.parametrize("fold", [True, False])
def test_odd_texts(spark, tmp_path, fold):
    index = Postings(spark, f"file://{tmp_path}/i", fold)
    index.add(spark.createDataFrame(ODD, ROWS), F.col("text"), "one")
    assert found(spark, index, NEEDLES) == plain(ODD, NEEDLES, fold)
    assert found(spark, index, []) == []


def test_random_texts_in_segments(spark, tmp_path):
    r = random.Random(7)
    rows = [(k, "".join(r.choices("abcd é", k=r.randint(0, 40)))) for k in range(400)]
    needles = ["".join(r.choices("abcd é", k=r.randint(1, 7))) for _ in range(60)]
    index = Postings(spark, f"file://{tmp_path}/i")
    for k in range(3):
        index.add(spark.createDataFrame(rows[k::3], ROWS), F.col("text"), f"s{k}")
    assert found(spark, index, needles) == plain(rows, needles)
    # A segment that is there already is not written again, nor its rows counted twice.
    assert index.add(spark.createDataFrame(rows[:5], ROWS), F.col("text"), "s0") is None
    assert found(spark, index, needles) == plain(rows, needles)


def test_few_rows_are_compared_whole(spark, tmp_path):
    rows = [(k, f"item {k:06d} of the list") for k in range(3000)]
    index = Postings(spark, f"file://{tmp_path}/i")
    index.add(spark.createDataFrame(rows, ROWS), F.col("text"), "one")
    asked = spark.createDataFrame([("m 002917 o",)], "needle string").withColumn("sought", F.col("needle"))
    assert index.candidates(asked).count() == 1
    files = index._read("postings").where(F.col("gram").isin("917"))
    assert "In(gram" in files._jdf.queryExecution().toString() or "EqualTo(gram" in files._jdf.queryExecution().toString()


def test_empty_table_and_names_that_clash(spark, tmp_path):
    index = Postings(spark, f"file://{tmp_path}/i")
    with pytest.raises(ValueError):
        index.containing("x")
    clash = "id long, gram string, seg string, needle string, text string"
    index.add(spark.createDataFrame([], clash), F.col("text"), "none")
    assert index.containing("abc").collect() == []
    index.add(spark.createDataFrame([(5, "g", "s", "n", "xabcx")], clash), F.col("text"), "some")
    assert [tuple(x) for x in index.containing(" abc ").collect()] == [(5, "g", "s", "n", "xabcx")]


def test_browse_by_index(spark, tmp_path):
    rows = spark.createDataFrame([(1, "Alpha", 3), (2, "beta ALPHA", 9), (3, None, 9)], "key int, title string, size int")
    index = Postings(spark, f"file://{tmp_path}/i")
    index.add(rows, F.col("title"), "one")
    spec = {"search": (["title"], " alpha "), "least": {"size": 5}}
    assert [x.key for x in B.browse(rows, spec, index=index).collect()] == [x.key for x in B.browse(rows, spec).collect()] == [2]


def test_rows_found_by_grams_are_dealt_before_they_are_grouped(spark, tmp_path, monkeypatch):
    from attesta.operators import postings

    monkeypatch.setattr(postings, "GROUPED", 50)
    rows = [(i, f"{'abc' * (i % 7)}needle{i % 5}") for i in range(300)]
    index = Postings(spark, f"file://{tmp_path}/i")
    index.add(spark.createDataFrame(rows, ROWS), F.col("text"), "one")
    assert found(spark, index, ["needle1", "abcneedle2"]) == plain(rows, ["needle1", "abcneedle2"])
    chosen = postings.staged(index.chosen(spark.createDataFrame([("needle1", "needle1")], "needle string, sought string")), "grams")
    assert index._by_grams(chosen).rdd.getNumPartitions() == index._reads(chosen) // 50 > spark.sparkContext.defaultParallelism

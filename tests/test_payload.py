"""Payloads read in splits: the same records as a whole read, wherever splits fall."""

import json
import random

import pytest

from attesta.sources import payload

TEXTS = ['a"b', "}", "{[", "\\", 'x\\"}', "é]", "", "],", "\n", "联想{", '":[', "\u0001"]


def value(r, depth=0):
    kind = r.randrange(6 if depth < 3 else 4)
    if kind < 2:
        return r.choice(TEXTS)
    if kind < 4:
        return r.choice([1, -2, None, True, 0.5])
    if kind == 4:
        return [value(r, depth + 1) for _ in range(r.randrange(4))]
    return {r.choice(TEXTS) + str(k): value(r, depth + 1) for k in range(r.randrange(4))}


def documents(r):
    records = [value(r, 1) if r.random() < 0.2 else {"id": k, "v": value(r)} for k in range(r.choice([0, 1, 3, 120]))]
    shape = r.randrange(4)
    if shape == 0:
        return records, records
    around = {f"m{k}": value(r) for k in range(r.randrange(4))}
    name = r.choice(["items", "data"])
    if shape == 3:
        around["records"] = [{"not": "these"}] * 3
    doc = {**around, name: records, "tail": {"a": {"b": [value(r)]}}}
    return doc, records if name == "items" or shape != 3 else around["records"]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_records_are_those_of_the_whole_document(spark, tmp_path, small_splits):
    r, want = random.Random(5), {}
    for k in range(24):
        doc, records = documents(r)
        name = f"{k}.json"
        (tmp_path / name).write_text(json.dumps(doc, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1])) + r.choice(["", "\n"]), encoding="utf-8")
        want[name] = records
    got = {n: {} for n in want}
    rows = payload.read_payload(spark, f"file://{tmp_path}")
    for x in rows.collect():
        got[x["path"].rsplit("/", 1)[1]][x["pos"]] = json.loads(x["raw"])
        assert (x["n_keys"] is None) == (not isinstance(json.loads(x["raw"]), dict))
    assert {n: [v[k] for k in sorted(v)] for n, v in got.items()} == want and all(sorted(v) == list(range(len(v))) for v in got.values())
    splits = spark.read.option("lineSep", "}").text(f"file://{tmp_path}").select("_metadata.file_path", "_metadata.file_block_start").distinct().count()
    assert splits > len(want) + 10


def test_broken_documents_hold_no_records(spark, tmp_path, small_splits):
    body = ",".join(f'{{"id": {k}, "t": "x}}{k}"}}' for k in range(200))
    good = f'{{"items": [{body}]}}'
    bad = [good[:-1], good + "}", good[:-2] + "}", good.replace('"id": 150', '"id" 150'), good.replace('{"id": 99', ',{"id": 99'), good.replace('"t": "x}120"', '"t": "x}120'), f"[{body}", f"[{body}]]", f"[{body},]", '{"items": [{"a": 1}]', good.replace('"id": 7,', '"id": 7, "id": 7,'), good + good, body.replace(",{", "\n{"), "", "3"]
    for k, text in enumerate([good, *bad]):
        (tmp_path / f"{k}.json").write_text(text)
    counts = {x["path"].rsplit("/", 1)[1]: x["count"] for x in payload.read_payload(spark, f"file://{tmp_path}").groupBy("path").count().collect()}
    assert counts == {"0.json": 200}
    rows, shape = payload.read_rows(spark, f"file://{tmp_path}/0.json")
    assert rows.count() == 200 and shape == "items"
    (tmp_path / "odd.json").write_text(good.replace('{"id": 3,', '7,{"id": 3,'))
    with pytest.raises(payload.PayloadError, match="1 rows"):
        payload.read_rows(spark, f"file://{tmp_path}/odd.json")


def test_compressed_documents_are_read_whole(spark, tmp_path):
    import gzip

    (tmp_path / "a.json.gz").write_bytes(gzip.compress(b'{"data": [{"a": 1}, {"b": 2}, {}]}'))
    assert sorted((x["pos"], x["raw"]) for x in payload.read_payload(spark, f"file://{tmp_path}/a.json.gz").collect()) == [(0, '{"a":1}'), (1, '{"b":2}'), (2, "{}")]

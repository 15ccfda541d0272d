"""Publications are whole whatever fails, and when."""

import json

import pytest
from pyspark.sql import functions as F

from attesta.operators import records
from attesta.operators.protect import PublishGuardError
from attesta.operators.publication import Publication
from attesta.sources.files import Conflict, Versions


@pytest.fixture(scope="module")
def merged(spark, tmp_path_factory):
    rows = [{"title": f"联想 Y{i}", "source": "zol+jd" if i else "zol", "numeric_keypad": True, "keyboard_backlight": i != 3 or None, "source_rank": i, "brand": "Lenovo", "cpu": "i7-13700H"} for i in range(5)]
    lines = [(json.dumps({"ord": f"{i:03d}"} | r),) for i, r in enumerate(rows)]
    where = f"file://{tmp_path_factory.mktemp('merged')}/m"
    listings = spark.createDataFrame(lines, "j string").select(F.from_json("j", records.LISTING + ", ord string").alias("r")).select("r.*")
    records.merge_records(listings, "ord").write.parquet(where)
    return spark.read.parquet(where)


def titles(p, version=None):
    return sorted(r["title"] for r in p.items(version).collect())


def test_a_failure_between_any_two_writes_leaves_the_old_version(spark, merged, tmp_path, monkeypatch):
    p = Publication(spark, f"file://{tmp_path}/p")
    assert p.folder() is None and p.items() is None and p.release(merged, "t1", config="{}") == 1
    old, fewer, write, put = p.folder(), merged.where("title <> '联想 Y1'"), records._write, Versions.put
    for k in range(6):  # five files, then the one that names the version
        calls = []

        def failing(lines, path, calls=calls, k=k):
            calls.append(path)
            if len(calls) > k:
                raise OSError("lost")
            write(lines, path)

        def not_put(self, number, content):
            raise OSError("lost")

        monkeypatch.setattr(records, "_write", failing)
        if k == 5:
            monkeypatch.setattr(Versions, "put", not_put)
        with pytest.raises(OSError, match="lost"):
            p.release(fewer, "t2", config="{}")
        assert len(calls) == min(k + 1, 5) and p.folder() == old and titles(p) == ["联想 Y0", "联想 Y1", "联想 Y2", "联想 Y4"] and len(list((tmp_path / "p" / "versions").iterdir())) == 1
    monkeypatch.setattr(records, "_write", write)
    monkeypatch.setattr(Versions, "put", put)
    assert p.release(fewer, "t2", config="{}") == 2 and titles(p) == ["联想 Y0", "联想 Y2", "联想 Y4"] and titles(p, 1) == ["联想 Y0", "联想 Y1", "联想 Y2", "联想 Y4"]


def test_refusals_conflicts_and_going_back(spark, merged, tmp_path, monkeypatch):
    p = Publication(spark, f"file://{tmp_path}/p")
    with pytest.raises(ValueError):
        p.roll_back()
    p.release(merged, "t1")
    only = merged.withColumn("source", F.lit("zol")).withColumn("atomic_source_names", F.array(F.lit("ZOL"))).withColumn("source_count", F.lit(1))
    with pytest.raises(PublishGuardError, match="missing JD"):  # against what is published
        p.release(only, "t2")
    write = records._write
    monkeypatch.setattr(records, "_write", lambda lines, path: write(lines.limit(1) if path.endswith("items") else lines, path))
    with pytest.raises(PublishGuardError, match="were written"):  # what is read back is not what was meant
        p.release(merged, "t2")
    first = []

    def overtaken(lines, path):
        if not first:
            first.append(1)
            Publication(spark, p.root).release(merged.where("title <> '联想 Y2'"), "t2")
        write(lines, path)

    monkeypatch.setattr(records, "_write", overtaken)
    with pytest.raises(Conflict):
        p.release(merged, "t3")
    monkeypatch.setattr(records, "_write", write)
    assert p.versions() == [1, 2] and titles(p) == ["联想 Y0", "联想 Y1", "联想 Y4"] and len(list((tmp_path / "p" / "versions").iterdir())) == 2
    assert p.roll_back() == 3 and p.folder() == p.folder(1) and len(titles(p)) == 4
    assert len(p.vacuum(keep=1)) == 1 and p.versions() == [3] and len(titles(p)) == 4

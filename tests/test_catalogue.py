import math
import os

import duckdb
import pytest

from attesta.plans import catalogue

D = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(list(v) if isinstance(v, (list, tuple)) else v)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_matches_oracle(spark, duck, name):
    df = catalogue.QUERIES[name](spark, D)
    cols = sorted(df.columns)
    got = sorted("|".join(map(plain, r)) for r in df.select(*cols).collect())
    want = duck.execute(catalogue.ORACLES[name])
    at = [x[0] for x in want.description]
    assert sorted(at) == cols
    assert got == sorted("|".join(plain(r[at.index(c)]) for c in cols) for r in want.fetchall())

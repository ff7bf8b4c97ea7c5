"""Every query with an oracle, against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from meridian.plans.catalog import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or value != value:
        return None
    return float(f"{value:.9g}") if isinstance(value, int | float) and not isinstance(value, bool) else str(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    want = duck.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = lambda data: sorted((tuple(plain(v) for v in row) for row in data), key=str)
    assert rows(got.select(*columns).collect()) == rows(want.fetchall())

"""Every query against DuckDB on the smallest tables."""

import math
import os

import pytest

from tessella.plans import registry
from tessella.plans.views import TABLES

duckdb = pytest.importorskip("duckdb")
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registry.queries(), registry.oracle_sql()
#: At this size only.
MAY_BE_EMPTY = {"label_areas"}

@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    expected = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert got == expected and (got or name in MAY_BE_EMPTY)

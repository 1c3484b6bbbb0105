"""Queries over numbers of rows against DuckDB, on order keys from which on these numbers don't fit 64 bits."""

import os

import pytest
from pyspark.sql import functions as F

from tessella.plans import registry, views
from tessella.plans.views import TABLES

duckdb = pytest.importorskip("duckdb")
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
#: The SQL's number of a row in 128 bits.
WIDE = "((l_orderkey * 8 + l_linenumber)::HUGEINT * 1099511627776 + l_partkey * 16777216 + cast(round(l_extendedprice * 100) as bigint))"
SQL = {name: text for name, text in registry.oracle_sql().items() if views._ID in text}
NUMBERS = ("spot_id", "read_id", "id")


@pytest.fixture(scope="module")
def late(spark, tmp_path_factory):
    """(folder, DuckDB connection, the SQL's number by Spark's): order keys on both sides of 1 048 576."""
    folder, con = str(tmp_path_factory.mktemp("late")), duckdb.connect()
    for t in TABLES:
        keys = " replace (l_orderkey + CASE l_orderkey % 3 WHEN 0 THEN 9000000 ELSE 1048576 - 600 END AS l_orderkey)" if t == "lineitem" else ""
        con.execute(f"copy (select *{keys} from '{SF}/{t}.parquet') to '{folder}/{t}.parquet' (format parquet)")
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").select(F.expr(views._ANY_ID).alias("ours"), "l_orderkey", "l_linenumber", "l_partkey", F.expr("cast(round(l_extendedprice * 100) as bigint)"))
    return folder, con, {n: (o * 8 + line) * 2**40 + part * 2**24 + price for n, o, line, part, price in rows.collect()}


def plain(v):
    return round(v, 9) + 0.0 if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_late_orders(spark, late, name):
    folder, con, wide = late
    assert len(set(wide.values())) == len(wide) and min(wide) < 0 < max(wide)
    df = registry.queries()[name](spark, folder)
    columns = sorted(df.columns)
    told = lambda c, v: wide[v] if c in NUMBERS and isinstance(v, int) and dict(df.dtypes)[c] == "bigint" else plain(v)
    got = sorted((tuple(told(c, r[c]) for c in columns) for r in df.collect()), key=repr)
    want = con.sql(SQL[name].replace(views._ID, WIDE))
    at = [want.columns.index(c) for c in columns]
    expected = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert got == expected and got

"""Every query with SQL gives what DuckDB gives on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from celldex.plans.queries import ALL

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(rows):
    one = lambda v: round(v, 5) if isinstance(v, float) and math.isfinite(v) else v
    return sorted((tuple(one(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(k for k, (_, sql) in ALL.items() if sql))
def test_query(spark, duck, name):
    f, sql = ALL[name]
    got, want = f(spark, DIR), duck.sql(sql)
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert plain(got.select(*cols).collect()) == plain(want.select(*cols).fetchall())

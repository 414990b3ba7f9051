"""Registered queries against their DuckDB oracle on the smallest test tables (exact values)."""

import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from kickwx.oracle import oracle_queries

SF_SMALL = "/root/testdata/sf0.001"

# every query of the library itself; those of the optional subpackage have their own tests
KEYS = sorted(oracle_queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    return v


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(ocols)
    idx = [ocols.index(c) for c in df.columns]
    got = Counter(tuple(_norm(v) for v in r) for r in df.collect())
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want


def test_entry_runs(spark):
    out = E.entry(spark)
    assert out.columns == ["rain_category", "total_matches", "avg_goal_difference", "stddev_goal_difference"]
    assert out.count() > 0

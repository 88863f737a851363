"""The driver's contract, and every query against its SQL on the smallest tables."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from parlance.functions.dims import ALL_DIMS

DATA = "/root/testdata/sf0.001"


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{DATA}/{f}')")
    return c


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n in entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    plain = lambda v: float(v) if isinstance(v, Decimal) else v
    want = sorted((tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n not in entry.oracle_sql()))
def test_query_runs(spark, name):
    """On the smallest tables each of these has rows: those of p2 to p9 find cases, the others list all rows."""
    df = entry.queries()[name](spark, DATA)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_stub_scores_of_all_dimensions(spark):
    dims = {r["dim"] for r in entry.queries()["stub_scores_all"](spark, DATA).select("dim").distinct().collect()}
    assert dims == set(ALL_DIMS)

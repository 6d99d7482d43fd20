"""Every registered query against its independent DuckDB SQL on the sf0.001 tables."""

import datetime as dt
import decimal
import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as SE
from clinicgen.harness.queries import QUERIES

SF = "/root/testdata/sf0.001"
VIEWS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="harness tables not present")


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted(repr([_norm(r[i]) for i in order]) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in VIEWS:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SE.queries())
    assert set(QUERIES) <= set(SE.oracle_sql()) <= set(SE.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = SE.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SE.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_runs(spark):
    df = SE.entry(spark)
    assert df.columns and df.count() >= 0

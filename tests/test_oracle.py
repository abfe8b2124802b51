"""Every trade query against its DuckDB oracle (sf0.001; the driver checks sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from candela.plans.queries import QUERIES as TRADE_QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["events"]


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat(sep=" "))
    return (3, repr(v))


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


QUERIES = {k: v for k, v in entry.queries().items() if k in TRADE_QUERIES}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in TRADE_QUERIES}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    recs = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        pytest.skip("no SQL form")
    rel = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, recs) == _rows(rel.columns, rel.fetchall())


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0

"""The driver contract: every registered query runs and matches its SQL
oracle in DuckDB (row count, column names, multiset of values)."""

import math

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as E
from ledgerlens.plans.catalog import QUERIES
from ledgerlens.sources.tables import TABLES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF['0.001']}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 15


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF["0.001"])
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _canon(rows, df.columns) == _canon(rel.fetchall(), rel.columns)

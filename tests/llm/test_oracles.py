"""Queries with an SQL form equal it over whole tables; the library lives without them."""

import subprocess
import sys

import duckdb
import pytest
from conftest import ROOT, SF
from test_entry import _canon

import __spark_entry__ as E
from ledgerlens.llm.catalog import LLM_ORACLE, LLM_QUERIES


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF['0.01']}/{t}.parquet'")
    df = LLM_QUERIES[name](spark, SF["0.01"])
    rel = con.sql(LLM_ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(rel.fetchall(), rel.columns)


def test_all_are_registered():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert "pipeline" in names and set(LLM_ORACLE) <= set(E.oracle_sql())


def test_nothing_else_imports_the_subpackage():
    code = ("import sys; import ledgerlens.jobs, ledgerlens.plans.catalog; "
            "assert not any(m.startswith('ledgerlens.llm') for m in sys.modules)")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)

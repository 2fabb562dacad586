"""Every registered query against its DuckDB oracle on sf0.01 (the driver's gate)."""

import os
import sys

import duckdb
import pytest
from conftest import ROOT, SF001, SF01

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import TABLES, _digest  # noqa: E402

import __spark_entry__ as E  # noqa: E402

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF01}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_a_callable_and_oracle_keys_are_queries():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 59


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF01)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    d_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(s_rows) == len(d_rows)
    assert _digest(df.columns, s_rows)[0] == _digest(rel.columns, d_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["op_unique_carrier", "flights", "avg_arr_delay", "avg_dep_delay",
                          "delayed_pct", "big_delay_pct", "early_pct"]
    assert df.count() > 0
    assert SF001 in E.SMOKE_DIR

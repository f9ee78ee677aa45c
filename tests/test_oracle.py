"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, rows_multiset

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert df.columns  # rows-only queries: they run and have a schema
        return
    cur = duck.execute(ORACLES[name])
    d_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert rows_multiset(df.columns, rows) == rows_multiset(d_cols, cur.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "transaction_value" in df.columns

"""Every registered query against its DuckDB oracle on sf0.001 (same rules as
the driver's check: same column names, same row count, same multiset of rows).
Queries without an oracle must run and return a stable schema."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import rows  # noqa: E402

from tickframe.sources.tables import TABLES  # noqa: E402

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    sp = QUERIES[name](spark, SF_SMALL).toPandas()
    dp = con.execute(SQL[name]).df()
    assert sorted(sp.columns) == sorted(dp.columns)
    assert len(sp) == len(dp)
    assert rows(sp, 6) == rows(dp, 6)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.schema == QUERIES[name](spark, SF_SMALL).schema
    assert df.count() >= 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "change_in_percent" in df.columns

"""Every registered query against its DuckDB oracle on the smallest test tables."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from ledgerline.checks.oracles import oracle_sql  # noqa: E402
from ledgerline.plans.registry import QUERIES  # noqa: E402
from oracle_check import TABLES, canon  # noqa: E402

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_DIR}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "order_id" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert canon(df.columns, rows) == canon(rel.columns, rel.fetchall())

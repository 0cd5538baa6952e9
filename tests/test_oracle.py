"""Every registered query against its DuckDB oracle at sf0.001 (the driver does the same at sf0.01)."""

from __future__ import annotations

import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from oracle.queries import ORACLE

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "customer", "lineitem"]


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = Counter(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    orows = Counter(tuple(_norm(v) for _, v in sorted(zip(rel.columns, r))) for r in rel.fetchall())
    assert srows == orows


def test_every_query_of_the_scorecard_has_an_oracle():
    from scorewright.plans.catalog import QUERIES
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["flow_pos", "n_rows", "mean_score"]
    assert sum(r.n_rows for r in df.collect()) == 1500

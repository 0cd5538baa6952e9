"""The text queries that SQL can state, against DuckDB at sf0.001."""

from __future__ import annotations

import duckdb
import pytest

from scorewright.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_text_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(rel.columns)
    assert sorted(tuple(r) for r in got.select(*rel.columns).collect()) == sorted(rel.fetchall())

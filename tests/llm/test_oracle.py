"""Registered queries against their DuckDB SQL."""

from __future__ import annotations

import duckdb
import pytest

from scripts.check_oracle import rows
from telemetra.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    got, want = Q.QUERIES[name](spark, sf_dir).toPandas(), con.execute(Q.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    assert rows(got, 9) == rows(want, 9)

"""Every registered query against its DuckDB oracle on the smallest fixture."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import rows
from telemetra.plans.catalog import load_all
from telemetra.sources.tables import TABLES

QUERIES = {k: f for k, f in E.queries().items() if k in load_all()}
ORACLE = {k: f for k, f in E.oracle_sql().items() if k in load_all()}


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"inject_dirt_landing"}
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    s = QUERIES[name](spark, sf_dir).toArrow().to_pandas(timestamp_as_object=True, date_as_object=True)
    if name not in ORACLE:
        assert len(s) >= 0
        return
    d = con.sql(ORACLE[name]).to_arrow_table().to_pandas(timestamp_as_object=True, date_as_object=True)
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert rows(s, 9) == rows(d, 9)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["robot_id", "as_of_date", "as_of_date_key"]

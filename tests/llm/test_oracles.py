"""Queries that SQL can express, against DuckDB on whole small tables."""

from collections import Counter

import duckdb
import pytest

from feedlake.llm.oracle import ORACLE
from feedlake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, tables, sf_dir, name):
    sql = tables.sql(ORACLE[name])
    got = QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(sql.columns)
    assert Counter(map(tuple, got.select(*sql.columns).collect())) == Counter(sql.fetchall())

"""Every catalogue query against its DuckDB oracle on the smallest tables,
and plan checks: no Python worker anywhere in the catalogue."""

import collections
import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from feedlake.plans import catalogue, oracle

# the library's own queries; the corpus operators have tests of their own
QUERIES, ORACLE = catalogue.QUERIES, oracle.ORACLE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


TOP_K = {"preview_rows", "distinct_time_values"}  # the limit is the feature


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle_and_stays_in_the_jvm(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan
    limited = any(op in plan for op in ("GlobalLimit", "CollectLimit", "TakeOrderedAndProject", "LocalLimit"))
    assert limited == (name in TOP_K)
    rows = df.collect()
    rel = con.sql(ORACLE[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    s = collections.Counter(tuple(_norm(r[c]) for c in cols) for r in rows)
    idx = [rel.columns.index(c) for c in cols]
    o = collections.Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert s == o


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["coin_id", "date"]

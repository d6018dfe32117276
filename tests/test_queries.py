"""Every registered query against its SQL form, and the shape of its plan."""

import duckdb
import pytest

import __spark_entry__ as entry
from workload.registry import ORACLES, QUERIES, TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, duck, key):
    df = QUERIES[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=_key)
    result = duck.sql(ORACLES[key])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_key)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())

"""The driver contract: entry runs on sf0.001; every query has an oracle; queries run on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from sparkmart.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["entity_name", "watermark_ts"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "events", "nation"):
        c.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_sf0001(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())
    res = con.sql(E.oracle_sql()[name])
    cols = res.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    exp = sorted(tuple(str(r[i]) for i in order) for r in res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(exp)
    assert got == exp


@pytest.mark.parametrize("name", ["json_flatten", "upsert", "run_status", "paging", "fact_commits",
                                  "incremental", "dq_recent"])
def test_no_python_evaluation_in_plans(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan

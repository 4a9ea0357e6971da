"""Whole runs on sf0.001: two incremental runs, rerun idempotence, failure keeps the marks."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.plans.pipeline import run, tpch_feeds
from sparkmart.session import checkpoint_root
from sparkmart.sources.warehouse import Warehouse

UTC = dt.timezone.utc
HISTORY = "36500 days"  # the driver tables are historical: read them all on the first run
# stamps of the run (the boundary commit at a mark is re-read, so its ingest time moves too)
STAMPS = ("last_seen_at", "load_dts", "updated_at", "raw_ingested_at")


def _wh(spark):
    return Warehouse(spark, f"{checkpoint_root(spark)}/wh-{uuid.uuid4().hex}")


def _strip(df, *stamps):
    return sorted(tuple(r) for r in df.drop(*stamps).collect())


@pytest.fixture(scope="module")
def two_runs(spark, sf001):
    wh = _wh(spark)
    r1 = run(spark, wh, tpch_feeds(spark, sf001, until=dt.datetime(1998, 1, 1)),
             dt.datetime(2024, 2, 1, tzinfo=UTC), "run1", lookback=HISTORY)
    r2 = run(spark, wh, tpch_feeds(spark, sf001), dt.datetime(2024, 2, 2, tzinfo=UTC), "run2",
             lookback=HISTORY)
    return wh, r1, r2


def test_two_runs_load_everything(spark, sf001, two_runs):
    wh, r1, r2 = two_runs
    assert r1.status == "SUCCESS" and r2.status == "SUCCESS"
    orders = spark.read.parquet(f"{sf001}/orders.parquet")
    assert wh.read("fact_commits").count() == orders.count()
    fact_keys = wh.read("fact_commits").agg(F.count_distinct("commit_key"), F.max("commit_key")).first()
    assert fact_keys[0] == fact_keys[1] == orders.count()  # dense surrogate keys
    log = {r.run_id: r for r in wh.read("etl_run_log").collect()}
    assert log["run1"].fact_commits_rows < log["run2"].fact_commits_rows == orders.count()
    assert all(c["ok"] == 1 for c in r2.checks) and len(r2.checks) == 4
    # Landed counts observed by the writes; one commit batch per repository per run
    customers = spark.read.parquet(f"{sf001}/customer.parquet").count()
    assert r2.landed["extract_commits_to_raw"]["chunks"] == customers  # <= 1,000 records each
    assert r1.landed["extract_repos_to_raw"]["records"] == customers


def test_rerun_is_idempotent(spark, sf001, two_runs):
    wh, _, _ = two_runs
    before = {n: _strip(wh.read(n), *STAMPS)
              for n in ("stg_commits", "fact_commits", "dim_repository", "etl_watermark")}
    run(spark, wh, tpch_feeds(spark, sf001), dt.datetime(2024, 2, 3, tzinfo=UTC), "run3",
        lookback=HISTORY)
    for n, rows in before.items():
        assert _strip(wh.read(n), *STAMPS) == rows, n


def test_failed_fact_load_keeps_marks_and_logs_cause(spark, sf001):
    wh = _wh(spark)
    run(spark, wh, tpch_feeds(spark, sf001, until=dt.datetime(1998, 1, 1)),
        dt.datetime(2024, 2, 1, tzinfo=UTC), "run1", lookback=HISTORY)
    marks_before = sorted(tuple(r) for r in wh.read("etl_watermark").collect())
    fact_v = wh.versions("fact_commits")
    with pytest.raises(RuntimeError):
        run(spark, wh, tpch_feeds(spark, sf001), dt.datetime(2024, 2, 2, tzinfo=UTC), "run2",
            lookback=HISTORY, fail_at="load_fact_commits")
    assert sorted(tuple(r) for r in wh.read("etl_watermark").collect()) == marks_before
    assert wh.versions("fact_commits") == fact_v
    log = {r.run_id: r for r in wh.read("etl_run_log").collect()}
    assert log["run2"].status == "FAILED"
    assert log["run2"].error_message == "FAILED task: load_fact_commits"


def test_uncommitted_version_is_ignored(spark):
    wh = _wh(spark)
    wh.ensure_tables(["etl_watermark"])
    # a crashed writer leaves a version directory without _SUCCESS
    spark.range(3).write.parquet(f"{wh.root}/etl_watermark/v=00000009")
    import os
    os.remove(f"{wh.root}/etl_watermark/v=00000009/_SUCCESS")
    assert wh.versions("etl_watermark") == []
    v = wh.replace("etl_watermark", wh.read("etl_watermark"))
    assert v == 1 and wh.read("etl_watermark").count() == 0
    assert wh.read("etl_watermark").schema == S.ETL_WATERMARK.schema


def test_keys_defaults_and_crashed_versions(spark):
    wh = _wh(spark)
    rows = spark.createDataFrame([("p", "e1", None), ("p", "e2", None)],
                                 "pipeline_name string, entity_name string, watermark_ts timestamp")
    now = dt.datetime(2024, 3, 1, tzinfo=UTC)
    wh.replace("etl_watermark", rows, as_of=now, check_keys=True)
    assert wh.read("etl_watermark").where(F.col("updated_at") == F.lit(now)).count() == 2
    with pytest.raises(Exception, match="UNIQUE"):
        wh.replace("etl_watermark", rows.union(rows.limit(1)), as_of=now, check_keys=True)
    assert wh.read("etl_watermark").count() == 2  # the broken version was never committed
    wh.replace("etl_watermark", rows, as_of=now)
    import os
    folders = sorted(f for f in os.listdir(f"{wh.root}/etl_watermark") if f.startswith("v="))
    assert len(folders) == 3
    assert wh.vacuum("etl_watermark", keep=1) == [1]
    assert [f for f in os.listdir(f"{wh.root}/etl_watermark") if f.startswith("v=")] == folders[-1:]


def test_checks_are_kept(spark, two_runs):
    wh, _, _ = two_runs
    rows = wh.read("dq_results").where("run_id in ('run1', 'run2')").collect()
    assert len(rows) == 8 and all(r.ok == 1 and r.violations == 0 for r in rows)


def test_checks_first_keeps_marks_on_failed_check(spark, sf001):
    wh = _wh(spark)
    run(spark, wh, tpch_feeds(spark, sf001, until=dt.datetime(1998, 1, 1)),
        dt.datetime(2024, 2, 1, tzinfo=UTC), "run1", lookback=HISTORY)
    marks_before = sorted(tuple(r) for r in wh.read("etl_watermark").collect())
    with pytest.raises(Exception):
        run(spark, wh, tpch_feeds(spark, sf001), dt.datetime(2024, 2, 2, tzinfo=UTC), "run2",
            lookback=HISTORY, checks_first=True, fail_at="dq_fact_repo_fk_dim")
    assert sorted(tuple(r) for r in wh.read("etl_watermark").collect()) == marks_before
    log = {r.run_id: r for r in wh.read("etl_run_log").collect()}
    assert log["run2"].error_message == "FAILED task: dq_fact_repo_fk_dim"
    r3 = run(spark, wh, tpch_feeds(spark, sf001), dt.datetime(2024, 2, 3, tzinfo=UTC), "run3",
             lookback=HISTORY, checks_first=True)
    assert r3.status == "SUCCESS" and len(r3.checks) == 4


def test_incremental_runs_equal_full_reprocessing(spark, sf001, two_runs):
    full, _, _ = two_runs
    wh = _wh(spark)
    run(spark, wh, tpch_feeds(spark, sf001, until=dt.datetime(1998, 1, 1)),
        dt.datetime(2024, 2, 1, tzinfo=UTC), "run1", lookback=HISTORY, incremental=True)
    r2 = run(spark, wh, tpch_feeds(spark, sf001), dt.datetime(2024, 2, 2, tzinfo=UTC), "run2",
             lookback=HISTORY, incremental=True)
    assert r2.status == "SUCCESS"
    for n in ("stg_commits", "fact_commits", "etl_watermark"):
        assert _strip(wh.read(n), *STAMPS) == _strip(full.read(n), *STAMPS), n


def test_delta_mode_stages_what_a_failed_run_landed(spark, sf001):
    wh = _wh(spark)
    feeds = tpch_feeds(spark, sf001)
    day = dt.datetime(1998, 7, 1, tzinfo=UTC)
    r1 = run(spark, wh, feeds, day, "run1", lookback="800 days", incremental=True,
             fail_at="transform_commits_to_stg", raise_on_failure=False)
    assert r1.status == "FAILED" and wh.read("stg_commits").count() == 0
    # a rerun at the same time fails as well, after taking the mark back
    run(spark, wh, feeds, day, "run1b", lookback="800 days", incremental=True,
        fail_at="transform_commits_to_stg", raise_on_failure=False)
    r2 = run(spark, wh, feeds, day + dt.timedelta(days=400), "run2", lookback="800 days",
             incremental=True)
    assert r2.status == "SUCCESS"
    orders = spark.read.parquet(f"{sf001}/orders.parquet")
    landed = orders.where(F.col("o_orderdate") >= F.lit(day.replace(tzinfo=None))
                          - F.expr("INTERVAL 800 DAYS")).count()
    later = orders.where(F.col("o_orderdate") >= F.lit(day.replace(tzinfo=None))
                         - F.expr("INTERVAL 400 DAYS")).count()
    assert wh.read("stg_commits").count() == wh.read("fact_commits").count() == landed > later


def test_successful_runs_keep_two_versions(spark, sf001, two_runs):
    wh, _, _ = two_runs
    for name in ("stg_commits", "fact_commits", "etl_watermark", "etl_run_log"):
        assert len(wh.versions(name)) <= 2, name


def test_recent_check_prunes_ingest_date_partitions(spark):
    from sparkmart.operators.quality import dq_recent_raw_has_effect
    from tests.helpers import commit, raw_commits

    wh = _wh(spark)
    for day in (1, 2, 3):
        wh.append("raw_commits", raw_commits(spark, [(dt.datetime(2024, 1, day, tzinfo=UTC), "o/a",
                                                      [commit(f"c{day}")])]))
    raw = wh.read("raw_commits")
    stg = spark.createDataFrame([(dt.datetime(2024, 1, 3, tzinfo=UTC),)], "raw_ingested_at timestamp")
    check = dq_recent_raw_has_effect(raw, stg, dt.datetime(2024, 1, 3, 0, 10, tzinfo=UTC))
    assert check.first().ok == 1
    plan = check._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "ingest_date" in plan


def test_default_columns(spark):
    from sparkmart.operators.constraints import default_columns

    cols = default_columns(S.DIM_REPOSITORY.defaults, dt.datetime(2024, 1, 1, tzinfo=UTC))
    row = spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()
    assert row.is_current is True and row.effective_from.year == 2024
    with pytest.raises(ValueError):
        default_columns(S.DIM_REPOSITORY.defaults)

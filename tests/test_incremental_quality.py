"""Marks (I1-I4), paging (S4), checks (Q1-Q5) and run outcome (R1-R5) on hand fixtures."""

import pytest
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.operators.incremental import (advance_watermark, cap_oldest, compute_marks,
                                             filter_incremental, resolve_since, select_entities)
from sparkmart.operators.quality import (QualityGateError, dq_foreign_key, dq_not_null,
                                         dq_recent_raw_has_effect, dq_watermark_not_ahead, gate,
                                         run_checks)
from sparkmart.operators.runlog import run_end, run_outcome, run_start
from sparkmart.plans.tables import empty
from sparkmart.sources.paging import keep_fetched_pages
from tests.helpers import ts


def _marks(spark, rows):
    return spark.createDataFrame([(S.MARKS_PIPELINE, e, w, ts(2024, 1, 1)) for e, w in rows],
                                 S.ETL_WATERMARK.schema)


def test_resolve_since_falls_back(spark):
    ents = spark.createDataFrame([("a",), ("b",), ("c",)], "entity_name string")
    marks = _marks(spark, [("a", ts(2024, 1, 10)), ("b", None)])
    got = {r.entity_name: r.since for r in resolve_since(ents, marks, ts(2024, 2, 1, 5, 6, 7)).collect()}
    assert got["a"].replace(tzinfo=None).isoformat() == "2024-01-10T00:00:00"
    assert got["b"] == got["c"]
    assert got["c"].replace(tzinfo=None).isoformat() == "2024-01-25T05:06:07"


def test_filter_incremental_inclusive(spark):
    recs = spark.createDataFrame([("a", ts(2024, 1, 9)), ("a", ts(2024, 1, 10)), ("a", ts(2024, 1, 11)),
                                  ("z", ts(2024, 1, 11))], "e string, t timestamp")
    since = spark.createDataFrame([("a", ts(2024, 1, 10))], "e string, since timestamp")
    out = filter_incremental(recs, since, entity_col="e", ts_col="t")
    assert sorted(r.t.day for r in out.collect()) == [10, 11]


def test_cap_oldest_keeps_ties(spark):
    recs = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("a", 3)], "e string, t long")
    assert sorted(r.t for r in cap_oldest(recs, entity_col="e", ts_col="t", cap=2).collect()) == [1, 2, 2]


def _fact_dim(spark):
    fact = spark.createDataFrame(
        [("c1", 1, ts(2024, 1, 5)), ("c2", 1, ts(2024, 1, 7)), ("c3", 2, None), ("c4", 3, ts(2024, 1, 1))],
        "sha string, repo_id long, committed_at timestamp")
    dim = spark.createDataFrame([(1, "o/a"), (2, "o/b"), (3, "o/a")], "repo_id long, full_name string")
    return fact, dim


def test_marks_from_fact_and_null_dates(spark):
    fact, dim = _fact_dim(spark)
    got = {r.entity_name: r.watermark_ts for r in compute_marks(fact, dim).collect()}
    assert got["o/a"].day == 7 and got["o/b"] is None
    marks = advance_watermark(empty(spark, S.ETL_WATERMARK), fact, dim, ts(2024, 2, 1))
    assert marks.count() == 2
    # a NULL mark: the next read falls back, and Q3 fails
    q3 = dq_watermark_not_ahead(marks, dim, fact).first()
    assert q3.ok == 0 and q3.violations == 1


def test_monotone_marks_never_go_down(spark):
    fact, dim = _fact_dim(spark)
    old = _marks(spark, [("o/a", ts(2024, 3, 1))])
    m = advance_watermark(old, fact, dim, ts(2024, 2, 1), monotone=True)
    assert {r.entity_name: r.watermark_ts.month for r in m.collect() if r.watermark_ts}["o/a"] == 3
    m2 = advance_watermark(old, fact, dim, ts(2024, 2, 1))
    assert {r.entity_name: r.watermark_ts.month for r in m2.collect() if r.watermark_ts}["o/a"] == 1


def test_renamed_repo_orphans_mark(spark):
    fact, dim = _fact_dim(spark)
    marks = _marks(spark, [("o/old-name", ts(2024, 1, 1)), ("o/a", ts(2024, 1, 7))])
    q3 = dq_watermark_not_ahead(marks, dim, fact).first()
    assert q3.ok == 0 and q3.violations == 1
    from sparkmart.operators.quality import watermark_violations
    assert [r.entity_name for r in watermark_violations(marks, dim, fact).collect()] == ["o/old-name"]


def test_select_entities_nulls_last(spark):
    stg = spark.createDataFrame([(1, "a", None), (2, "b", ts(2024, 1, 2)), (3, "c", ts(2024, 1, 3))],
                                "repo_id long, full_name string, pushed_at timestamp")
    assert [r.full_name for r in select_entities(stg, 2).collect()] == ["c", "b"]
    assert [r.full_name for r in select_entities(stg, 3).collect()][-1] == "a"


@pytest.mark.parametrize("sizes,kept", [([100, 100, 40, 100], [1, 2, 3]), ([100, 0, 100], [1]),
                                        ([100] * 12, list(range(1, 11))), ([], [])])
def test_page_stop_rule(spark, sizes, kept):
    pages = spark.createDataFrame([("e", i + 1, n) for i, n in enumerate(sizes)],
                                  "entity string, page int, n int")
    got = sorted(r.page for r in keep_fetched_pages(pages, "entity").collect())
    assert got == kept


def test_q1_q2_fail_on_null_repo(spark):
    fact = spark.createDataFrame([("c1", None), ("c2", 1), ("c3", 9)], "sha string, repo_id long")
    dim = spark.createDataFrame([(1,)], "repo_id long")
    assert dq_not_null(fact).first().ok == 0
    q2 = dq_foreign_key(fact, dim).first()
    assert q2.ok == 0 and q2.violations == 2
    with pytest.raises(QualityGateError):
        gate(run_checks([dq_not_null(fact), dq_foreign_key(fact, dim)]))


def _raw(spark, rows):
    df = spark.createDataFrame(rows, "ingested_at timestamp, text string")
    return df.select("ingested_at", F.parse_json("text").alias("payload"))


def test_q4_cases(spark):
    as_of = ts(2024, 1, 1, 12)
    stg_old = spark.createDataFrame([(ts(2024, 1, 1, 9),)], "raw_ingested_at timestamp")
    stg_new = spark.createDataFrame([(ts(2024, 1, 1, 11, 50),)], "raw_ingested_at timestamp")
    no_recent = _raw(spark, [(ts(2024, 1, 1, 9), '[{"sha": "a"}]')])
    recent_empty = _raw(spark, [(ts(2024, 1, 1, 11, 45), "[]")])
    recent = _raw(spark, [(ts(2024, 1, 1, 11, 45), '[{"sha": "a"}]')])
    assert dq_recent_raw_has_effect(no_recent, stg_old, as_of).first().ok == 1
    assert dq_recent_raw_has_effect(recent_empty, stg_old, as_of).first().ok == 1
    assert dq_recent_raw_has_effect(recent, stg_old, as_of).first().ok == 0
    assert dq_recent_raw_has_effect(recent, stg_new, as_of).first().ok == 1


def _states(spark, rows):
    return spark.createDataFrame([("d", r, t, s) for r, t, s in rows], S.TASK_STATES.schema)


def test_run_outcome_branches(spark):
    ts_df = _states(spark, [
        ("r1", "t1", "success"), ("r1", "t2", None),
        ("r2", "t1", "success"), ("r2", "t2", "success"), ("r2", "log_run_end", None),
        ("r3", "b", "upstream_failed"), ("r3", "c", "failed"), ("r3", "a", "failed"),
        ("r4", "x", "upstream_failed"), ("r4", "y", "success"),
    ])
    runs = spark.createDataFrame([("d", "r5")], "dag_id string, run_id string")
    out = {r.run_id: r for r in run_outcome(ts_df, runs=runs.unionByName(
        ts_df.select("dag_id", "run_id"))).collect()}
    assert out["r1"].status == "FAILED"
    assert out["r1"].error_message == "Incomplete run; states={'none': 1, 'success': 1}"
    assert out["r1"].culprit_task == "t2" and out["r1"].culprit_state == "none"
    assert out["r2"].status == "SUCCESS" and out["r2"].error_message is None
    assert out["r3"].error_message == "FAILED task: a"
    assert out["r4"].error_message == "UPSTREAM_FAILED task: x"
    assert out["r5"].status == "SUCCESS" and out["r5"].n_tasks == 0


def test_run_start_restart_and_end(spark):
    log = empty(spark, S.ETL_RUN_LOG)
    log = run_start(log, ts(2024, 1, 1), pipeline="p", dag_id="d", run_id="r", logical_date=ts(2023, 12, 31))
    outcome = run_outcome(_states(spark, [("r", "t", "failed")]))
    tables = {"fact_commits_rows": spark.range(3)}
    log = run_end(log, outcome, tables, ts(2024, 1, 1, 1), pipeline="p")
    row = log.first()
    assert row.status == "FAILED" and row.fact_commits_rows == 3 and row.end_ts is not None
    # restart: RUNNING again, end/error cleared, logical_date and metrics kept
    log2 = run_start(log, ts(2024, 1, 2), pipeline="p", dag_id="d", run_id="r", logical_date=ts(2030, 1, 1))
    r2 = log2.first()
    assert r2.status == "RUNNING" and r2.end_ts is None and r2.error_message is None
    assert r2.logical_date.year == 2023 and r2.fact_commits_rows == 3
    # end record without a start: nothing written
    other = run_outcome(_states(spark, [("zz", "t", "success")]))
    log3 = run_end(log2, other, tables, ts(2024, 1, 3), pipeline="p")
    assert log3.count() == 1


def test_q2_is_planned_as_anti_join(spark):
    fact = spark.range(100).select((F.col("id") % 7).alias("repo_id"))
    dim = spark.range(5).select(F.col("id").alias("repo_id"))
    plan = dq_foreign_key(fact, dim)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "LeftOuter" not in plan

"""Change sets, the staging ledger, summaries that follow change rows, and carried counts."""

import datetime as dt
import os
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.operators.quality import dq_foreign_key, dq_not_null, dq_watermark_not_ahead
from sparkmart.operators.rollup import (BEFORE, advance_by_month, advance_by_repo, monthly_activity,
                                        repo_facts)
from sparkmart.operators.upsert import upsert
from sparkmart.plans.staging import Ledger, layer_rows, recall_rows
from sparkmart.session import checkpoint_root
from sparkmart.sources.warehouse import Warehouse
from sparkmart.streaming.incremental import load_fact_delta, stage_commit_delta
from tests.helpers import commit, raw_commits, ts

SRC = "sha string, repo_id long, committed_at timestamp"


@pytest.fixture
def wh(spark):
    return Warehouse(spark, f"{checkpoint_root(spark)}/wh-{uuid.uuid4().hex}")


def load(wh, rows, **kw):
    """Upsert fact rows as a change set."""
    src = wh.spark.createDataFrame(rows, SRC)
    return wh.append_changes("fact_commits", upsert(
        wh.read("fact_commits"), src, ["sha"], ["repo_id", "committed_at"],
        on_insert={"load_dts": F.lit(ts(2024, 1, 1))}, surrogate_key="commit_key", changes_only=True,
        before=BEFORE, **kw))


def summary(wh):
    return {r.repo_id: (r.n, r.committed_at) for r in repo_facts(wh).collect()}


def from_fact(wh):
    return {r.repo_id: (r.n, r.m) for r in wh.read("fact_commits").groupBy("repo_id").agg(
        F.count("*").alias("n"), F.max("committed_at").alias("m")).collect()}


def test_a_delta_writes_its_rows_and_the_state_reads_them(spark, wh):
    days = [ts(2024, 1, 1 + i % 28) for i in range(400)]
    load(wh, [(f"c{i:04}", i % 7, d) for i, d in enumerate(days)])
    assert wh.fold("fact_commits", sets=1) and wh.full_versions("fact_commits") == [1]
    n = load(wh, [("c0003", 99, days[0]), ("new1", 1, days[1]), ("new2", 1, None)])
    files = f"{wh.root}/fact_commits/changes/c={n:08d}"
    assert spark.read.parquet(files).count() == 3  # under 1 % of the table
    state = {r.sha: r for r in wh.read("fact_commits").collect()}
    assert len(state) == 402 == wh.rows("fact_commits") and state["c0003"].repo_id == 99
    assert sorted(r.commit_key for r in state.values()) == list(range(1, 403))
    assert wh.read("fact_commits", version=1).count() == 400
    load(wh, [("c0003", 5, days[2])])
    assert wh.read("fact_commits").where("sha = 'c0003'").first().repo_id == 5
    before = sorted(wh.read("fact_commits").collect())
    assert not wh.fold("fact_commits", sets=9) and wh.fold("fact_commits", sets=2)
    assert sorted(wh.read("fact_commits").collect()) == before and wh.versions("fact_commits") == [1, 2, 3]
    assert wh.vacuum("fact_commits", keep=1) == [1, 1, 2, 3]
    assert sorted(wh.read("fact_commits").collect()) == before and wh.rows("fact_commits") == 402
    with pytest.raises(ValueError, match="_op"):
        wh.append_changes("fact_commits", wh.read("fact_commits"))


def test_crashed_change_sets_and_folds_are_not_read(spark, wh):
    load(wh, [("a", 1, ts(2024, 1, 1))])
    for path in (f"{wh.root}/fact_commits/changes/c=00000002", f"{wh.root}/fact_commits/v=00000001"):
        wh.read("fact_commits").write.parquet(path)
        os.remove(f"{path}/_SUCCESS")
    assert wh.versions("fact_commits") == [1] and wh.read("fact_commits").count() == 1
    assert load(wh, [("b", 1, ts(2024, 1, 1))]) == 3
    assert wh.fold("fact_commits", sets=1) and wh.read("fact_commits").count() == 2


ROWS = st.lists(st.tuples(st.sampled_from("abcdef"), st.integers(1, 3), st.sampled_from([None, 1, 2, 40])),
                unique_by=lambda r: r[0], max_size=5)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(loads=st.lists(ROWS, min_size=2, max_size=3), every=st.booleans())
def test_summaries_equal_the_fact(spark, loads, every):
    wh = Warehouse(spark, f"{checkpoint_root(spark)}/wh-{uuid.uuid4().hex}")
    for i, rows in enumerate(loads):
        load(wh, [(s, r, None if d is None else ts(2024, 1, 1) + dt.timedelta(days=d)) for s, r, d in rows])
        if every or i == len(loads) - 1 or i == 0:
            advance_by_repo(wh)
            advance_by_month(wh)
            assert summary(wh) == from_fact(wh)
    months = wh.read("fact_by_month").where("n_commits > 0").select("repo_id", "month_start", "n_commits")
    want = wh.read("fact_commits").groupBy("repo_id", F.date_trunc("month", "committed_at")).count()
    assert sorted(map(str, months.collect())) != [] or want.count() == 0
    assert {tuple(r) for r in months.collect()} == {tuple(r) for r in want.collect()}


def test_newest_time_falls_only_where_it_must(spark, wh):
    load(wh, [("a", 1, ts(2024, 1, 9)), ("b", 1, ts(2024, 1, 5)), ("c", 2, ts(2024, 1, 7))])
    advance_by_repo(wh)
    load(wh, [("a", 2, ts(2024, 1, 9)), ("c", 2, ts(2024, 1, 1))])
    advance_by_repo(wh)
    assert summary(wh) == from_fact(wh) and {k: (n, t.day) for k, (n, t) in summary(wh).items()} == {
        1: (1, 5), 2: (2, 9)}
    assert len(wh.change_versions("fact_by_repo")) == 1  # the first was a whole version
    version = wh.versions("fact_by_repo")
    advance_by_repo(wh)  # nothing new: nothing written
    assert wh.versions("fact_by_repo") == version
    wh.replace("fact_commits", wh.read("fact_commits").where("sha <> 'a'"))  # others wrote: built anew
    advance_by_repo(wh)
    assert summary(wh) == from_fact(wh) and len(wh.full_versions("fact_by_repo")) == 2


@pytest.mark.parametrize("old_rows", [True, False])
def test_checks_on_the_summary_equal_full_checks(spark, wh, old_rows):
    good = [("a", 1, ts(2024, 1, 9)), ("b", 2, ts(2024, 1, 5))]
    bad = [("x", 7, ts(2024, 1, 1)), ("y", 7, ts(2024, 1, 2)), ("z", 8, None)]
    load(wh, good + bad if old_rows else good)
    advance_by_repo(wh)
    load(wh, [("n", 1, ts(2024, 1, 8))] + ([] if old_rows else bad))
    advance_by_repo(wh)
    dim = spark.createDataFrame([(1, "o/a"), (2, "o/b"), (8, "o/c")], "repo_id long, full_name string")
    marks = spark.createDataFrame([("p", "o/a", ts(2024, 1, 9)), ("p", "o/b", ts(2024, 1, 6)), ("p", "o/c", None),
                                   ("p", "gone", ts(2024, 1, 1))],
                                  "pipeline_name string, entity_name string, watermark_ts timestamp")
    fact, facts = wh.read("fact_commits"), repo_facts(wh)
    pairs = [(dq_not_null(fact), dq_not_null(facts, weight="n"), 0),
             (dq_foreign_key(fact, dim), dq_foreign_key(facts, dim, weight="n"), 2),
             (dq_watermark_not_ahead(marks, dim, fact, pipeline="p"),
              dq_watermark_not_ahead(marks, dim, facts, pipeline="p"), 3)]
    for whole, delta, n in pairs:
        assert whole.collect() == delta.collect() and delta.first().violations == n
    nulls = spark.createDataFrame([(None, ts(2024, 1, 1), 4)], "repo_id long, committed_at timestamp, n long")
    assert dq_not_null(nulls, weight="n").first().violations == 4


def raw(spark, wh, at, scopes):
    rows = raw_commits(spark, [(at, f"{s}/r", [commit(f"{s}-{at:%d%H}")]) for s in scopes])
    rows = rows.withColumn("org_or_user", F.split("repo_full_name", "/")[0])
    wh.append("raw_commits", rows.withColumn("batch_id", F.concat_ws("/", "repo_full_name", "ingested_at")))


def waiting(ledger):
    return sorted(r.batch_id[:1] + f"{r.ingested_at:%d}" for r in ledger.unstaged("raw_commits").collect())


def test_ledger_keeps_what_other_scopes_left(spark, wh):
    days = [ts(2024, 1, d) for d in range(1, 6)]
    raw(spark, wh, days[0], "ab")
    assert waiting(Ledger(wh)) == ["a01", "b01"]
    Ledger(wh).close("raw_commits", days[0], "a")
    assert waiting(Ledger(wh)) == ["b01"]
    raw(spark, wh, days[1], "ab")
    Ledger(wh).close("raw_commits", days[1], "a")
    assert waiting(Ledger(wh)) == ["b01", "b02"]
    assert {r.org_or_user for r in Ledger(wh).staged("raw_commits").collect()} == {"a"}
    Ledger(wh).close("raw_commits", days[1], "b")
    assert waiting(Ledger(wh)) == [] and wh.read("etl_staged_batch").count() == 0  # the mark stands for all
    raw(spark, wh, days[2], "ab")
    Ledger(wh).close("raw_commits", days[2], "b")
    Ledger(wh).close("raw_commits", days[2])
    assert waiting(Ledger(wh)) == []
    Ledger(wh).before_landing("raw_commits", days[2])  # a rerun at that time lands again
    assert waiting(Ledger(wh)) == ["a03", "b03"]
    Ledger(wh).close("raw_commits", days[2], "a")
    Ledger(wh).before_landing("raw_commits", days[2])
    assert waiting(Ledger(wh)) == ["a03", "b03"]


def test_commits_wait_for_their_repository(spark, wh):
    names = [(1, "o/a")]
    full = [f.name for f in S.STG_REPOS.schema.fields]

    def repos():
        df = spark.createDataFrame(names, "repo_id long, full_name string")
        values = {"name": F.lit("r"), "owner_login": F.lit("o"), "is_private": F.lit(False),
                  "raw_ingested_at": F.lit(ts(2024, 1, 1)), "last_seen_at": F.lit(ts(2024, 1, 1))}
        wh.replace("stg_repos", df.select(*[
            F.col(c) if c in df.columns else values.get(c, F.lit(None)).cast(S.STG_REPOS.schema[c].dataType).alias(c)
            for c in full]))

    def deliver(at, *batches):
        stage_commit_delta(wh, raw_commits(spark, [(at, repo, cs) for repo, cs in batches]).withColumn(
            "org_or_user", F.lit("o")), at)

    repos()
    deliver(ts(2024, 1, 1), ("o/a", [commit("c1")]), ("o/b", [commit("c2", msg="old"), commit("c3")]))
    load_fact_delta(wh, ts(2024, 1, 1))
    assert sorted(r.sha for r in wh.read("fact_commits").collect()) == ["c1"]
    deliver(ts(2024, 1, 2), ("o/b", [commit("c2", msg="new")]))  # staged; the load dies before it begins
    names.append((2, "o/b"))
    repos()
    deliver(ts(2024, 1, 3), ("o/a", []))
    load_fact_delta(wh, ts(2024, 1, 3))
    assert {r.sha: r.commit_message for r in wh.read("fact_commits").collect()} == {"c1": "m", "c2": "new", "c3": "m"}
    assert wh.read("stg_commits_pending").count() == 0 and summary(wh) == from_fact(wh)


def test_counts_are_carried(spark, wh, monkeypatch):
    raw(spark, wh, ts(2024, 1, 1), "ab")
    load(wh, [("a", 1, ts(2024, 1, 1)), ("b", 1, ts(2024, 1, 1))])
    first = layer_rows(wh)
    assert first["raw_commits_batches"] == 2 and first["fact_commits_rows"] == 2 and first["stg_repos_rows"] == 0
    later = Warehouse(spark, wh.root)
    recall_rows(later)
    raw(spark, later, ts(2024, 1, 2), "abc")
    load(later, [("a", 2, ts(2024, 1, 1)), ("c", 1, ts(2024, 1, 1))])
    read = later.read
    monkeypatch.setattr(later, "read", lambda name, *a: pytest.fail(name) if name == "fact_commits" else read(name, *a))
    second = layer_rows(later)
    assert second["raw_commits_batches"] == 5 and second["fact_commits_rows"] == 3
    monkeypatch.undo()
    raw(spark, later, ts(2024, 1, 2), "d")  # a landing at the time already counted
    other = Warehouse(spark, wh.root)  # counts nothing of its own: the state is newer than the carried count
    recall_rows(other)
    load(later, [("d", 1, ts(2024, 1, 1))])
    third = layer_rows(other)
    assert third["raw_commits_batches"] == 6 and third["fact_commits_rows"] == 4


def test_activity_from_months(spark, wh):
    load(wh, [("a", 1, ts(2024, 1, 9)), ("b", 2, ts(2024, 1, 5))])
    advance_by_month(wh)
    load(wh, [("a", 2, ts(2024, 2, 9))])
    advance_by_month(wh)
    names = spark.createDataFrame([(1, "o/a"), (2, "o/b")], "repo_id long, full_name string")
    read = wh.read
    wh.read = lambda name, *a: names if name == "dim_repository" else read(name, *a)
    assert sorted((r.full_name, r.month_start.month, r.n_commits) for r in monthly_activity(wh).collect()) == [
        ("o/b", 1, 1), ("o/b", 2, 1)]

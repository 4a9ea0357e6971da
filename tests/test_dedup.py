"""Latest per key (W1), latest batch (O1), top-k (O2), with plan checks."""

from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.operators.dedup import latest_batch, latest_per_key, top_k
from sparkmart.operators.loads import stage_all_batches, stage_latest_batch
from sparkmart.plans.tables import empty
from tests.helpers import commit, plan_text, raw_commits, raw_repos, repo, ts


def test_later_batch_wins_and_ties_are_ordered(spark):
    raw = raw_commits(spark, [
        (ts(2024, 1, 1), "o/a", [commit("c1", msg="old")]),
        (ts(2024, 1, 2), "o/a", [commit("c1", msg="new"), commit("c2", msg="first"),
                                 commit("c2", msg="second")]),
    ])
    stg = stage_all_batches(empty(spark, S.STG_COMMITS), raw, ts(2024, 1, 3))
    got = {r.sha: r.commit_message for r in stg.collect()}
    assert got == {"c1": "new", "c2": "second"}  # last element wins inside one batch


def test_batch_order_does_not_matter(spark):
    b = [(ts(2024, 1, 1), "o/a", [commit("c1", msg="old")]),
         (ts(2024, 1, 2), "o/a", [commit("c1", msg="new")])]
    a = stage_all_batches(empty(spark, S.STG_COMMITS), raw_commits(spark, b), ts(2024, 1, 3))
    c = stage_all_batches(empty(spark, S.STG_COMMITS), raw_commits(spark, b[::-1]),
                          ts(2024, 1, 3))
    assert sorted(a.collect()) == sorted(c.collect())


def test_latest_batch_of_scope_only(spark):
    raw = raw_repos(spark, [
        (ts(2024, 1, 1), "apache", [repo(1, "apache/a")]),
        (ts(2024, 1, 2), "apache", [repo(2, "apache/b")]),
        (ts(2024, 1, 3), "other", [repo(3, "other/c")]),
    ])
    stg = stage_latest_batch(empty(spark, S.STG_REPOS), raw, ts(2024, 1, 4), scope="apache")
    assert [r.repo_id for r in stg.collect()] == [2]


def test_repo_gone_from_newest_batch_stays(spark):
    raw1 = raw_repos(spark, [(ts(2024, 1, 1), "apache", [repo(1, "apache/a"), repo(2, "apache/b")])])
    stg = stage_latest_batch(empty(spark, S.STG_REPOS), raw1, ts(2024, 1, 1))
    raw2 = raw1.unionByName(raw_repos(spark, [(ts(2024, 1, 2), "apache", [repo(2, "apache/b")])]))
    stg2 = stage_latest_batch(stg, raw2, ts(2024, 1, 2))
    assert sorted(r.repo_id for r in stg2.collect()) == [1, 2]


def test_duplicate_repo_in_batch_raises_or_keeps_latest(spark):
    raw = raw_repos(spark, [(ts(2024, 1, 1), "apache",
                             [repo(1, "apache/a", language="C"), repo(1, "apache/a", language="Go")])])
    import pytest
    with pytest.raises(Exception, match="more than once"):
        stage_latest_batch(empty(spark, S.STG_REPOS), raw, ts(2024, 1, 1)).collect()
    stg = stage_latest_batch(empty(spark, S.STG_REPOS), raw, ts(2024, 1, 1), on_duplicate="latest")
    assert [r.language for r in stg.collect()] == ["Go"]


def test_window_group_limit_in_plan(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    out = latest_per_key(df, ["k"], [F.col("id").desc()])
    assert "WindowGroupLimit" in plan_text(out) or "WindowGroupLimit" in _explain(out)
    assert sorted(r.id for r in out.collect()) == [93, 94, 95, 96, 97, 98, 99]


def test_latest_batch_filters_by_bits_and_never_sorts_payloads_by_scope(spark):
    df = spark.range(20).select((F.col("id") % 3).alias("s"), F.col("id").cast("timestamp")
                                .alias("ingested_at"))
    out = latest_batch(df, ["s"])
    plan = _explain(out)
    assert "BroadcastHashJoin" in plan and "bitmap_construct_agg" in plan and "Window" not in plan
    assert out.count() == 3


def test_topk_nulls_last_and_plan(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 7), (4, 5)], "k long, v long")
    out = top_k(df, [F.col("v").desc_nulls_last(), F.col("k")], 3)
    assert [r.k for r in out.collect()] == [3, 2, 4]
    assert "TakeOrderedAndProject" in _explain(out)
    out2 = top_k(df, [F.col("v").desc_nulls_last(), F.col("k")], 4)
    assert [r.k for r in out2.collect()][-1] == 1


def _explain(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))

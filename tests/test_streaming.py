"""Available-now streaming over new raw files equals the batch result."""

import uuid

from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.operators.loads import load_dimension_scd1, stage_all_batches, stage_latest_batch
from sparkmart.plans.tables import empty
from sparkmart.session import checkpoint_root
from sparkmart.sources.warehouse import Warehouse
from sparkmart.streaming.incremental import stream_commits, stream_marks
from tests.helpers import commit, raw_commits, raw_repos, repo, ts

STAMPS = ("last_seen_at", "load_dts", "updated_at", "commit_key")


def _rows(df, *drop):
    return sorted(tuple(r) for r in df.drop(*drop).collect())


def _repos(spark, wh, repos, at):
    raw = raw_repos(spark, [(at, "apache", repos)])
    wh.replace("stg_repos", stage_latest_batch(wh.read("stg_repos"), raw, at))
    wh.replace("dim_repository", load_dimension_scd1(wh.read("dim_repository"), wh.read("stg_repos"), at))


def test_stream_equals_batch_and_guards_late_files(spark):
    root = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
    wh = Warehouse(spark, f"{root}/wh")
    wh.ensure_tables()
    _repos(spark, wh, [repo(1, "apache/a")], ts(2024, 1, 1))
    ck = f"{root}/ck"
    clock = lambda: ts(2024, 2, 1)
    b1 = raw_commits(spark, [(ts(2024, 1, 2), "apache/a", [commit("c1", msg="v1"), commit("c2")])])
    b2 = raw_commits(spark, [(ts(2024, 1, 3), "apache/a", [commit("c1", msg="v2")]),
                             (ts(2024, 1, 3), "apache/b", [commit("c3", date="2024-01-05T00:00:00Z")])])
    late = raw_commits(spark, [(ts(2024, 1, 1), "apache/a", [commit("c1", msg="v0")])])
    for b in (b1, b2):
        wh.append("raw_commits", b.withColumn("org_or_user", F.lit("apache")))
        assert stream_commits(spark, wh, ck, clock=clock) == 1
    assert {r.sha: r.commit_message for r in wh.read("fact_commits").collect()} == {"c1": "v2", "c2": "m"}
    wh.append("raw_commits", late.withColumn("org_or_user", F.lit("apache")))
    stream_commits(spark, wh, ck, clock=clock)
    # batch over all files gives the same staging table
    batch = stage_all_batches(empty(spark, S.STG_COMMITS), wh.read("raw_commits").drop("ingest_date"),
                              ts(2024, 2, 1))
    assert _rows(wh.read("stg_commits"), *STAMPS) == _rows(batch, *STAMPS)
    assert {r.sha: r.commit_message for r in wh.read("stg_commits").collect()}["c1"] == "v2"
    # the repository of c3 arrives: the next micro-batch picks the pending commit up
    _repos(spark, wh, [repo(1, "apache/a"), repo(2, "apache/b")], ts(2024, 1, 6))
    wh.append("raw_commits", raw_commits(spark, [(ts(2024, 1, 7), "apache/b", [])])
              .withColumn("org_or_user", F.lit("apache")))
    stream_commits(spark, wh, ck, clock=clock)
    assert sorted(r.sha for r in wh.read("fact_commits").collect()) == ["c1", "c2", "c3"]
    marks = {r.entity_name: r.watermark_ts.day for r in wh.read("etl_watermark").collect()}
    assert marks == {"apache/a": 2, "apache/b": 5}
    # Running max per entity from the landed files; a restart keeps state
    stream_marks(spark, f"{wh.root}/raw_commits/data", wh, f"{root}/ck2", clock=clock)
    got = {r.entity_name: r.watermark_ts.day for r in wh.read("stream_marks").collect()}
    assert got == {"apache/a": 2, "apache/b": 5}
    older = raw_commits(spark, [(ts(2024, 1, 8), "apache/b", [commit("c4", date="2024-01-01T00:00:00Z")])])
    wh.append("raw_commits", older.withColumn("org_or_user", F.lit("apache")))
    stream_marks(spark, f"{wh.root}/raw_commits/data", wh, f"{root}/ck2", clock=clock)
    got = {r.entity_name: r.watermark_ts.day for r in wh.read("stream_marks").collect()}
    assert got == {"apache/a": 2, "apache/b": 5}


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

BATCHES = [
    (ts(2024, 1, 1), "apache/a", [commit("c1", msg="1a"), commit("c2", msg="2a")]),
    (ts(2024, 1, 2), "apache/a", [commit("c1", msg="1b")]),
    (ts(2024, 1, 2), "apache/b", [commit("c3", msg="3b"), commit("c1", msg="1c")]),
    (ts(2024, 1, 3), "apache/b", [commit("c2", msg="2d"), commit("c2", msg="2e")]),
    (ts(2024, 1, 4), "apache/a", []),
]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(order=st.permutations(range(len(BATCHES))), cuts=st.sets(st.integers(1, len(BATCHES) - 1)))
def test_any_split_and_arrival_order_gives_the_batch_result(spark, order, cuts):
    """T1's guarded staging over micro-batches = one batch over every file."""
    want = stage_all_batches(empty(spark, S.STG_COMMITS), raw_commits(spark, BATCHES), ts(2024, 2, 1))
    arrived = [BATCHES[i] for i in order]
    bounds = [0, *sorted(cuts), len(arrived)]
    stg = empty(spark, S.STG_COMMITS)
    for lo, hi in zip(bounds, bounds[1:]):
        stg = stage_all_batches(stg, raw_commits(spark, arrived[lo:hi]), ts(2024, 2, 1), guard=True)
        stg = spark.createDataFrame(stg.collect(), S.STG_COMMITS.schema)  # tiny fixture state
    assert _rows(stg, *STAMPS) == _rows(want, *STAMPS)

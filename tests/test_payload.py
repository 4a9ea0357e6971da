"""Strict flattening of JSON-array payloads."""

import pytest
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.sources.payload import flatten
from sparkmart.sources.raw import batch_stats, pack_batches
from tests.helpers import commit, raw_commits, raw_repos, repo, ts


def _commits(spark, payload):
    raw = raw_commits(spark, [(ts(2024, 1, 3), "o/a", payload)])
    return flatten(raw, S.COMMIT_FIELDS, keep=["repo_full_name"], key_path=S.COMMIT_KEY_PATH)


def _repos(spark, payload):
    raw = raw_repos(spark, [(ts(2024, 1, 3), "o", payload)])
    return flatten(raw, S.REPO_FIELDS, key_path=S.REPO_KEY_PATH)


def test_null_author_kept_and_missing_sha_dropped(spark):
    c1 = commit("c1", login=None)
    c2 = commit(None)
    c3 = {k: v for k, v in commit("x").items() if k != "sha"}
    rows = _commits(spark, [c1, c2, c3]).collect()
    assert [r.sha for r in rows] == ["c1"]
    assert rows[0].author_login is None
    assert rows[0].author_name == "n"


def test_offset_dates_normalised_to_utc(spark):
    rows = _commits(spark, [commit("c1", date="2024-01-02T03:04:05+02:00")]).collect()
    assert rows[0].committed_at.replace(tzinfo=None).isoformat() == "2024-01-02T01:04:05"


def test_junk_date_raises(spark):
    with pytest.raises(Exception):
        _commits(spark, [commit("c1", date="junk")]).collect()


def test_empty_payload_gives_no_rows(spark):
    assert _commits(spark, []).count() == 0


@pytest.mark.parametrize("payload", ['{"sha": "c1"}', '"text"', "7", "null"])
def test_non_array_payload_raises(spark, payload):
    with pytest.raises(Exception):
        _commits(spark, payload).collect()


def test_repo_text_id_and_bool_default(spark):
    r = repo("7", private=None)
    rows = _repos(spark, [r, repo(None, "o/b")]).collect()
    assert len(rows) == 1 and rows[0].repo_id == 7 and rows[0].is_private is False
    assert rows[0].owner_login == "o"


@pytest.mark.parametrize("bad", [3.5, "x", 3000000000])
def test_bad_int_raises(spark, bad):
    with pytest.raises(Exception):
        _repos(spark, [repo(1, forks_count=bad)]).collect()


def test_pack_and_flatten_round_trip_with_chunks(spark):
    recs = spark.range(2500).select(
        (F.col("id") % 2).alias("scope"), F.col("id"),
        F.struct(F.col("id").alias("sha")).alias("rec"))
    raw = pack_batches(recs, ["scope"], F.col("rec"), ["id"], ts(2024, 2, 1), chunk_size=500)
    stats = {r.scope: (r.batches, r.records) for r in batch_stats(raw, ["scope"]).collect()}
    assert sum(v[1] for v in stats.values()) == 2500
    assert all(v[0] == 1 for v in stats.values())  # one batch per scope ...
    chunks = {r.scope: r["count"] for r in raw.groupBy("scope").count().collect()}
    assert all(n >= 2 for n in chunks.values())  # ... split into chunks that share its batch_id
    back = flatten(raw, [("sha", "$.sha", "bigint")], key_path="$.sha")
    assert sorted(r.sha for r in back.collect()) == list(range(2500))


def _winners(raw):
    from sparkmart.operators.dedup import latest_per_key
    rows = flatten(raw, [("k", "$.k", "bigint"), ("v", "$.v", "bigint")], keep=["chunk"],
                   key_path="$.k", with_position=True)
    return {r.k: r.v for r in latest_per_key(rows, ["k"], [F.col("chunk").desc(),
                                                           F.col("_pos").desc()]).collect()}


def test_chunk_size_does_not_change_the_winner(spark):
    recs = spark.range(4000).select(F.lit("s").alias("scope"), F.col("id").alias("o"),
                                    F.struct((F.col("id") % 1500).alias("k"), F.col("id").alias("v"))
                                    .alias("rec"))
    want = {k: max(v for v in range(k, 4000, 1500)) for k in range(1500)}
    for size in (5, 300, 100_000):
        raw = pack_batches(recs, ["scope"], F.col("rec"), ["o"], ts(2024, 2, 1), key=["rec.k"],
                           chunk_size=size)
        assert _winners(raw) == want


def test_equal_order_keys_are_still_cut(spark):
    recs = spark.range(5000).select(F.lit("s").alias("scope"), F.lit(1).alias("o"),
                                    F.struct("id").alias("rec"))
    raw = pack_batches(recs, ["scope"], F.col("rec"), ["o"], ts(2024, 2, 1), chunk_size=500)
    assert raw.count() >= 8


def test_null_scope_raises(spark):
    recs = spark.createDataFrame([("a", 1), (None, 2)], "scope string, v long")
    with pytest.raises(Exception, match="NULL in scope column"):
        pack_batches(recs, ["scope"], F.struct("v"), ["v"], ts(2024, 2, 1)).collect()


def test_batch_ids_of_different_scopes_differ(spark):
    recs = spark.createDataFrame([("a/b", "c", 1), ("a", "b/c", 2)], "x string, y string, v long")
    raw = pack_batches(recs, ["x", "y"], F.struct("v"), ["v"], ts(2024, 2, 1))
    assert raw.select("batch_id").distinct().count() == 2


def test_hot_scope_is_not_one_task(spark):
    """With broadcasts off, records are shuffled by scope and salt, never by scope alone."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        recs = spark.range(100).select((F.col("id") % 3).alias("scope"), "id")
        raw = pack_batches(recs, ["scope"], F.struct("id"), ["id"], ts(2024, 2, 1), chunk_size=10)
        plan = raw._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    import re
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    # by scope alone only the partial counts travel
    assert any("_salt" in k for k in keys) and sum("_" not in k for k in keys) <= 1


def test_entity_batches_include_empty(spark):
    recs = spark.createDataFrame([("a", 1)], "e string, v long").select(
        "e", "v", F.struct("v").alias("rec"))
    ents = spark.createDataFrame([("a",), ("b",)], "e string")
    raw = pack_batches(recs, ["e"], F.col("rec"), ["v"], ts(2024, 2, 1), scopes=ents)
    got = {r.e: r.n for r in raw.select("e", F.size(F.col("payload").cast("array<variant>"))
                                            .alias("n")).collect()}
    assert got == {"a": 1, "b": 0}

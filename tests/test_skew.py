"""A third of all rows on one key: results stay whole and no payload row grows with the hot group."""

from pyspark.sql import functions as F

from sparkmart.operators.dedup import latest_per_key
from sparkmart.operators.quality import dq_foreign_key
from sparkmart.sources.paging import pages_of
from sparkmart.sources.payload import flatten
from sparkmart.sources.raw import pack_batches
from tests.helpers import ts

N = 30000


def _skewed(spark):
    # key 0 holds a third of the rows, the rest spread over 1000 keys
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        F.col("id"))


def test_hot_scope_is_chunked_and_round_trips(spark):
    df = _skewed(spark)
    raw = pack_batches(df, ["k"], F.struct("id"), ["id"], ts(2024, 2, 1), chunk_size=1000)
    sizes = raw.select("k", F.size(F.col("payload").cast("array<variant>")).alias("n"))
    hot = sizes.where("k = 0").collect()
    assert len(hot) >= 8  # 10,000 records -> ~10 chunks, not one row
    assert max(r.n for r in hot) < 2000
    assert sum(r.n for r in hot) == N // 3
    back = flatten(raw, [("id", "$.id", "bigint")], keep=["k"])
    assert back.count() == N and back.select("id").distinct().count() == N


def test_hot_key_dedup_and_pages_are_exact(spark):
    df = _skewed(spark)
    latest = {r.k: r.id for r in latest_per_key(df, ["k"], [F.col("id").desc()]).collect()}
    assert latest[0] == 29997 and len(latest) == 1001
    pages = pages_of(df.where("k = 0"), "k", [F.col("id").desc()], [F.max("id").alias("top")],
                     per_page=100, max_pages=10).collect()
    assert sorted(r.page for r in pages) == list(range(1, 11)) and all(r.n == 100 for r in pages)


def test_hot_key_foreign_key_check(spark):
    fact = _skewed(spark)
    dim = spark.range(1, 1001).select(F.col("id").alias("k"))
    r = dq_foreign_key(fact, dim, "k", "k").first()
    assert r.ok == 0 and r.violations == N // 3


def test_large_cap_keeps_partial_limit(spark):
    from sparkmart.operators.incremental import cap_oldest

    df = _skewed(spark)
    out = cap_oldest(df, entity_col="k", ts_col="id", cap=5000)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("k = 0").count() == 5000


def _without_broadcasts(spark, adaptive="true"):
    """Conf values to restore later; joins shuffle unless a broadcast is asked for."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.enabled") if spark.conf.get(k, None)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    return was


def _restore(spark, was):
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
        spark.conf.set(k, was[k]) if k in was else spark.conf.unset(k)


def test_hot_entity_of_the_incremental_read_is_split(spark):
    from sparkmart.operators.incremental import filter_incremental

    day = F.timestamp_seconds(F.col("id") * 60)
    records = _skewed(spark).select(F.concat(F.lit("e"), "k").alias("e"), "id", day.alias("t"))
    records = records.union(spark.sql("select cast(null as string), 7L, timestamp_seconds(60)"))
    since = records.select("e").distinct().where("e is not null and e != 'e1'").select(
        "e", F.when(F.col("e") == "e0", F.timestamp_seconds(F.lit(60 * 600))).otherwise(
            F.timestamp_seconds(F.lit(0))).alias("since"))
    was = _without_broadcasts(spark, "false")
    try:
        out = filter_incremental(records, since, entity_col="e", ts_col="t")
        assert out.columns == ["e", "id", "t"]
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2], sizes
        got = {r.id for r in out.collect()}
    finally:
        _restore(spark, was)
    want = {i for i in range(N) if (i % 3 == 0 and i >= 600) or (i % 3 and i % 1000 + 1 != 1)}
    assert got == want and sum(sizes) == len(want)


def test_newest_batch_drops_payloads_in_the_scan_and_splits_a_hot_batch(spark):
    from sparkmart.operators.dedup import latest_batch

    # scope 0 holds a third of the rows, in one newest batch of 5,000 chunks
    raw = _skewed(spark).select("k", F.when(F.col("k") == 0, F.col("id") >= N // 2).otherwise(
        F.col("id") > N - 1500).cast("int").alias("ts"), "id", F.repeat(F.lit("p"), 50).alias("payload"))
    was = _without_broadcasts(spark, "false")
    try:
        out = latest_batch(raw, ["k"], "ts")
        text = out._jdf.queryExecution().executedPlan().toString()
        join = text.index("SortMergeJoin")
        assert join < text.index("Exchange hashpartitioning", join) < text.index("BroadcastHashJoin")
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        got = {r.id for r in out.collect()}
    finally:
        _restore(spark, was)
    rows = [(r.k, r.ts, r.id) for r in raw.select("k", "ts", "id").collect()]
    newest = {}
    for k, t, _ in rows:
        newest[k] = max(t, newest.get(k, t))
    assert got == {i for k, t, i in rows if newest[k] == t} and sum(sizes) == len(got)
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2], sizes


def test_newest_batch_with_colliding_bits_nulls_and_no_rows(spark, monkeypatch):
    from sparkmart.operators import dedup

    rows = [(i % 300, i // 300, i) for i in range(1200)] + [(None, 9, -1), (5, None, -2)]
    df = spark.createDataFrame(rows, "k long, ts long, id long")
    want = [i for k, t, i in rows if k is not None and t == 3]
    for bits in (1, 64, 1 << 27):
        monkeypatch.setattr(dedup, "FILTER_BITS", bits)
        assert sorted(r.id for r in dedup.latest_batch(df, ["k"], "ts").collect()) == want
    assert dedup.latest_batch(df.where("id > 5000"), ["k"], "ts").count() == 0

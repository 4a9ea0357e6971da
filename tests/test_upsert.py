"""Keyed upsert (L1-L3, L9), surrogate keys (L6), loads (L4, L5, L7), constraints."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.operators.constraints import ConstraintError, check_unique, enforce_not_null
from sparkmart.operators.keys import assign_keys
from sparkmart.operators.loads import (load_dimension_scd1, load_fact, load_fact_left_lookup,
                                       stage_all_batches, stage_latest_batch)
from sparkmart.operators.upsert import update_by_key, upsert
from sparkmart.plans.tables import empty
from tests.helpers import commit, raw_commits, raw_repos, repo, ts

SCHEMA = "k long, a string, b string, sk long"


def _t(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("strategy", ["broadcast", "auto"])
def test_semantics(spark, strategy):
    target = _t(spark, [(1, "a1", "b1", 10), (2, "a2", "b2", 11), (3, "a3", "b3", 12)])
    source = spark.createDataFrame([(2, None, "x"), (4, "a4", "y")], "k long, a string, c string")
    out = upsert(target, source, ["k"], ["a"], on_insert={"b": F.lit("dflt")},
                 surrogate_key="sk", strategy=strategy)
    got = {r.k: (r.a, r.b, r.sk) for r in out.collect()}
    assert got == {1: ("a1", "b1", 10), 2: (None, "b2", 11), 3: ("a3", "b3", 12),
                   4: ("a4", "dflt", 13)}
    assert out.columns == ["k", "a", "b", "sk"]


def test_duplicate_source_key_raises(spark):
    target = _t(spark, [(1, "a", "b", 1)])
    source = spark.createDataFrame([(5, "x"), (5, "y")], "k long, a string")
    for strategy in ("auto", "broadcast"):
        with pytest.raises(Exception, match="more than once"):
            upsert(target, source, ["k"], ["a"], strategy=strategy).collect()
    out = upsert(target, source, ["k"], ["a"], on_duplicate="latest", dedup_order=[F.col("a").desc()])
    assert {r.k: r.a for r in out.collect()} == {1: "a", 5: "y"}


@pytest.mark.parametrize("broadcasts", [True, False])
@pytest.mark.parametrize("strategy", ["broadcast", "auto"])
@pytest.mark.parametrize("surrogate", [None, "sk"])
@pytest.mark.parametrize("key, filled", [(5, False), (5, True), (1, True)])
def test_no_plan_drops_the_duplicate_check(spark, key, filled, surrogate, strategy, broadcasts):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old if broadcasts else "-1")
    try:
        target = _t(spark, [(1, "a", "b", 1)] if filled else [])
        source = spark.createDataFrame([(key, "x"), (key, "y"), (9, "z")], "k long, a string")
        for cols in (["a"], []):
            for changes in (False, True):
                with pytest.raises(Exception, match="more than once"):
                    upsert(target, source, ["k"], cols, strategy=strategy, surrogate_key=surrogate,
                           changes_only=changes).collect()
        with pytest.raises(Exception, match="more than once"):
            upsert(target, source, ["k"], [], surrogate_key=surrogate).write.format("noop").mode(
                "overwrite").save()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("strategy", ["broadcast", "auto"])
def test_changes_with_what_was_before(spark, strategy):
    target = _t(spark, [(1, "a", "b", 1), (2, "same", "b", 2), (3, "c", "b", 3)])
    source = spark.createDataFrame([(1, "x"), (2, "same"), (7, "n")], "k long, a string")
    out = upsert(target, source, ["k"], ["a"], changes_only=True, skip_equal=True, before=("k", "a"),
                 surrogate_key="sk", strategy=strategy)
    assert sorted(tuple(r) for r in out.collect()) == [
        (1, "x", "b", 1, "U", 1, "a"), (7, "n", None, 4, "I", 7, None)]
    with pytest.raises(ValueError):
        upsert(target, source, ["k"], ["a"], before=("a",))


def test_keys_follow_the_data_and_not_the_partitions(spark):
    df = spark.range(20_000).select((F.col("id") * 13 % 20_011).alias("nat"), F.lit("x" * 50).alias("load"))
    for parts in ("3", "17"):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = assign_keys(df, "key", ["nat"], df.select(F.lit(7).alias("key")))
            rank = sorted(r.nat for r in df.collect())
            assert sorted((r.nat, r.key) for r in got.collect()) == [(v, 8 + i) for i, v in enumerate(rank)]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
    assert assign_keys(df.limit(0), "key", ["nat"]).collect() == []


def test_update_by_key_does_not_insert(spark):
    target = _t(spark, [(1, "a", "b", 1)])
    source = spark.createDataFrame([(1, "z"), (9, "q")], "k long, a string")
    out = update_by_key(target, source, ["k"], ["a"])
    assert [(r.k, r.a) for r in out.collect()] == [(1, "z")]


def test_guard_keeps_newer_target(spark):
    target = spark.createDataFrame([(1, "new", ts(2024, 1, 5))], "k long, v string, t timestamp")
    source = spark.createDataFrame([(1, "old", ts(2024, 1, 1))], "k long, v string, t timestamp")
    out = upsert(target, source, ["k"], ["v", "t"], guard_col="t")
    assert [r.v for r in out.collect()] == ["new"]


rows_strategy = st.dictionaries(st.integers(0, 30), st.text("abc", max_size=2), max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tgt=rows_strategy, src=rows_strategy)
def test_upsert_is_dict_update_and_idempotent(spark, tgt, src):
    target = spark.createDataFrame(list(tgt.items()), "k long, v string")
    source = spark.createDataFrame(list(src.items()), "k long, v string")
    once = upsert(target, source, ["k"], ["v"])
    expect = dict(tgt)
    expect.update(src)
    assert {r.k: r.v for r in once.collect()} == expect
    twice = upsert(once, source, ["k"], ["v"])
    assert sorted(twice.collect()) == sorted(once.collect())


def test_assign_keys_dense_and_repeatable(spark):
    df = spark.range(5000).select((F.col("id") * 7).alias("nat"))
    a = assign_keys(df, "key", ["nat"], 100)
    keys = sorted(r.key for r in a.collect())
    assert keys == list(range(101, 5101))
    b = assign_keys(df.repartition(3), "key", ["nat"], 100)
    assert sorted(a.collect()) == sorted(b.collect())


def test_enforce_not_null_and_unique(spark):
    df = spark.createDataFrame([(1, None)], "k long, v string")
    with pytest.raises(Exception):
        enforce_not_null(df, ["v"]).collect()
    dup = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    with pytest.raises(ConstraintError):
        check_unique(dup, ["k"])
    assert check_unique(dup, ["k"], raise_error=False) == [(1,)]


def _stg(spark):
    raw_r = raw_repos(spark, [(ts(2024, 1, 1), "apache", [repo(1, "apache/a"), repo(2, "apache/b")])])
    stg_r = stage_latest_batch(empty(spark, S.STG_REPOS), raw_r, ts(2024, 1, 1))
    raw_c = raw_commits(spark, [(ts(2024, 1, 1), "apache/a", [commit("c1"), commit("c2")]),
                                (ts(2024, 1, 1), "apache/zz", [commit("c9")])])
    stg_c = stage_all_batches(empty(spark, S.STG_COMMITS), raw_c, ts(2024, 1, 1))
    return stg_r, stg_c


def test_dimension_scd1_keeps_keys_and_effective_from(spark):
    stg_r, _ = _stg(spark)
    dim = load_dimension_scd1(empty(spark, S.DIM_REPOSITORY), stg_r, ts(2024, 1, 1))
    first = {r.repo_id: (r.repo_key, r.effective_from) for r in dim.collect()}
    raw2 = raw_repos(spark, [(ts(2024, 1, 2), "apache", [repo(2, "apache/b", language="Rust"),
                                                          repo(3, "apache/c")])])
    stg2 = stage_latest_batch(stg_r, raw2, ts(2024, 1, 2))
    dim2 = load_dimension_scd1(dim, stg2, ts(2024, 1, 2))
    got = {r.repo_id: r for r in dim2.collect()}
    assert got[2].language == "Rust" and got[2].repo_key == first[2][0]
    assert got[2].effective_from == first[2][1]
    assert got[3].repo_key == 3 and got[3].is_current is True


def test_fact_load_skips_unknown_repo_and_fans_out_raise(spark):
    stg_r, stg_c = _stg(spark)
    fact = load_fact(empty(spark, S.FACT_COMMITS), stg_c, stg_r, ts(2024, 1, 1))
    assert sorted(r.sha for r in fact.collect()) == ["c1", "c2"]  # c9's repo is unknown
    twin = stg_r.unionByName(stg_r.withColumn("repo_id", F.col("repo_id") + 100))
    with pytest.raises(Exception, match="more than once"):
        load_fact(empty(spark, S.FACT_COMMITS), stg_c, twin, ts(2024, 1, 1)).collect()


def test_left_lookup_loader_raises_on_missing_id(spark):
    stg_r, stg_c = _stg(spark)
    dim = load_dimension_scd1(empty(spark, S.DIM_REPOSITORY), stg_r, ts(2024, 1, 1))
    with pytest.raises(Exception):  # c9 has no repo: repo_id NULL breaks NOT NULL
        load_fact_left_lookup(empty(spark, S.FACT_COMMITS), stg_c, stg_r, dim,
                              ts(2024, 1, 1)).collect()
    ok = load_fact_left_lookup(empty(spark, S.FACT_COMMITS),
                               stg_c.where(F.col("sha") != "c9"), stg_r, dim, ts(2024, 1, 1))
    assert sorted(r.sha for r in ok.collect()) == ["c1", "c2"]


@pytest.mark.parametrize("strategy", ["broadcast", "auto"])
def test_changes_only(spark, strategy):
    target = spark.createDataFrame([(1, "a", ts(2024, 1, 5)), (2, "b", ts(2024, 1, 1)),
                                    (3, "c", ts(2024, 1, 1))], "k long, v string, t timestamp")
    source = spark.createDataFrame([(1, "old", ts(2024, 1, 2)), (2, "new", ts(2024, 1, 2)),
                                    (4, "ins", ts(2024, 1, 2))], "k long, v string, t timestamp")
    out = upsert(target, source, ["k"], ["v", "t"], guard_col="t", changes_only=True,
                 strategy=strategy)
    assert {r.k: r.v for r in out.collect()} == {2: "new", 4: "ins"}
    full = upsert(target, source, ["k"], ["v", "t"], guard_col="t", strategy=strategy)
    merged = {r.k: r.v for r in target.collect()}
    merged.update({r.k: r.v for r in out.collect()})
    assert {r.k: r.v for r in full.collect()} == merged


def test_upsert_is_one_outer_join(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(1000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
        out = upsert(big, big.where("k % 3 = 0"), ["k"], ["v"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before  # lazy
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("FullOuter") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert "SinglePartition" not in plan and "LocalLimit" not in plan

"""Registered queries: one per operator family of the survey, each over the driver's whole tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose columns match the DuckDB
oracle of the same name in ``__spark_entry__.oracle_sql``.  Timestamps are handed out as
``timestamp_ntz`` (the oracle's zone-less type).  Scenario inputs (an earlier load, a later batch) are
derived from the tables by data attributes such as dates, segments or balances, never by id subsets.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.frames import to_ntz
from ..functions.json import iso_utc, json_field, lenient_timestamp, parse_payload
from ..operators.dedup import latest_batch, latest_per_key, top_k
from ..operators.incremental import filter_incremental, resolve_since
from ..operators.keys import assign_keys
from ..operators.loads import load_fact_left_lookup
from ..operators.quality import (dq_foreign_key, dq_not_null, dq_recent_raw_has_effect,
                                 dq_watermark_not_ahead)
from ..operators.runlog import layer_counts, run_outcome
from ..operators.upsert import upsert
from ..sources.paging import pages_of
from ..sources.payload import flatten
from ..sources.raw import pack_batches
from .staging import METRICS
from .star import Star, build_star
from .tables import RUN1, RUN2, empty, table


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The in-memory warehouse of ``sf_dir`` as the tables are now (layers are checkpointed)."""
    return build_star(spark, sf_dir)


# -- raw layer and JSON ------------------------------------------------------------------------

LINEITEM_FIELDS = (
    ("l_orderkey", "$.l_orderkey", "bigint"),
    ("l_linenumber", "$.l_linenumber", "int"),
    ("l_quantity", "$.l_quantity", "double"),
    ("l_shipdate", "$.l_shipdate", "timestamp"),
)


def q_json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + J6 + P2 + F2: lineitems landed as one JSON-array batch per order, then flattened back."""
    li = table(spark, sf_dir, "lineitem")
    rec = F.struct("l_orderkey", "l_linenumber", "l_quantity",
                   iso_utc("l_shipdate").alias("l_shipdate"))
    raw = pack_batches(li, ["l_orderkey"], rec, ["l_linenumber", "l_partkey", "l_suppkey"], RUN1,
                       key=["l_orderkey", "l_linenumber"])
    rows = flatten(raw, LINEITEM_FIELDS, key_path="$.l_orderkey")
    return to_ntz(rows)


def q_json_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 + X4 + X7: a typed field of a JSON text column (text cast, raising on bad values)."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", json_field(parse_payload("props"), "$.k", "bigint").alias("k"))


def q_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + S6: commit batches per repository (orders per customer) and their record counts."""
    from ..sources.landing import land_commits
    from ..sources.raw import batch_stats

    raw = land_commits(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), RUN1)
    return batch_stats(raw, ["repo_full_name"])


# -- dedup, latest batch, top-k, paging --------------------------------------------------------

def q_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per user (ts desc, event_id desc as tie-break)."""
    ev = table(spark, sf_dir, "events")
    out = latest_per_key(ev, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return out.select("event_id", "user_id", "ts", "event_type")


def q_latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: newest batch per scope (events as batches of a user, ingested at ts)."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_id",
                                               F.col("ts").alias("ingested_at"))
    return latest_batch(ev, ["user_id"], "ingested_at").select("user_id", "event_id")


def q_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2 + I4: the customers with the latest orders; those without one sort last, and some of them
    are among the first 1,200."""
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer")
    last = (orders.groupBy(F.col("o_custkey").alias("c_custkey"))
                  .agg(F.max("o_orderdate").alias("last_order")))
    c = cust.select("c_custkey").join(last, "c_custkey", "left")
    return top_k(c, [F.col("last_order").desc_nulls_last(), F.col("c_custkey").asc()], 1200)


def q_paging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each user newest first in pages of 50, page-stop rule, at most 10 pages."""
    ev = table(spark, sf_dir, "events")
    return pages_of(ev, "user_id", [F.col("ts").desc(), F.col("event_id").desc()],
                    [F.sum("event_id").cast("long").alias("event_ids")], per_page=50,
                    max_pages=10).select("user_id", "page", "n", "event_ids")


def q_paging_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each type in pages of 10; every type has more than the ten pages that are fetched."""
    ev = table(spark, sf_dir, "events")
    return pages_of(ev, "event_type", [F.col("ts").desc(), F.col("event_id").desc()],
                    [F.sum("event_id").cast("long").alias("event_ids")], per_page=10,
                    max_pages=10).select("event_type", "page", "n", "event_ids")


def q_empty_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + S6: a batch per user, also for users without a purchase since Jan 25 (an empty one)."""
    from ..sources.raw import batch_stats

    ev = table(spark, sf_dir, "events")
    recs = ev.where((F.col("event_type") == "purchase") & (F.col("ts") >= F.lit(_dt.datetime(2024, 1, 25))))
    raw = pack_batches(recs, ["user_id"], F.struct("event_id", "value"), ["event_id"], RUN1,
                       key=["event_id"], scopes=ev.select("user_id"))
    return batch_stats(raw, ["user_id"])


# -- upsert, keys, loads -----------------------------------------------------------------------

UPSERT_AS_OF = _dt.datetime(2024, 2, 1, tzinfo=_dt.timezone.utc)
UPSERT_FIRST_LOAD = _dt.datetime(2024, 1, 1, tzinfo=_dt.timezone.utc)


def q_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 + L3: target = first load (three market segments); source = a later batch of three segments
    with changed balances, NULL where the balance is negative (a NULL source value overwrites).
    Overlapping segment -> updated, new segments -> inserted with ``effective_from = as_of``, the
    rest of the target kept."""
    cust = table(spark, sf_dir, "customer")
    target = cust.where(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "FURNITURE")).select(
        F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"),
        F.lit(UPSERT_FIRST_LOAD).cast("timestamp").alias("effective_from"))
    source = cust.where(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD", "MACHINERY")).select(
        F.col("c_custkey").alias("k"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") + 1).alias("bal"))
    out = upsert(target, source, ["k"], ["bal"],
                 on_insert={"effective_from": F.lit(UPSERT_AS_OF).cast("timestamp")})
    return to_ntz(out)


def q_upsert_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2, the option: the source holds a customer once per order; the newest order decides."""
    target = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.lit(None).cast("bigint").alias("last_order"),
        F.col("c_acctbal").alias("bal"))
    source = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("last_order"), "o_orderdate")
    return upsert(target, source, ["k"], ["last_order"], on_duplicate="latest",
                  dedup_order=[F.col("o_orderdate").desc(), F.col("last_order").desc()])


def q_surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense unique keys 1..n for every order, summarised (keys themselves are arbitrary)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    keyed = assign_keys(orders, "k", ["o_orderkey"], 0)
    return keyed.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("k").alias("n_distinct"),
                     F.min("k").alias("min_key"), F.max("k").alias("max_key"))


def q_dim_repository(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + O1 + L4: the SCD-1 dimension after two runs, from nested repository JSON."""
    d = star(spark, sf_dir).dim
    return to_ntz(d.select("repo_id", *S.REPO_ATTRIBUTES, "is_current"))


def q_fact_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 + W1 + J1 + L5: the fact after two overlapping raw runs (each order once)."""
    f = star(spark, sf_dir).fact
    return to_ntz(f.select("sha", "repo_id", "committed_at", "author_login", "author_name",
                           "commit_message"))


def commit_measures(lineitem: DataFrame) -> DataFrame:
    """``(sha, additions, deletions, changed_files)`` of every order: its quantity, line items and parts.

    Line items are first summed up per order and part under the numbers; the text of the order's number is
    made once for each of these, and is what the second exchange and the join with staging go by."""
    parts = lineitem.groupBy("l_orderkey", "l_partkey").agg(
        F.sum("l_quantity").alias("_quantity"), F.count(F.lit(1)).alias("_n"))
    return parts.groupBy(F.col("l_orderkey").cast("string").alias("sha")).agg(
        F.sum("_quantity").cast("int").alias("additions"), F.sum("_n").cast("int").alias("deletions"),
        F.count("l_partkey").cast("int").alias("changed_files"))


def q_fact_left_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L7 + J5: the alternative loader (left lookups, ``coalesce`` of ids, measures from the line items)."""
    st = star(spark, sf_dir)
    lines = commit_measures(table(spark, sf_dir, "lineitem"))
    staged = st.stg_commits.drop("additions", "deletions", "changed_files").join(lines, "sha", "left")
    f = load_fact_left_lookup(empty(spark, S.FACT_COMMITS), staged, st.stg_repos, st.dim, RUN1)
    return to_ntz(f.select("sha", "repo_id", "committed_at", "additions", "deletions",
                           "changed_files"))


def q_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + A2 + I3: marks per repository name after the fact load."""
    m = star(spark, sf_dir).marks
    return to_ntz(m.select("entity_name", "watermark_ts"))


def q_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits per repository and month over the star (fact joined to the dimension)."""
    st = star(spark, sf_dir)
    f = st.fact.groupBy("repo_id", F.date_trunc("month", "committed_at").alias("month_start")).agg(
        F.count(F.lit(1)).alias("n"))
    out = (f.join(st.dim.select("repo_id", "full_name"), "repo_id", "inner")
            .groupBy("full_name", "month_start").agg(F.sum("n").cast("long").alias("n_commits")))
    return to_ntz(out)


# -- incremental -------------------------------------------------------------------------------

INCR_AS_OF = _dt.datetime(2024, 1, 31, tzinfo=_dt.timezone.utc)
INCR_EARLIER = _dt.datetime(2024, 1, 15)


def q_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + I2: marks left by an earlier run (signup events before Jan 15); users without a mark read
    from ``as_of - 7 days``; every event at or after its user's mark."""
    ev = table(spark, sf_dir, "events").withColumn("entity_name", F.col("user_id").cast("string"))
    marks = (ev.where((F.col("ts") < F.lit(INCR_EARLIER)) & (F.col("event_type") == "signup"))
               .groupBy("entity_name").agg(F.max("ts").cast("timestamp").alias("watermark_ts"))
               .select(F.lit(S.MARKS_PIPELINE).alias("pipeline_name"), "entity_name",
                       "watermark_ts", F.lit(INCR_AS_OF).cast("timestamp").alias("updated_at")))
    since = resolve_since(ev, marks, INCR_AS_OF)
    out = filter_incremental(ev, since, entity_col="entity_name", ts_col="ts")
    return out.select("event_id", "user_id", "ts")


# -- quality checks ----------------------------------------------------------------------------

def q_dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 on orders whose customer is looked up in a dimension without negative balances: the lookup
    leaves NULL keys."""
    dim = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    orders = table(spark, sf_dir, "orders")
    return dq_not_null(orders.join(dim, F.col("o_custkey") == F.col("c_custkey"), "left"), "c_custkey")


def q_dq_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 + J3: orders against a dimension that has not loaded customers with a negative balance."""
    dim = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    return dq_foreign_key(table(spark, sf_dir, "orders"), dim, "o_custkey", "c_custkey")


def q_dq_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 + J4: marks from all orders, fact holding only finished/open orders (pending ones not yet
    loaded): every repository whose newest order is pending has its mark ahead of the fact."""
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer")
    marks = (orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
                   .groupBy(F.col("c_name").alias("entity_name"))
                   .agg(F.max("o_orderdate").alias("watermark_ts"))
                   .withColumn("pipeline_name", F.lit(S.MARKS_PIPELINE)))
    fact = orders.where(F.col("o_orderstatus").isin("F", "O"))
    return dq_watermark_not_ahead(marks, cust, fact, dim_name_col="c_name", dim_id_col="c_custkey",
                                  fact_id_col="o_custkey", ts_col="o_orderdate")


def q_dq_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 + X3 + X11 + X13: events as one-record raw batches ingested at ``ts``; staging = events that
    are not errors; ``as_of`` = the newest event (a scalar subquery)."""
    ev = table(spark, sf_dir, "events")
    raw = ev.select(F.col("ts").cast("timestamp").alias("ingested_at"),
                    parse_payload(F.concat(F.lit("["), F.col("props"), F.lit("]"))).alias("payload"))
    stg = ev.where(F.col("event_type") != "error").select(
        F.col("ts").cast("timestamp").alias("raw_ingested_at"))
    as_of = ev.agg(F.max("ts")).scalar()
    return dq_recent_raw_has_effect(raw, stg, as_of)


def q_dq_recent_fails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4, failing branch: staging lags a day behind the raw batches."""
    ev = table(spark, sf_dir, "events")
    raw = ev.select(F.col("ts").cast("timestamp").alias("ingested_at"),
                    parse_payload(F.concat(F.lit("["), F.col("props"), F.lit("]"))).alias("payload"))
    as_of = ev.agg(F.max("ts")).scalar()
    stg = ev.select((F.col("ts") - F.expr("INTERVAL 1 DAY")).cast("timestamp").alias("raw_ingested_at"))
    return dq_recent_raw_has_effect(raw, stg, as_of)


# -- run audit ---------------------------------------------------------------------------------

def q_run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 + R3 + A4-A6 + X18: runs = (user, day), tasks = events; error -> failed, view ->
    upstream_failed, click/purchase -> success, signup -> no state."""
    ev = table(spark, sf_dir, "events")
    state = (F.when(F.col("event_type") == "error", "failed")
              .when(F.col("event_type") == "view", "upstream_failed")
              .when(F.col("event_type").isin("click", "purchase"), "success"))
    ts = ev.select(F.col("user_id").cast("string").alias("dag_id"),
                   F.to_date("ts").cast("string").alias("run_id"),
                   F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("task_id"),
                   state.alias("state"))
    return run_outcome(ts)


def q_run_status_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: the run outcome without the run log's own tasks; here tasks are named by event type, and
    signup is excluded."""
    ev = table(spark, sf_dir, "events")
    state = (F.when(F.col("event_type") == "error", "failed")
              .when(F.col("event_type") == "view", "upstream_failed")
              .when(F.col("event_type").isin("click", "purchase"), "success"))
    ts = ev.select(F.col("user_id").cast("string").alias("dag_id"),
                   F.to_date("ts").cast("string").alias("run_id"),
                   F.col("event_type").alias("task_id"), state.alias("state"))
    return run_outcome(ts, exclude=("signup",))


def q_latest_batch_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + O1: newest batch per user among one scope's batches (clicks)."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type",
                                               F.col("ts").alias("ingested_at"))
    return latest_batch(ev, ["user_id"], "ingested_at", F.col("event_type") == "click").select(
        "user_id", "event_id")


def q_lenient_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest readable ISO date per user; dates of error events are unreadable and skipped."""
    ev = table(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "error", F.lit("junk")).otherwise(iso_utc("ts", micros=True))
    out = ev.groupBy("user_id").agg(F.max(lenient_timestamp(text)).alias("m"))
    return to_ntz(out)


def q_layer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the layers' source tables as ``(tbl, n)`` rows."""
    return layer_counts({n: table(spark, sf_dir, n)
                         for n in ("customer", "orders", "lineitem", "events")})


QUERIES = {
    "json_flatten": q_json_flatten,
    "json_get": q_json_get,
    "batch_stats": q_batch_stats,
    "dedup_latest": q_dedup_latest,
    "latest_batch": q_latest_batch,
    "topk": q_topk,
    "paging": q_paging,
    "paging_cap": q_paging_cap,
    "empty_batches": q_empty_batches,
    "upsert": q_upsert,
    "upsert_duplicates": q_upsert_duplicates,
    "surrogate_keys": q_surrogate_keys,
    "dim_repository": q_dim_repository,
    "fact_commits": q_fact_commits,
    "fact_left_lookup": q_fact_left_lookup,
    "watermark": q_watermark,
    "activity": q_activity,
    "incremental": q_incremental,
    "dq_not_null": q_dq_not_null,
    "dq_fk": q_dq_fk,
    "dq_watermark": q_dq_watermark,
    "dq_recent": q_dq_recent,
    "dq_recent_fails": q_dq_recent_fails,
    "latest_batch_scope": q_latest_batch_scope,
    "run_status": q_run_status,
    "run_status_excluded": q_run_status_excluded,
    "lenient_max": q_lenient_max,
    "layer_metrics": q_layer_metrics,
}


# -- whole runs: the persistent pipeline and the streaming load --------------------------------

PIPELINE_SPLIT = _dt.datetime(1998, 1, 1)
HISTORY = "36500 days"  # the driver tables are historical: the first run reads them all


def _scratch_warehouse(spark: SparkSession, tag: str):
    import uuid

    from ..session import checkpoint_root
    from ..sources.warehouse import Warehouse

    return Warehouse(spark, f"{checkpoint_root(spark)}/{tag}-{uuid.uuid4().hex}")


def pipeline_two_runs(spark: SparkSession, sf_dir: str, incremental: bool = False):
    """Run 1 sees orders before 1998, run 2 all orders; a fresh warehouse in the checkpoint folder."""
    from .pipeline import run, tpch_feeds

    wh = _scratch_warehouse(spark, "pipeline")
    run(spark, wh, tpch_feeds(spark, sf_dir, until=PIPELINE_SPLIT), RUN1, "run1", lookback=HISTORY,
        incremental=incremental)
    run(spark, wh, tpch_feeds(spark, sf_dir), RUN1 + _dt.timedelta(days=1), "run2",
        lookback=HISTORY, incremental=incremental)
    return wh


FAILED_RUN = _dt.datetime(1998, 7, 1, tzinfo=_dt.timezone.utc)
DELTA_LOOKBACK_DAYS = 800


def q_pipeline_delta_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry 1 in delta mode (L10, F9): run 1 lands and fails before staging; run 2, 400 days later,
    reads a look-back that leaves out the first orders of run 1, and still stages and loads them."""
    from .pipeline import run, tpch_feeds

    wh = _scratch_warehouse(spark, "pipeline-delta")
    lookback = f"{DELTA_LOOKBACK_DAYS} days"
    run(spark, wh, tpch_feeds(spark, sf_dir), FAILED_RUN, "run1", lookback=lookback, incremental=True,
        fail_at="transform_commits_to_stg", raise_on_failure=False)
    run(spark, wh, tpch_feeds(spark, sf_dir), FAILED_RUN + _dt.timedelta(days=400), "run2",
        lookback=lookback, incremental=True)
    fact = wh.read(S.FACT_COMMITS.name).select("sha", "repo_id", F.lit(True).alias("in_fact"))
    return to_ntz(wh.read(S.STG_COMMITS.name).select("sha", "repo_full_name", "committed_at")
                  .join(fact, "sha", "full_outer"))


def q_dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 + Q5 + R5: the kept checks of two runs; between them a fact row without a repository is
    planted, so the second run's foreign-key check fails and its log says so."""
    from .pipeline import run, tpch_feeds

    wh = _scratch_warehouse(spark, "dq-results")
    feeds = tpch_feeds(spark, sf_dir)
    run(spark, wh, feeds, RUN1, "run1", lookback=HISTORY)
    fact = wh.read(S.FACT_COMMITS.name)
    orphan = fact.orderBy("commit_key").limit(1).withColumns(
        {"sha": F.lit("orphan"), "repo_id": F.lit(-1).cast("long"), "commit_key": F.lit(-1).cast("long")})
    wh.replace(S.FACT_COMMITS.name, fact.unionByName(orphan.select(fact.columns)), check_keys=True)
    run(spark, wh, feeds, RUN1 + _dt.timedelta(days=1), "run2", lookback=HISTORY,
        raise_on_failure=False)
    log = wh.read(S.ETL_RUN_LOG.name).select("run_id", "status", "error_message", "fact_commits_rows")
    return wh.read(S.DQ_RESULTS.name).select("run_id", "check_name", "ok", "violations").join(log, "run_id")


def q_constraint_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + C2 + C3: orders written as run-log rows without the columns that have defaults."""
    wh = _scratch_warehouse(spark, "defaults")
    orders = table(spark, sf_dir, "orders")
    missing = [f.name for f in S.ETL_RUN_LOG.schema.fields
               if f.name not in ("pipeline_name", "dag_id", "run_id", *S.ETL_RUN_LOG.defaults)]
    rows = orders.select(F.col("o_orderpriority").alias("pipeline_name"),
                         F.col("o_orderstatus").alias("dag_id"),
                         F.col("o_orderkey").cast("string").alias("run_id"),
                         *[F.lit(None).cast(S.ETL_RUN_LOG.schema[c].dataType).alias(c) for c in missing])
    wh.replace(S.ETL_RUN_LOG.name, rows, as_of=RUN1, check_keys=True)
    return to_ntz(wh.read(S.ETL_RUN_LOG.name).select("pipeline_name", "dag_id", "run_id", "status",
                                                     "start_ts"))


def q_pack_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S5 + W1: all line items in one batch per return flag, in many chunks; keys (part numbers)
    repeat inside a batch and the last element in the batch's order wins."""
    from ..operators.dedup import latest_per_key

    li = table(spark, sf_dir, "lineitem")
    rec = F.struct("l_partkey", "l_orderkey", "l_linenumber")
    raw = pack_batches(li, ["l_returnflag"], rec, ["l_orderkey", "l_linenumber"], RUN1,
                       key=["l_partkey"], chunk_size=500)
    rows = flatten(raw, (("l_partkey", "$.l_partkey", "bigint"), ("l_orderkey", "$.l_orderkey", "bigint"),
                         ("l_linenumber", "$.l_linenumber", "int")),
                   keep=["l_returnflag", "chunk"], key_path="$.l_partkey", with_position=True)
    return latest_per_key(rows, ["l_returnflag", "l_partkey"],
                          [F.col("chunk").desc(), F.col("_pos").desc()]).drop("chunk", "_pos")


def q_pipeline_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry 1 (R1-R5, Q1-Q5, I1-I4 end to end): the run log after two daily runs."""
    wh = pipeline_two_runs(spark, sf_dir)
    return wh.read(S.ETL_RUN_LOG.name).select(
        "pipeline_name", "dag_id", "run_id", "status", "error_message", *METRICS)


def q_pipeline_delta_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry 1 in delta mode (L10, R4): the same log, with counts carried instead of scanned."""
    wh = pipeline_two_runs(spark, sf_dir, incremental=True)
    return wh.read(S.ETL_RUN_LOG.name).select(
        "pipeline_name", "dag_id", "run_id", "status", "error_message", *METRICS)


def q_pipeline_delta_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 + L10: three delta runs stage one organisation each, NATION_19, NATION_11, NATION_19; the
    repositories of NATION_11 land in the first run only and are staged in the second."""
    from .pipeline import run, tpch_feeds

    wh = _scratch_warehouse(spark, "scopes")
    feeds = tpch_feeds(spark, sf_dir)
    rest = replace(feeds, repos=feeds.repos.where("org_or_user <> 'NATION_11'"))
    for i, (scope, given) in enumerate((("NATION_19", feeds), ("NATION_11", rest), ("NATION_19", rest))):
        # what follows the dimension does not depend on the scope
        run(spark, wh, given, RUN1 + _dt.timedelta(days=i), f"run{i}", scope=scope, incremental=True,
            fail_at="extract_commits_to_raw", raise_on_failure=False)
    return wh.read(S.DIM_REPOSITORY.name).select("repo_id", "full_name", "owner_login", "is_current")


def _fact_in_two_loads(spark: SparkSession, sf_dir: str):
    """A warehouse whose fact took the orders in two change sets: those before 1998 dated a year early and
    given to the customer before, then all of them as they are.  Yields the warehouse after each."""
    from ..operators.rollup import BEFORE

    wh = _scratch_warehouse(spark, "loads")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("sha"), F.col("o_custkey").alias("repo_id"),
        F.col("o_orderdate").cast("timestamp").alias("committed_at"))
    early = orders.where(F.col("committed_at") < F.lit(PIPELINE_SPLIT)).withColumns({
        "repo_id": F.col("repo_id") - 1, "committed_at": F.col("committed_at") - F.expr("interval 1 year")})
    for source in (early, orders):
        wh.append_changes(S.FACT_COMMITS.name, upsert(
            wh.read(S.FACT_COMMITS.name), source, ["sha"], ["repo_id", "committed_at"],
            on_insert={"load_dts": F.lit(RUN1)}, surrogate_key="commit_key", changes_only=True, before=BEFORE))
        yield wh


def q_activity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 kept up from change rows: commits per repository and month after two loads, the second of which
    moves every row of the first to another repository and month."""
    from ..operators.rollup import advance_by_month, monthly_activity

    for wh in _fact_in_two_loads(spark, sf_dir):
        advance_by_month(wh)
    cust = table(spark, sf_dir, "customer")
    missing = [f.name for f in S.DIM_REPOSITORY.schema.fields if f.name not in ("repo_id", "full_name")]
    values = {"repo_key": F.col("c_custkey"), "name": F.col("c_name"), "owner_login": F.lit(""),
              "is_private": F.lit(False), "effective_from": F.lit(RUN1), "is_current": F.lit(True)}
    wh.replace(S.DIM_REPOSITORY.name, cust.select(
        F.col("c_custkey").alias("repo_id"), F.col("c_name").alias("full_name"),
        *[values.get(c, F.lit(None)).cast(S.DIM_REPOSITORY.schema[c].dataType).alias(c) for c in missing]))
    return to_ntz(monthly_activity(wh))


def q_dq_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 + Q3 from the fact's summary after two loads: customers with a negative balance are missing in the
    dimension, and the marks are the newest orders that are not pending, a day later."""
    from ..operators.rollup import advance_by_repo, repo_facts

    for wh in _fact_in_two_loads(spark, sf_dir):
        advance_by_repo(wh)
    cust = table(spark, sf_dir, "customer")
    dim = cust.where(F.col("c_acctbal") >= 0)
    marks = (table(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("F", "O"))
             .join(cust, F.col("o_custkey") == F.col("c_custkey"))
             .groupBy(F.col("c_name").alias("entity_name"))
             .agg((F.max("o_orderdate") + F.expr("interval 1 day")).cast("timestamp").alias("watermark_ts"))
             .withColumn("pipeline_name", F.lit(S.MARKS_PIPELINE)))
    facts = repo_facts(wh)
    return dq_foreign_key(facts, dim, "repo_id", "c_custkey", weight="n").unionByName(
        dq_watermark_not_ahead(marks, dim, facts, dim_name_col="c_name", dim_id_col="c_custkey"))


def q_pipeline_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry 1: marks after the incremental second run (upserted into a non-empty fact)."""
    wh = pipeline_two_runs(spark, sf_dir)
    return to_ntz(wh.read(S.ETL_WATERMARK.name).select("pipeline_name", "entity_name",
                                                       "watermark_ts"))


def q_stream_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two overlapping raw runs landed as files, loaded by available-now micro-batches
    (one file set per trigger); staging must equal the batch result: every order once."""
    from ..operators.loads import load_dimension_scd1, stage_latest_batch
    from ..streaming.incremental import stream_commits
    from .star import land_two_runs

    wh = _scratch_warehouse(spark, "stream")
    wh.ensure_tables()
    raw_repos, raw_commits = land_two_runs(spark, sf_dir)
    wh.replace(S.STG_REPOS.name, stage_latest_batch(wh.read(S.STG_REPOS.name), raw_repos, RUN1,
                                                    scope=None))
    wh.replace(S.DIM_REPOSITORY.name, load_dimension_scd1(
        wh.read(S.DIM_REPOSITORY.name), wh.read(S.STG_REPOS.name), RUN1))
    ckpt = f"{wh.root}/_checkpoints/commits"
    for ingested in (RUN1, RUN2):  # the two landing runs of ``land_two_runs``, in order
        wh.append(S.RAW_COMMITS.name, raw_commits.where(F.col("ingested_at") == F.lit(ingested)))
        stream_commits(spark, wh, ckpt, clock=lambda: RUN1 + _dt.timedelta(days=2))
    return to_ntz(wh.read(S.STG_COMMITS.name).select("sha", "repo_full_name", "committed_at",
                                                     "commit_message"))


def q_stream_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stateful running max per repository over the landed raw commit files, fed run by run
    (the state store carries the max across the two available-now executions)."""
    from ..streaming.incremental import stream_marks
    from .star import land_two_runs

    wh = _scratch_warehouse(spark, "stream-marks")
    _, raw_commits = land_two_runs(spark, sf_dir)
    ckpt = f"{wh.root}/_checkpoints/marks"
    for ingested in (RUN1, RUN2):  # the two landing runs of ``land_two_runs``, in order
        wh.append(S.RAW_COMMITS.name, raw_commits.where(F.col("ingested_at") == F.lit(ingested)))
        stream_marks(spark, f"{wh.root}/{S.RAW_COMMITS.name}/data", wh, ckpt,
                     clock=lambda: RUN1 + _dt.timedelta(days=2))
    return to_ntz(wh.read("stream_marks").select("entity_name", "watermark_ts"))


QUERIES.update({
    "stream_marks": q_stream_marks,
    "pipeline_run_log": q_pipeline_run_log,
    "pipeline_marks": q_pipeline_marks,
    "pipeline_delta_run_log": q_pipeline_delta_run_log,
    "pipeline_delta_scopes": q_pipeline_delta_scopes,
    "activity_rollup": q_activity_rollup,
    "dq_delta": q_dq_delta,
    "pipeline_delta_after_failure": q_pipeline_delta_after_failure,
    "pack_chunks": q_pack_chunks,
    "dq_results": q_dq_results,
    "constraint_defaults": q_constraint_defaults,
    "stream_staging": q_stream_staging,
})

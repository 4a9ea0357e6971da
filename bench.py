"""Benchmark of the load operators at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1).

``noop`` sink (or, for the pipeline, written to a scratch warehouse).  Prints one JSON line.

Inputs that a measured step consumes (raw batches, staging tables) are prepared once per process and
stored in the checkpoint folder, so each timing covers the operator, not its upstream.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time
import uuid

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from sparkmart import schemas as S  # noqa: E402
from sparkmart.functions.json import iso_utc  # noqa: E402
from sparkmart.operators.incremental import advance_watermark  # noqa: E402
from sparkmart.operators.loads import load_fact, stage_all_batches  # noqa: E402
from sparkmart.operators.quality import (dq_foreign_key, dq_not_null,  # noqa: E402
                                         dq_recent_raw_has_effect, dq_watermark_not_ahead,
                                         run_checks)
from sparkmart.operators.upsert import upsert  # noqa: E402
from sparkmart.plans.pipeline import run as run_pipeline  # noqa: E402
from sparkmart.plans.pipeline import tpch_feeds  # noqa: E402
from sparkmart.plans.star import build_star  # noqa: E402
from sparkmart.plans.tables import RUN1, RUN2, empty, table  # noqa: E402
from sparkmart.session import checkpoint_root, get_session, materialize  # noqa: E402
from sparkmart.sources.payload import flatten  # noqa: E402
from sparkmart.sources.raw import pack_batches  # noqa: E402

UTC = dt.timezone.utc
LINEITEM_FIELDS = (("l_orderkey", "$.l_orderkey", "bigint"), ("l_linenumber", "$.l_linenumber", "int"),
                   ("l_quantity", "$.l_quantity", "double"), ("l_shipdate", "$.l_shipdate", "timestamp"))


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def timed(fn, reps=3, warmup=1):
    for _ in range(warmup):
        fn()
    secs = []
    for _ in range(reps):
        t0 = time.perf_counter()
        fn()
        secs.append(time.perf_counter() - t0)
    return round(statistics.median(secs), 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):  # stage/task times for later reading, in a scratch folder
        import tempfile

        log_dir = tempfile.mkdtemp(prefix="sparkmart-events-", dir="/tmp")
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}"}
        print(f"event log: {log_dir}", file=sys.stderr)
    spark = get_session(f"local[{cpus}]", app_name="sparkmart-bench",
                        shuffle_partitions=int(cpus) * 2, driver_memory="16g", extra=extra)
    scratch = checkpoint_root(spark)

    # -- prepared inputs (not timed) ---------------------------------------------------------
    li = table(spark, sf_dir, "lineitem")
    rec = F.struct("l_orderkey", "l_linenumber", "l_quantity",
                   iso_utc("l_shipdate").alias("l_shipdate"))
    raw_li = materialize(pack_batches(li, ["l_orderkey"], rec, ["l_linenumber", "l_partkey"], RUN1))
    st = build_star(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    target = materialize(orders.where(F.col("o_orderdate") < F.lit(dt.datetime(2001, 1, 1))))
    source = materialize(
        orders.where(F.col("o_orderdate") >= F.lit(dt.datetime(2000, 5, 1)))
              .withColumn("o_orderstatus", F.lit("U")))

    queries = {}
    # 1. flatten: raw JSON batches per order -> typed lineitem rows
    queries["flatten"] = timed(lambda: noop(flatten(raw_li, LINEITEM_FIELDS,
                                                    key_path="$.l_orderkey")), reps)
    # 2. latest per key over duplicated batches (two overlapping runs), through staging upsert
    queries["dedup_latest"] = timed(lambda: noop(stage_all_batches(
        empty(spark, S.STG_COMMITS), st.raw_commits, RUN2)), reps)
    # 3. upsert with ~10 % matched, ~9 % new, the rest untouched
    queries["upsert"] = timed(lambda: noop(upsert(target, source, ["o_orderkey"],
                                                  ["o_orderstatus", "o_totalprice"])), reps)
    # 4. fact load with lookup, then the marks from the loaded fact
    def fact_and_marks():
        fact = materialize(load_fact(empty(spark, S.FACT_COMMITS), st.stg_commits, st.stg_repos,
                                     RUN2))
        noop(advance_watermark(empty(spark, S.ETL_WATERMARK), fact, st.dim, RUN2))
    queries["fact_load_marks"] = timed(fact_and_marks, reps)
    # 5. the four checks together
    queries["quality_checks"] = timed(lambda: run_checks([
        dq_not_null(st.fact), dq_foreign_key(st.fact, st.dim),
        dq_watermark_not_ahead(st.marks, st.dim, st.fact),
        dq_recent_raw_has_effect(st.raw_commits, st.stg_commits, RUN2)]).collect(), reps)
    # consumer query over the star (D1): commits per repository and month
    def activity():
        per_month = st.fact.groupBy("repo_id", F.date_trunc("month", "committed_at").alias("m")) \
                           .agg(F.count(F.lit(1)).alias("n"))
        noop(per_month.join(st.dim.select("repo_id", "full_name"), "repo_id")
                      .groupBy("full_name", "m").agg(F.sum("n").alias("n_commits")))
    queries["consumer_activity"] = timed(activity, reps)
    # 6. whole pipeline: first run (history up to 1998) and the incremental second run, in the
    #    reference's mode (staging re-reads all raw batches) and in delta mode (only this run's)
    from sparkmart.sources.warehouse import Warehouse

    for mode, delta in (("", False), ("_delta", True)):
        first, second = [], []
        for i in range(reps + 1):
            wh = Warehouse(spark, f"{scratch}/bench-wh-{uuid.uuid4().hex}")
            t0 = time.perf_counter()
            run_pipeline(spark, wh, tpch_feeds(spark, sf_dir, until=dt.datetime(1998, 1, 1)),
                         dt.datetime(2024, 2, 1, tzinfo=UTC), "run1", lookback="36500 days",
                         incremental=delta)
            t1 = time.perf_counter()
            run_pipeline(spark, wh, tpch_feeds(spark, sf_dir), dt.datetime(2024, 2, 2, tzinfo=UTC),
                         "run2", lookback="36500 days", incremental=delta)
            t2 = time.perf_counter()
            if i > 0:  # first iteration is the warm-up
                first.append(t1 - t0)
                second.append(t2 - t1)
        queries[f"pipeline_first_run{mode}"] = round(statistics.median(first), 3)
        queries[f"pipeline_incremental_run{mode}"] = round(statistics.median(second), 3)

    # the delta-mode runs are reported next to it
    baseline_items = ("flatten", "dedup_latest", "upsert", "fact_load_marks", "quality_checks",
                      "pipeline_first_run", "pipeline_incremental_run")
    total = round(sum(queries[k] for k in baseline_items), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "load_operators_total_median_sec", "value": total, "unit": "sec",
                      "queries": queries, "sf": sf, "cpus": int(cpus), "driver_memory": "16g",
                      "reps": reps}))


if __name__ == "__main__":
    main()

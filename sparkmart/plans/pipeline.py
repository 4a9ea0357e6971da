"""The daily incremental load as one Spark application.

``run`` executes the reference's step order on a ``Warehouse``:

    ensure tables -> run start -> land repositories -> repositories to staging -> dimension ->
    pick entities, read marks, land new commits -> commits to staging -> fact -> marks ->
    four checks -> run end -> gate

Each step reads the committed state of its inputs and commits one new table version, so a failed
step leaves every table at its last good version and the lineage of each job starts at stored data.
The marks move only after the fact load succeeded.  Steps are recorded as task states
``(dag_id, run_id, task_id, state)``; a failure marks the rest ``upstream_failed``; the run log gets
status and root cause from ``run_outcome`` and is written before the gate raises.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.incremental import (advance_watermark, filter_incremental, resolve_since,
                                     select_entities)
from ..operators.loads import load_dimension_scd1, load_fact, stage_all_batches, stage_latest_batch
from ..operators.quality import (QualityGateError, dq_foreign_key, dq_not_null,
                                 dq_recent_raw_has_effect, dq_watermark_not_ahead, gate)
from ..operators.quality import run_checks as union_checks
from ..operators.runlog import run_end, run_outcome, run_start
from ..operators.upsert import upsert
from ..functions.json import payload_size
from ..sources.raw import pack_batches
from ..sources.warehouse import APPEND_ONLY, Warehouse
from ..operators.rollup import repo_facts
from ..streaming.incremental import advance_marks_delta, load_fact_delta, stage_commit_delta
from .staging import Ledger, layer_rows, recall_rows


@dataclass
class Feeds:
    """Where records come from (the API pages of the reference, here any Spark tables).

    * ``repos``: ``(org_or_user, repo_id, rec)``, one repository object per row;
    * ``commits``: ``(repo_full_name, <ts_col>, <order cols>, rec)``;
    * ``commit_ts``: record time used against the marks; ``commit_order``: payload order;
      ``commit_key``: column(s) that identify a commit (the whole record when empty).
    """

    repos: DataFrame
    commits: DataFrame
    commit_ts: str = "committed_at"
    commit_order: list = field(default_factory=list)
    commit_key: list = field(default_factory=list)


@dataclass
class RunResult:
    run_id: str
    status: str
    error_message: str | None
    checks: list[dict]
    tasks: list[tuple[str, str]]
    seconds: dict[str, float] = field(default_factory=dict)
    # What the extract steps landed, observed during their writes
    landed: dict[str, dict] = field(default_factory=dict)


# fixed values: the step names of the run log
TASKS = (
    "init_schema", "log_run_start", "extract_repos_to_raw", "transform_repos_to_stg",
    "load_dim_repository", "extract_commits_to_raw", "transform_commits_to_stg",
    "load_fact_commits", "update_watermark_after_load", "dq_fact_repo_id_not_null",
    "dq_fact_repo_fk_dim", "dq_watermark_not_ahead_of_fact", "dq_last_raw_batches_have_effect",
)


def run(
    spark: SparkSession,
    wh: Warehouse,
    feeds: Feeds,
    as_of: _dt.datetime,
    run_id: str,
    *,
    dag_id: str = S.RUN_PIPELINE,
    pipeline: str = S.RUN_PIPELINE,
    marks_pipeline: str = S.MARKS_PIPELINE,
    scope: str | None = None,
    max_entities: int | None = None,
    lookback: str = S.DEFAULT_LOOKBACK,
    raise_on_failure: bool = True,
    fail_at: str | None = None,
    checks_first: bool = False,
    incremental: bool = False,
    keep_versions: int | None = 2,
) -> RunResult:
    """One run.

    ``incremental`` stages only the batches that no run has staged yet: this run's, those of runs that failed
    after landing, and those of a scope that its runs left out (``plans.staging.Ledger``).  Staging, dimension,
    fact and marks get their changed rows alone; commits wait for the fact load in a table of their own;
    marks and checks read a summary of the fact that follows its change rows; counts are carried.  Reading
    the keys of a table that is joined with the changes is left of the cost of the whole table.  The default
    re-reads every raw batch and writes whole tables, as the reference does; both give the same tables.

    ``checks_first`` runs the checks that do not read the marks (Q1, Q2, Q4) before the marks move,
    so a failed check leaves the marks where they were (the reference moves them first).
    ``keep_versions``: after a successful run, every keyed table keeps only its newest versions
    (the current one and one to roll back to by default; ``None`` keeps all).  A failed run deletes
    nothing.
    ``fail_at`` injects a failure into the named step (tests of the mark rule).
    """
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=_dt.timezone.utc)
    states: dict[str, str] = {}
    check_rows: list[dict] = []
    errors: list[tuple[str, Exception]] = []
    seconds: dict[str, float] = {}
    landed: dict[str, dict] = {}

    def observed_append(task: str, table: str, raw: DataFrame) -> None:
        # batch and record counts gathered by the write itself (no extra job)
        obs = Observation(task)
        # (observed metrics allow no DISTINCT: chunks are counted; a batch has >= 1 chunk)
        raw = raw.observe(obs, F.count(F.lit(1)).alias("chunks"),
                          F.sum(payload_size("payload")).cast("long").alias("records"))
        wh.append(table, raw)
        landed[task] = dict(obs.get)

    def step(task: str, fn: Callable[[], None], after_failure_skip: bool = True) -> bool:
        if after_failure_skip and any(s in ("failed", "upstream_failed") for s in states.values()):
            states[task] = "upstream_failed"
            return False
        t0 = time.perf_counter()
        # jobs of a step carry its name (event logs, status tracker)
        spark.sparkContext.setJobGroup(f"{run_id}:{task}", f"{dag_id} {run_id} {task}")
        try:
            if fail_at == task:
                raise RuntimeError(f"injected failure in {task}")
            fn()
            states[task] = "success"
            return True
        except Exception as ex:  # noqa: BLE001  (recorded; raised after the run log is written)
            states[task] = "failed"
            errors.append((task, ex))
            return False
        finally:
            seconds[task] = round(time.perf_counter() - t0, 3)
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    def init():
        wh.ensure_tables()
        recall_rows(wh)

    def log_start():
        wh.replace(S.ETL_RUN_LOG.name, run_start(wh.read(S.ETL_RUN_LOG.name), as_of,
                                                 pipeline=pipeline, dag_id=dag_id, run_id=run_id,
                                                 logical_date=as_of))

    def land_repos():
        raw = pack_batches(feeds.repos, ["org_or_user"], F.col("rec"), ["repo_id"], as_of,
                           key=["repo_id"])
        ledger.before_landing(S.RAW_REPOS.name, as_of)
        observed_append("extract_repos_to_raw", S.RAW_REPOS.name, raw)

    ledger = Ledger(wh)

    def repos_to_stg():
        if incremental:
            wh.append_changes(S.STG_REPOS.name, stage_latest_batch(
                wh.read(S.STG_REPOS.name), ledger.open_batches(S.RAW_REPOS.name), as_of, scope=scope,
                staged=ledger.staged(S.RAW_REPOS.name), changes_only=True))
        else:
            wh.replace(S.STG_REPOS.name, stage_latest_batch(
                wh.read(S.STG_REPOS.name), wh.read(S.RAW_REPOS.name), as_of, scope=scope))
        ledger.close(S.RAW_REPOS.name, as_of, scope)

    def load_dim():
        dim, stg = wh.read(S.DIM_REPOSITORY.name), wh.read(S.STG_REPOS.name)
        if incremental:
            wh.append_changes(S.DIM_REPOSITORY.name, load_dimension_scd1(dim, stg, as_of, changes_only=True))
        else:
            wh.replace(S.DIM_REPOSITORY.name, load_dimension_scd1(dim, stg, as_of))

    def land_commits():
        stg = wh.read(S.STG_REPOS.name)
        chosen = select_entities(stg, max_entities).select(F.col("full_name").alias("entity_name"))
        since = resolve_since(chosen, wh.read(S.ETL_WATERMARK.name), as_of,
                              pipeline=marks_pipeline, lookback=lookback)
        recs = _incremental(feeds, since)
        # one batch per chosen repository, ``[]`` when nothing is new; like the reference, every
        # commit batch carries the run's configured organisation
        raw = pack_batches(recs, ["repo_full_name"], F.col("rec"),
                           feeds.commit_order or [feeds.commit_ts], as_of, key=feeds.commit_key,
                           scopes=chosen.withColumnRenamed("entity_name", "repo_full_name"))
        raw = raw.withColumn("org_or_user", F.lit(scope or S.DEFAULT_SCOPE))
        ledger.before_landing(S.RAW_COMMITS.name, as_of)
        observed_append("extract_commits_to_raw", S.RAW_COMMITS.name, raw)

    def commits_to_stg():
        if incremental:
            stage_commit_delta(wh, ledger.unstaged(S.RAW_COMMITS.name), as_of)
        else:
            wh.reset(S.STG_COMMITS_PENDING.name)  # follows from staging when a delta run needs it
            wh.replace(S.STG_COMMITS.name, stage_all_batches(
                wh.read(S.STG_COMMITS.name), wh.read(S.RAW_COMMITS.name), as_of))
        ledger.close(S.RAW_COMMITS.name, as_of)

    def fact_load():
        if incremental:
            load_fact_delta(wh, as_of)
            return
        wh.replace(S.FACT_COMMITS.name, load_fact(
            wh.read(S.FACT_COMMITS.name), wh.read(S.STG_COMMITS.name), wh.read(S.STG_REPOS.name),
            as_of))

    def marks():
        if incremental:
            advance_marks_delta(wh, as_of, marks_pipeline)
            return
        wh.replace(S.ETL_WATERMARK.name, advance_watermark(
            wh.read(S.ETL_WATERMARK.name), wh.read(S.FACT_COMMITS.name),
            wh.read(S.DIM_REPOSITORY.name), as_of, pipeline=marks_pipeline))

    def check(builder: Callable[[], DataFrame]) -> Callable[[], None]:
        def _run():
            rows = [r.asDict() for r in builder().collect()]
            check_rows.extend(rows)
            gate(rows)  # a failing check fails its task
        return _run

    # a delta run checks the summary of the fact, which stands for all of its rows
    fact = lambda: repo_facts(wh) if incremental else wh.read(S.FACT_COMMITS.name)
    weight = "n" if incremental else None
    dim = lambda: wh.read(S.DIM_REPOSITORY.name)
    plan = [
        ("init_schema", init),
        ("log_run_start", log_start),
        ("extract_repos_to_raw", land_repos),
        ("transform_repos_to_stg", repos_to_stg),
        ("load_dim_repository", load_dim),
        ("extract_commits_to_raw", land_commits),
        ("transform_commits_to_stg", commits_to_stg),
        ("load_fact_commits", fact_load),
        ("update_watermark_after_load", marks),
    ]
    checks = [
        ("dq_fact_repo_id_not_null", lambda: dq_not_null(fact(), weight=weight)),
        ("dq_fact_repo_fk_dim", lambda: dq_foreign_key(fact(), dim(), weight=weight)),
        ("dq_last_raw_batches_have_effect",
         lambda: dq_recent_raw_has_effect(wh.read(S.RAW_COMMITS.name),
                                          wh.read(S.STG_COMMITS.name), as_of)),
        ("dq_watermark_not_ahead_of_fact",
         lambda: dq_watermark_not_ahead(wh.read(S.ETL_WATERMARK.name), dim(), fact(),
                                        pipeline=marks_pipeline)),
    ]

    def run_checks(items) -> None:
        # checks run side by side: each is independent of the others' outcome.  They are
        # evaluated as one union (one small result row per check); if that evaluation itself
        # fails, each check is evaluated on its own so the failing one is named.
        blocked = any(s != "success" for s in states.values())
        if blocked:
            for task, _ in items:
                states[task] = "upstream_failed"
            return
        t0 = time.perf_counter()
        rows = None
        if fail_at not in {t for t, _ in items}:
            try:
                spark.sparkContext.setJobGroup(f"{run_id}:checks", f"{dag_id} {run_id} checks")
                rows = {r["check_name"]: r.asDict()
                        for r in union_checks([b() for _, b in items]).collect()}
            except Exception:  # noqa: BLE001
                rows = None
        if rows is None or set(rows) != {t for t, _ in items}:
            for task, builder in items:
                step(task, check(builder), after_failure_skip=False)
            return
        share = round((time.perf_counter() - t0) / len(items), 3)
        for task, _ in items:
            row = rows[task]
            check_rows.append(row)
            states[task] = "success" if row["ok"] == 1 else "failed"
            seconds[task] = share
            if row["ok"] != 1:
                errors.append((task, QualityGateError([row])))

    if not checks_first:
        # the reference's order: marks move right after the fact load, then the four checks
        for task, fn in plan:
            step(task, fn)
        run_checks(checks)
    else:
        # option: the checks that do not read the marks gate the marks; the mark check follows
        for task, fn in plan[:-1]:
            step(task, fn)
        run_checks(checks[:3])
        step(*plan[-1])
        run_checks(checks[3:])

    # the checks' rows are kept for every run, before the gate raises
    if check_rows:
        rows = [(run_id, r["check_name"], int(r["ok"]), int(r["violations"]), as_of)
                for r in check_rows]
        wh.replace(S.DQ_RESULTS.name, upsert(
            wh.read(S.DQ_RESULTS.name), spark.createDataFrame(rows, S.DQ_RESULTS.schema),
            list(S.DQ_RESULTS.keys), strategy="broadcast"))

    # run end: outcome from the task states, layer counts, update of the run row
    task_rows = [(dag_id, run_id, t, states.get(t)) for t in TASKS if t != "log_run_start"]
    ts_df = spark.createDataFrame(task_rows, S.TASK_STATES.schema)
    # one run -> one outcome row: collected once, reused for the log and the result
    outcome_df = run_outcome(ts_df)
    out = outcome_df.first()
    outcome = spark.createDataFrame([out], outcome_df.schema)
    counts = layer_rows(wh)
    wh.replace(S.ETL_RUN_LOG.name, run_end(wh.read(S.ETL_RUN_LOG.name), outcome, counts, as_of,
                                           pipeline=pipeline, strategy="broadcast"))
    result = RunResult(run_id, out["status"], out["error_message"], check_rows,
                       [(t, states.get(t)) for t in TASKS], seconds, landed)
    if result.status == "SUCCESS" and keep_versions is not None:
        for spec in S.ALL_TABLES:
            if spec.name not in APPEND_ONLY:
                wh.fold(spec.name)
                wh.vacuum(spec.name, keep=keep_versions)
    if raise_on_failure and result.status != "SUCCESS":
        failed_checks = [r for r in check_rows if r["ok"] == 0]
        if failed_checks:
            raise QualityGateError(failed_checks)
        cause = next((ex for t, ex in errors if not t.startswith("dq_")), None)
        raise RuntimeError(f"run {run_id} failed: {result.error_message}") from cause
    return result


def _incremental(feeds: Feeds, since: DataFrame) -> DataFrame:
    """I2 over the commit feed: rows of the chosen repositories at or after their mark."""
    return filter_incremental(feeds.commits, since.withColumnRenamed("entity_name", "repo_full_name"),
                              entity_col="repo_full_name", ts_col=feeds.commit_ts)


def tpch_feeds(spark: SparkSession, sf_dir: str, until: _dt.datetime | None = None,
               org: str | Column = "tpch") -> Feeds:
    """Feeds over the driver tables; ``until`` hides orders dated after it (the source as it was
    on an earlier day)."""
    from ..sources.landing import commit_records, repo_records
    from .tables import table

    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    orders = table(spark, sf_dir, "orders")
    visible = orders if until is None else orders.where(F.col("o_orderdate") < F.lit(until))
    commits = commit_records(visible, customer, org=org)
    return Feeds(
        repos=repo_records(customer, nation, visible),
        commits=commits,
        commit_ts="o_orderdate",
        commit_order=[F.lit(0) - F.unix_micros(F.col("o_orderdate").cast("timestamp")),
                      F.lit(0) - F.col("o_orderkey")],
        commit_key=["o_orderkey"],
    )

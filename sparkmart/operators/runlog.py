"""Run audit (R1-R5): start record, outcome from task states, layer metrics, end record.

The outcome is computed set-wise from a task-state table ``(dag_id, run_id, task_id, state)``, so the
same operator summarises one run or the whole run history.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..sources.raw import as_of_col
from .upsert import update_by_key, upsert

RUN_KEYS = ("pipeline_name", "dag_id", "run_id")


def run_start(run_log: DataFrame, as_of, *, pipeline: str, dag_id: str, run_id: str,
              logical_date=None) -> DataFrame:
    """Upsert the run row as RUNNING with ``start_ts = as_of``; a restart clears end and error
    but keeps ``logical_date`` and the metrics of the earlier attempt."""
    spark = run_log.sparkSession
    src = spark.range(1).select(
        F.lit(pipeline).alias("pipeline_name"), F.lit(dag_id).alias("dag_id"),
        F.lit(run_id).alias("run_id"),
        (as_of_col(logical_date) if logical_date is not None
         else F.lit(None).cast("timestamp")).alias("logical_date"),
        F.lit("RUNNING").alias("status"), as_of_col(as_of).alias("start_ts"),
        F.lit(None).cast("timestamp").alias("end_ts"), F.lit(None).cast("string").alias("error_message"))
    # the source is a single row: broadcasting it needs no measurement
    return upsert(run_log, src, list(RUN_KEYS), ["status", "start_ts", "end_ts", "error_message"],
                  assume_unique=True, strategy="broadcast")


def _states_text(pairs: Column) -> Column:
    """``{'none': 1, 'success': 2}`` from an array of (state, n), sorted by state."""
    items = F.transform(F.array_sort(pairs),
                        lambda p: F.concat(F.lit("'"), p["st"], F.lit("': "), p["n"].cast("string")))
    return F.concat(F.lit("{"), F.array_join(items, ", "), F.lit("}"))


def run_outcome(task_states: DataFrame, *, run_cols: Sequence[str] = ("dag_id", "run_id"),
                exclude: Sequence[str] = S.RUN_LOG_TASKS, runs: DataFrame | None = None,
                priority: Sequence[str] = S.CULPRIT_PRIORITY) -> DataFrame:
    """R2 + R3: one row per run with ``status``, ``error_message``, ``culprit_task``,
    ``culprit_state`` and ``n_tasks``.

    * any ``failed`` -> FAILED, "FAILED task: <id>";
    * else any ``upstream_failed`` -> FAILED, "UPSTREAM_FAILED task: <id>";
    * else all ``success`` (also: no tasks) -> SUCCESS;
    * else FAILED, "Incomplete run; states={...}" (NULL state counts as ``none``).

    Ties pick the smallest task id.  Aggregated in two levels, (run, state) then run, so a run with
    very many tasks is combined map-side.  ``runs`` lists runs that may have no task rows at all.
    """
    run_cols = list(run_cols)
    ts = (task_states.where(~F.col("task_id").isin(list(exclude)))
                     .withColumn("st", F.coalesce(F.col("state"), F.lit("none"))))
    per_state = ts.groupBy(*run_cols, "st").agg(F.count(F.lit(1)).alias("n"),
                                                F.min("task_id").alias("first_task"))
    prio = F.array(*[F.lit(p) for p in priority])
    rank = F.array_position(prio, F.col("st"))
    per_run = per_state.groupBy(*run_cols).agg(
        F.sum("n").alias("n_tasks"),
        F.sum(F.when(F.col("st") != "success", F.col("n")).otherwise(0)).alias("n_not_success"),
        F.min(F.when(F.col("st") == "failed", F.col("first_task"))).alias("_failed"),
        F.min(F.when(F.col("st") == "upstream_failed", F.col("first_task"))).alias("_upstream"),
        F.min_by(F.struct(F.col("st"), F.col("first_task")),
                 F.when(rank > 0, F.struct(rank, F.col("first_task")))).alias("_culprit"),
        F.collect_list(F.struct(F.col("st"), F.col("n"))).alias("_pairs"),
    )
    if runs is not None:
        per_run = runs.select(*run_cols).distinct().join(per_run, run_cols, "left")
    n_bad = F.coalesce(F.col("n_not_success"), F.lit(0))
    status = (F.when(F.col("_failed").isNotNull(), F.lit("FAILED"))
               .when(F.col("_upstream").isNotNull(), F.lit("FAILED"))
               .when(n_bad == 0, F.lit("SUCCESS"))
               .otherwise(F.lit("FAILED")))
    message = (F.when(F.col("_failed").isNotNull(), F.concat(F.lit("FAILED task: "), F.col("_failed")))
                .when(F.col("_upstream").isNotNull(),
                      F.concat(F.lit("UPSTREAM_FAILED task: "), F.col("_upstream")))
                .when(n_bad == 0, F.lit(None).cast("string"))
                .otherwise(F.concat(F.lit("Incomplete run; states="), _states_text(F.col("_pairs")))))
    culprit_ok = F.col("_culprit.first_task").isNotNull() & (
        F.array_position(prio, F.col("_culprit.st")) > 0)
    return per_run.select(
        *run_cols, status.alias("status"), message.alias("error_message"),
        F.when(culprit_ok, F.col("_culprit.first_task")).alias("culprit_task"),
        F.when(culprit_ok, F.col("_culprit.st")).alias("culprit_state"),
        F.coalesce(F.col("n_tasks"), F.lit(0)).cast("long").alias("n_tasks"))


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """R4 as rows: ``(tbl, n)`` per table (``union all`` of counts)."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("n")).select(F.lit(name).alias("tbl"), "n")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_end(run_log: DataFrame, outcome: DataFrame, metrics: Mapping[str, int | DataFrame], as_of,
            *, pipeline: str, strategy: str = "auto") -> DataFrame:
    """Update the run row with status, message, end time and the layer row counts; no row is written
    when the start record is missing.  A metric is a count, or a table to be counted in a scalar subquery.

    ``strategy="broadcast"`` when ``outcome`` is known to be small (one run)."""
    src = outcome.select(
        F.lit(pipeline).alias("pipeline_name"), "dag_id", "run_id", "status", "error_message",
        as_of_col(as_of).alias("end_ts"),
        *[(m.agg(F.count(F.lit(1)).cast("long")).scalar() if isinstance(m, DataFrame)
           else F.lit(m).cast("long")).alias(name) for name, m in metrics.items()])
    cols = ["end_ts", "status", "error_message"] + list(metrics)
    return update_by_key(run_log, src, list(RUN_KEYS), cols, assume_unique=True, strategy=strategy)

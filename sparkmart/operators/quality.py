"""Data-quality checks (Q1-Q4) and the gate (Q5).

Each check is a one-row DataFrame ``(check_name, ok, violations)`` where ``ok`` is 1 (pass) or 0.  Checks
never pull data to the driver; only the gate collects, and it collects one row per check.

The fact side is aggregated per key before any join (partial aggregation absorbs a hot key inside
the map tasks), so a check shuffles one small row per distinct key, not one row per fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.json import payload_size
from ..sources.raw import as_of_col


class QualityGateError(RuntimeError):
    """At least one data-quality check failed."""

    def __init__(self, failed: list[dict]):
        self.failed = failed
        super().__init__("data-quality checks failed: " + ", ".join(f["check_name"] for f in failed))


def _result(name: str, one_row: DataFrame) -> DataFrame:
    """``one_row`` is a global aggregate with column ``v`` (always exactly one row)."""
    v = F.coalesce(F.col("v").cast("long"), F.lit(0).cast("long"))
    return one_row.select(v.alias("v")).select(
        F.lit(name).alias("check_name"),
        F.when(F.col("v") == 0, F.lit(1)).otherwise(F.lit(0)).alias("ok"),
        F.col("v").alias("violations"),
    )


def _rows(weight: str | None):
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def dq_not_null(fact: DataFrame, col: str = "repo_id",
                name: str = "dq_fact_repo_id_not_null", weight: str | None = None) -> DataFrame:
    """Q1: no NULL in ``col`` (reads that one column only).

    ``weight`` (here and in Q2): the fact comes summed up per key, with its number of rows in this column
    (``operators.rollup.repo_facts``), so that the check reads a row per repository instead of the fact."""
    return _result(name, fact.where(F.col(col).isNull()).agg(_rows(weight).alias("v")))


def dq_foreign_key(fact: DataFrame, dim: DataFrame, fact_col: str = "repo_id",
                   dim_col: str = "repo_id", name: str = "dq_fact_repo_fk_dim",
                   weight: str | None = None) -> DataFrame:
    """Q2: every fact key exists in the dimension; a NULL key counts as a violation.

    Written as an explicit ``left_anti`` (Catalyst keeps ``LEFT JOIN ... IS NULL`` as an outer join
    plus filter).  Facts are first counted per key, so the anti join sees one row per distinct key.
    """
    per_key = fact.groupBy(F.col(fact_col).alias("_k")).agg(_rows(weight).alias("_n"))
    keys = dim.select(F.col(dim_col).alias("_k"))
    orphans = per_key.join(keys, "_k", "left_anti")
    return _result(name, orphans.agg(F.sum("_n").alias("v")))


def watermark_vs_fact(marks: DataFrame, dim: DataFrame, fact: DataFrame, *,
                      pipeline: str = S.MARKS_PIPELINE, dim_name_col: str = "full_name",
                      dim_id_col: str = "repo_id", fact_id_col: str = "repo_id",
                      ts_col: str = "committed_at") -> DataFrame:
    """Per mark: ``(entity_name, watermark_ts, max_fact)`` through name -> dimension -> fact."""
    m = (marks.where(F.col("pipeline_name") == F.lit(pipeline))
              .select("entity_name", "watermark_ts"))
    d = dim.select(F.col(dim_name_col).alias("entity_name"), F.col(dim_id_col).alias("_id"))
    f = fact.groupBy(F.col(fact_id_col).alias("_id")).agg(F.max(ts_col).alias("_mf"))
    return (m.join(d, "entity_name", "left").join(f, "_id", "left")
             .groupBy("entity_name", "watermark_ts").agg(F.max("_mf").alias("max_fact")))


def watermark_violations(marks: DataFrame, dim: DataFrame, fact: DataFrame, **kw) -> DataFrame:
    """The marks Q3 counts, as rows ``(entity_name, watermark_ts, max_fact)``: ahead of the fact,
    or without a dimension/fact match (a renamed repository's orphan mark), or with a NULL max."""
    t = watermark_vs_fact(marks, dim, fact, **kw)
    return t.where(F.col("max_fact").isNull() | (F.col("max_fact") < F.col("watermark_ts")))


def dq_watermark_not_ahead(marks: DataFrame, dim: DataFrame, fact: DataFrame,
                           name: str = "dq_watermark_not_ahead_of_fact", **kw) -> DataFrame:
    """Q3: no mark ahead of the fact; a mark without dimension/fact match or a NULL max fails too
    (``watermark_violations`` lists the entities)."""
    bad = watermark_violations(marks, dim, fact, **kw)
    return _result(name, bad.agg(F.count(F.lit(1)).alias("v")))


def dq_recent_raw_has_effect(raw: DataFrame, staging: DataFrame, as_of, *,
                             window: str = S.RECENT_WINDOW,
                             staging_ts_col: str = "raw_ingested_at",
                             name: str = "dq_last_raw_batches_have_effect") -> DataFrame:
    """Q4: if a non-empty raw batch landed within ``window`` before ``as_of``, some staging row
    carries an ingest time inside the window.  One aggregate plus one scalar subquery; the time predicates reach the
    parquet scans as pushed filters."""
    since = as_of_col(as_of) - F.expr(f"INTERVAL {window}")
    recent = raw.where(F.col("ingested_at") >= since)
    if "ingest_date" in raw.columns:  # warehouse raw tables: prune ingest-date directories too
        recent = recent.where(F.col("ingest_date") >= F.to_date(since))
    recent_stg = (staging.where(F.col(staging_ts_col) >= since)
                         .agg(F.count(F.lit(1))).scalar())
    counts = recent.where(payload_size("payload") > 0).agg(F.count(F.lit(1)).alias("n_raw"))
    v = (F.when(F.col("n_raw") == 0, F.lit(0)).when(recent_stg > 0, F.lit(0))
          .otherwise(F.col("n_raw")))
    return _result(name, counts.select(v.alias("v")))


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    """All checks as one small DataFrame (evaluated together, as the parallel check list is)."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def gate(results: DataFrame | list) -> list[dict]:
    """Q5: raise ``QualityGateError`` when any check has ``ok = 0``; returns the rows otherwise.

    Accepts the checks DataFrame (one row per check is collected) or already collected rows, so a
    caller can write the results first and raise afterwards.
    """
    rows = results.collect() if isinstance(results, DataFrame) else results
    rows = [r.asDict() if hasattr(r, "asDict") else dict(r) for r in rows]
    failed = [r for r in rows if r["ok"] == 0]
    if failed:
        raise QualityGateError(failed)
    return rows

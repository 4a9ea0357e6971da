"""Incremental loads with Structured Streaming.

* ``stream_commits`` (T1): the raw commit files are a streaming parquet source; each micro-batch
  (``trigger(availableNow=True)``: every file not yet seen, then stop) is flattened, deduplicated and
  upserted into staging with the ingest-time guard, then the fact is loaded for the commits that wait in
  ``stg_commits_pending``: those the micro-batch changed, and earlier ones whose repository was unknown.
  Each table gets its changed rows alone, and the marks follow from the fact's summary.  Any split of the raw files into
  micro-batches, in any arrival order, gives the batch result: the guard applies the dedup's own
  order (ingest time desc, entity asc), so an older late file never beats a newer row and ties go
  the same way as in batch (property-tested).  Ties inside one batch (same time and entity) are
  settled by position: a key's records of one batch share a chunk row and so a file, however
  ``maxFilesPerTrigger`` splits a landing.
* ``stream_marks`` (T2): a stateful streaming ``max`` per entity over the flattened commits, in update
  mode; the state store (checkpointed) survives restarts, and an older late row cannot lower a mark.

No event-time watermark is used: the reference never drops late rows once they are landed.
A replayed micro-batch re-applies the same upsert, which is idempotent apart from stamps.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators.incremental import advance_watermark
from ..operators.loads import load_fact, stage_all_batches
from ..operators.rollup import BEFORE, advance_by_repo, repo_facts
from ..operators.upsert import upsert
from ..sources.payload import flatten
from ..sources.raw import as_of_col
from ..session import materialize
from ..sources.warehouse import Warehouse

# raw files as written by ``Warehouse.append`` (ingest-date partition column included)
RAW_STREAM_SCHEMA = T.StructType(list(S.RAW_COMMITS.schema.fields)
                                 + [T.StructField("ingest_date", T.DateType(), True)])


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc)


#: The tables to which a delta adds change sets.
DELTA_TABLES = (S.STG_COMMITS.name, S.STG_COMMITS_PENDING.name, S.FACT_COMMITS.name, S.FACT_BY_REPO.name,
                S.ETL_WATERMARK.name)


def stage_commit_delta(wh: Warehouse, batch: DataFrame, as_of: _dt.datetime) -> None:
    """Raw commit rows of one delta -> change rows of staging (guarded upsert), which then wait in
    ``stg_commits_pending`` for the fact load, also if that fails in this run."""
    pending, stg = S.STG_COMMITS_PENDING.name, S.STG_COMMITS.name
    if not wh.versions(pending) and wh.versions(stg):
        # a full run came before: what it left out of the fact waits
        loaded = wh.read(S.FACT_COMMITS.name).select("sha")
        wh.replace(pending, wh.read(stg).join(loaded, "sha", "left_anti"))
    version = wh.append_changes(stg, stage_all_batches(
        wh.read(stg), batch.select(*S.RAW_COMMITS.columns), as_of, guard=True, changes_only=True))
    wh.append_changes(pending, wh.changes(stg, version - 1).drop("c"))


def load_fact_delta(wh: Warehouse, as_of: _dt.datetime) -> None:
    """Fact load of the waiting commits whose repository is known; the others go on waiting.

    Neither staging nor the fact is searched for what is missing.  A run that dies between the two writes
    leaves loaded commits waiting, and the next load changes nothing by taking them again."""
    pending, names = wh.read(S.STG_COMMITS_PENDING.name), wh.read(S.STG_REPOS.name)
    wh.append_changes(S.FACT_COMMITS.name, load_fact(wh.read(S.FACT_COMMITS.name), pending, names, as_of,
                                                     before=BEFORE))
    known = names.select(F.col("full_name").alias("repo_full_name"))
    wh.replace(S.STG_COMMITS_PENDING.name, pending.join(known, "repo_full_name", "left_anti"))
    advance_by_repo(wh)


def advance_marks_delta(wh: Warehouse, as_of: _dt.datetime, marks_pipeline: str = S.MARKS_PIPELINE) -> None:
    """Marks from the fact's summary per repository; only marks that moved are written."""
    wh.append_changes(S.ETL_WATERMARK.name, advance_watermark(
        wh.read(S.ETL_WATERMARK.name), repo_facts(wh), wh.read(S.DIM_REPOSITORY.name), as_of,
        pipeline=marks_pipeline, changes_only=True))


def apply_commit_batch(wh: Warehouse, batch: DataFrame, as_of: _dt.datetime,
                       marks_pipeline: str = S.MARKS_PIPELINE) -> None:
    """One micro-batch of raw commit rows -> change rows of staging, fact and marks."""
    stage_commit_delta(wh, batch, as_of)
    load_fact_delta(wh, as_of)
    advance_marks_delta(wh, as_of, marks_pipeline)


def stream_commits(spark: SparkSession, wh: Warehouse, checkpoint: str, *,
                   clock: Callable[[], _dt.datetime] = _now,
                   max_files_per_trigger: int | None = None,
                   keep_versions: int | None = 2) -> int:
    """Process every raw commit file not seen yet (available-now), return the micro-batch count.

    After each micro-batch long lines of change sets are folded, and the tables it changed keep only their
    newest ``keep_versions`` states.
    """
    reader = spark.readStream.schema(RAW_STREAM_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(f"{wh.root}/{S.RAW_COMMITS.name}/data")
    batches = []

    def each(df: DataFrame, epoch: int) -> None:
        batches.append(epoch)
        apply_commit_batch(wh, df, clock())
        if keep_versions is not None:
            for name in DELTA_TABLES:
                wh.fold(name)
                wh.vacuum(name, keep=keep_versions)

    q = (src.writeStream.foreachBatch(each)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return len(batches)


def stream_marks(spark: SparkSession, raw_dir: str, marks_path_wh: Warehouse, checkpoint: str, *,
                 table: str = "stream_marks", clock: Callable[[], _dt.datetime] = _now,
                 pipeline: str = S.MARKS_PIPELINE) -> None:
    """Running ``max(committed_at)`` per repository over landed raw commits, stateful."""
    src = spark.readStream.schema(RAW_STREAM_SCHEMA).parquet(raw_dir)
    rows = flatten(src, S.COMMIT_FIELDS, keep=["repo_full_name"], key_path=S.COMMIT_KEY_PATH)
    running = rows.groupBy(F.col("repo_full_name").alias("entity_name")).agg(
        F.max("committed_at").alias("watermark_ts"))
    specs = dict(marks_path_wh.specs)
    specs.setdefault(table, S.TableSpec(table, S.ETL_WATERMARK.schema,
                                        keys=S.ETL_WATERMARK.keys,
                                        not_null=S.ETL_WATERMARK.not_null))
    marks_path_wh.specs = specs

    def each(df: DataFrame, epoch: int) -> None:
        stamp = as_of_col(clock())
        # the stateful aggregate runs once: everything below reads its stored result
        new = materialize(df).select(F.lit(pipeline).alias("pipeline_name"), "entity_name", "watermark_ts")
        marks_path_wh.replace(table, upsert(
            marks_path_wh.read(table), new, ["pipeline_name", "entity_name"], ["watermark_ts"],
            on_update={"updated_at": stamp}, on_insert={"updated_at": stamp}, assume_unique=True))

    q = (running.writeStream.outputMode("update").foreachBatch(each)
                .option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()

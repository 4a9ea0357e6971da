"""What a run knows of the runs before it: which landed batches are staged (L10), and how many rows the layers
hold (R4)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.upsert import upsert
from ..sources.raw import as_of_col
from ..sources.warehouse import APPEND_ONLY, Warehouse

_EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
_TICK = _dt.timedelta(microseconds=1)


def _instant(micros: int | None) -> _dt.datetime | None:
    return None if micros is None else _EPOCH + _dt.timedelta(microseconds=micros)


class Ledger:
    """Staged batches of the raw tables, by table, scope and batch.

    Every batch ingested up to a table's mark is staged.  While batches of some scope wait, the batches staged
    beyond the mark are listed one by one; once none waits, the mark passes them all and the list ends.  So
    the list holds what lies between the oldest waiting batch and now, and only where runs have scopes.
    The mark and the list are written after the staging commit: a run that dies between them stages its
    batches again, which changes nothing.
    """

    def __init__(self, wh: Warehouse):
        self.wh = wh
        self.marks: dict[str, _dt.datetime | None] = {}

    def mark(self, table: str) -> _dt.datetime | None:
        if table not in self.marks:
            row = (self.wh.read(S.ETL_STAGING_MARK.name).where(F.col("table_name") == table)
                       .agg(F.max(F.unix_micros("staged_upto"))).first())
            self.marks[table] = _instant(row[0])
        return self.marks[table]

    def _set_mark(self, table: str, upto: _dt.datetime) -> None:
        row = self.wh.spark.range(1).select(F.lit(table).alias("table_name"),
                                            as_of_col(upto).alias("staged_upto"))
        self.wh.replace(S.ETL_STAGING_MARK.name, upsert(
            self.wh.read(S.ETL_STAGING_MARK.name), row, ["table_name"], assume_unique=True,
            strategy="broadcast"))
        self.marks[table] = upto

    def before_landing(self, table: str, as_of: _dt.datetime) -> None:
        """A landing at or before the mark (a rerun) would count as staged: take the mark back first, and
        strike what the list holds of that time."""
        mark = self.mark(table)
        if mark is not None and mark >= as_of:
            self._set_mark(table, as_of - _TICK)
        name = S.ETL_STAGED_BATCH.name
        if self.wh.versions(name):
            again = (F.col("table_name") == table) & (F.col("ingested_at") == as_of_col(as_of))
            if self.wh.read(name).where(again).limit(1).count():
                self.wh.replace(name, self.wh.read(name).where(~again))

    def open_batches(self, table: str) -> DataFrame:
        """Raw rows beyond the mark; older ingest-date directories are pruned at the scan."""
        raw, mark = self.wh.read(table), self.mark(table)
        if mark is None or "ingest_date" not in raw.columns:
            return raw
        return raw.where((F.col("ingest_date") >= F.to_date(as_of_col(mark)))
                         & (F.col("ingested_at") > as_of_col(mark)))

    def staged(self, table: str) -> DataFrame | None:
        """``org_or_user, batch_id`` of the batches listed as staged; None without any."""
        if not self.wh.versions(S.ETL_STAGED_BATCH.name):
            return None
        return (self.wh.read(S.ETL_STAGED_BATCH.name).where(F.col("table_name") == table)
                .select("org_or_user", "batch_id"))

    def unstaged(self, table: str) -> DataFrame:
        """Raw rows of the batches that no run has staged."""
        rows, staged = self.open_batches(table), self.staged(table)
        return rows if staged is None else rows.join(staged, ["org_or_user", "batch_id"], "left_anti")

    def close(self, table: str, as_of: _dt.datetime, scope: str | None = None) -> None:
        """The batches of ``scope`` (of all scopes when None) landed so far are staged now."""
        mark, name = self.mark(table), S.ETL_STAGED_BATCH.name
        if scope is not None:
            batches = self.unstaged(table).select("org_or_user", "batch_id", "ingested_at").distinct()
            self.wh.append_changes(name, batches.where(F.col("org_or_user") == scope).select(
                F.lit(table).alias("table_name"), "org_or_user", "batch_id", "ingested_at",
                F.lit("I").alias("_op")))
            waits = _instant(self.unstaged(table).agg(F.min(F.unix_micros("ingested_at"))).first()[0])
            if waits is not None:
                upto = waits - _TICK
                if mark is None or upto > mark:
                    self._set_mark(table, upto)
                return
        self._set_mark(table, as_of if mark is None else max(mark, as_of))
        if self.wh.versions(name) and self.wh.rows(name):
            self.wh.replace(name, self.wh.read(name).where(F.col("table_name") != table))


def recall_rows(wh: Warehouse) -> None:
    """The row counts that earlier runs left, for the tables that no one has written since."""
    for r in wh.read(S.ETL_TABLE_ROWS.name).collect():  # a row per table
        if r.table_name not in APPEND_ONLY:
            wh.known_rows.setdefault(r.table_name, (r.version, r.n_rows))


def _batches(wh: Warehouse, table: str, before: dict) -> tuple[int, _dt.datetime | None, int]:
    """Batches landed in a raw table, the newest landing time and its batches: those carried, and those
    that landed at or after the newest time carried, whose ingest-date directories alone are read."""
    raw, known = wh.read(table), before.get(table)
    since = known.landed_at if known is not None else None
    if since is not None and "ingest_date" in raw.columns:
        raw = raw.where((F.col("ingest_date") >= F.to_date(F.lit(since))) & (F.col("ingested_at") >= F.lit(since)))
    # chunks of one batch share batch_id; a row per landing time comes back
    times = raw.groupBy("ingested_at").agg(F.count_distinct("batch_id").alias("n")).orderBy("ingested_at").collect()
    carried = known.n_rows - known.n_landed if since is not None else 0
    if not times:
        return carried + (known.n_landed if known is not None else 0), since, known.n_landed if known else 0
    return carried + sum(t.n for t in times), times[-1].ingested_at, times[-1].n


#: Run-log columns and the tables whose rows (batches, for raw tables) they hold.
METRICS = {"raw_repos_batches": S.RAW_REPOS, "raw_commits_batches": S.RAW_COMMITS,
           "stg_repos_rows": S.STG_REPOS, "stg_commits_rows": S.STG_COMMITS,
           "dim_repository_rows": S.DIM_REPOSITORY, "fact_commits_rows": S.FACT_COMMITS}


def layer_rows(wh: Warehouse) -> dict[str, int]:
    """The run log's counts, without a scan of a table that this or an earlier run counted while
    writing it; kept for the next run."""
    before = {r.table_name: r for r in wh.read(S.ETL_TABLE_ROWS.name).collect()}
    counts, rows = {}, []
    for column, spec in METRICS.items():
        if spec.name in APPEND_ONLY:
            n, landed_at, n_landed = _batches(wh, spec.name, before)
            rows.append((spec.name, 0, n, landed_at, n_landed))
        else:
            n = wh.rows(spec.name)
            rows.append((spec.name, (wh.versions(spec.name) or [0])[-1], n, None, None))
        counts[column] = n
    wh.replace(S.ETL_TABLE_ROWS.name, wh.spark.createDataFrame(rows, S.ETL_TABLE_ROWS.schema))
    return counts

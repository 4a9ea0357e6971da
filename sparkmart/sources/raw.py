"""Raw layer: land record batches as JSON-array payloads.

A batch is one extraction of one scope (an organisation, or one entity such as a repository): a row
``(ingested_at, source, <scope columns>, batch_id, chunk, payload)`` whose payload is a JSON array of
records.
Records are grouped set-wise for all scopes at once.  A hot scope must not become one giant row built by
one task, so a scope with ``n`` records is cut into ``ceil(n / chunk_size)`` chunks by a hash of the
record's key; the chunks share ``ingested_at`` and ``batch_id`` and are numbered by ``chunk``,
so counting batches means counting distinct ``batch_id``.  All records of one key are in one chunk, in
the batch's order, so "the last element of the batch wins" gives one answer for every chunk size and
however the chunk files are split over micro-batches.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import ISO_MICROS, parse_payload, payload_size
from ..schemas import DEFAULT_SOURCE

CHUNK_SIZE = 1000
SALTS = 32  # parts into which the records of an oversized scope are dealt for the lookup of its size


def as_of_col(as_of: _dt.datetime | str | Column) -> Column:
    """A run's timestamp as a literal column (``NOW()`` fixed once per run, so reruns are repeatable)."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    if isinstance(as_of, _dt.datetime) and as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=_dt.timezone.utc)
    return F.lit(as_of).cast("timestamp")


def pack_batches(
    records: DataFrame,
    scope_cols: Sequence[str],
    record: Column,
    order_by: Sequence[str | Column],
    as_of: _dt.datetime | str | Column,
    *,
    key: Sequence[str | Column] = (),
    scopes: DataFrame | None = None,
    chunk_size: int = CHUNK_SIZE,
    source: str = DEFAULT_SOURCE,
) -> DataFrame:
    """Group records into raw batches, one per scope (more when a scope exceeds ``chunk_size``).

    * ``record``: struct column that becomes one JSON object (build time fields with ``iso_utc``);
    * ``order_by``: element order inside a payload (page order);
    * ``key``: what identifies a record; records of one key stay in one chunk.  Without it every
      record is its own key, which suits records whose keys don't repeat inside a batch;
    * a NULL in a scope column raises (the raw tables declare it NOT NULL);
    * ``scopes``: when given, every scope in it gets a batch, an empty ``[]`` one if it has no records
      (the reference writes a row per repository even when nothing new was found).
    """
    scope_cols = list(scope_cols)
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])
    by = [F.col(c) if isinstance(c, str) else c for c in key] or [record]

    def named(c: str) -> Column:
        return F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NULL in scope column {c}"))
                      ).otherwise(F.col(c)).alias(c)

    rec = records.select(*[named(c) for c in scope_cols], order.alias("_o"), record.alias("_r"),
                         F.xxhash64(*by).alias("_h"))
    # records per scope: a partial+final aggregate, tiny output (one row per scope)
    counts = rec.groupBy(*scope_cols).agg(F.count(F.lit(1)).alias("_n"))
    # only scopes above the chunk size (at most n / chunk_size of them) are looked up; each comes once
    # per salt, so the records of a hot scope are dealt to that many tasks
    big = counts.where(F.col("_n") > chunk_size).select(
        *scope_cols, F.ceil(F.col("_n") / F.lit(chunk_size)).cast("long").alias("_chunks"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    rec = (rec.withColumn("_salt", F.pmod(F.col("_h"), F.lit(SALTS)).cast("int"))
              .join(big, [*scope_cols, "_salt"], "left")
              .withColumn("_chunk", F.coalesce(F.pmod(F.xxhash64("_h"), F.col("_chunks")), F.lit(0))))
    grouped = (rec.groupBy(*scope_cols, "_chunk")
                  .agg(F.sort_array(F.collect_list(F.struct("_o", "_r"))).alias("_items"))
                  .select(*scope_cols, "_chunk", F.to_json(F.col("_items._r")).alias("_text")))
    if scopes is not None:
        # scopes without records: anti join with the per-scope counts (one small row per scope),
        # not with the grouped payloads, which would be aggregated a second time
        empty = (scopes.select(*scope_cols).distinct()
                       .join(counts.select(*scope_cols), scope_cols, "left_anti")
                       .select(*scope_cols, F.lit(0).cast("long").alias("_chunk"),
                               F.lit("[]").alias("_text")))
        grouped = grouped.unionByName(empty)
    ts = as_of_col(as_of)
    # "/" inside a scope value is escaped, so different scopes never share an id
    parts = [F.replace(F.replace(F.col(c).cast("string"), F.lit("%"), F.lit("%25")), F.lit("/"),
                       F.lit("%2F")) for c in scope_cols]
    batch_id = F.concat_ws("/", *parts, F.date_format(ts, ISO_MICROS))
    return grouped.select(
        ts.alias("ingested_at"),
        F.lit(source).alias("source"),
        *scope_cols,
        batch_id.alias("batch_id"),
        F.col("_chunk").cast("int").alias("chunk"),
        parse_payload("_text").alias("payload"),
    )


def batch_stats(raw: DataFrame, scope_cols: Sequence[str]) -> DataFrame:
    """Batches (distinct ``batch_id``, chunks of one batch count once) and records per scope
    (``{"org","count"}`` / ``total_commits``)."""
    return (raw.groupBy(*scope_cols)
               .agg(F.count_distinct("batch_id").alias("batches"),
                    F.sum(payload_size("payload")).cast("long").alias("records")))

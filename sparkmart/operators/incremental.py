"""Per-entity high-water marks (I1-I4): read the mark, read only what is new, advance the mark after
the fact load, pick the entities of a run.

The marks table is ``(pipeline_name, entity_name, watermark_ts, updated_at)``.  All functions work on
every entity at once; nothing loops over entities on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.frames import row_salt
from ..sources.raw import as_of_col
from .dedup import top_k
from .upsert import upsert

SALTS_A_TASK = 8  # parts of a mean task's rows into which an entity of more rows is dealt


def default_since(as_of, lookback: str = S.DEFAULT_LOOKBACK) -> Column:
    """``now`` truncated to the second, minus the look-back (7 days)."""
    return F.date_trunc("second", as_of_col(as_of)) - F.expr(f"INTERVAL {lookback}")


def resolve_since(
    entities: DataFrame,
    marks: DataFrame,
    as_of,
    *,
    pipeline: str = S.MARKS_PIPELINE,
    entity_col: str = "entity_name",
    lookback: str = S.DEFAULT_LOOKBACK,
) -> DataFrame:
    """``(entity, since)`` for every entity; a missing or NULL mark falls back to the look-back."""
    m = (marks.where(F.col("pipeline_name") == F.lit(pipeline))
              .select(F.col("entity_name").alias(entity_col), "watermark_ts"))
    ents = entities.select(entity_col).distinct()
    return (ents.join(m, entity_col, "left")
                .select(entity_col, F.coalesce(F.col("watermark_ts").cast("timestamp"),
                                               default_since(as_of, lookback)).alias("since")))


def filter_incremental(
    records: DataFrame,
    since: DataFrame,
    *,
    entity_col: str,
    ts_col: str,
    inclusive: bool = True,
) -> DataFrame:
    """Records of the listed entities at or after their mark.

    Inclusive by default: the mark's own instant is re-read (at-least-once); the keyed upsert absorbs
    the re-read.  The marks side has one row per entity; the join strategy is left to AQE, which knows
    its size at run time.

    Entities with more records than a mean task are counted first, on the entity column alone.  With P
    shuffle partitions there are fewer than P of them, so this list is broadcast.  The records of such an
    entity are dealt to as many salts as make each a ``1 / SALTS_A_TASK`` of a mean task, and its mark is
    repeated for each salt (fewer than P * (SALTS_A_TASK + 1) rows in all).  No task then gets an entity
    whole.
    """
    spark = records.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = records.groupBy(F.col(entity_col).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    hot = (counts.where(F.col("_hot").isNotNull() & (F.col("_n") * tasks > total))
                 .select("_hot", F.ceil(F.col("_n") * tasks * SALTS_A_TASK / total).cast("int").alias("_salts")))
    s = (since.select(F.col(entity_col).alias("_ent"), F.col("since").alias("_since"))
              .join(F.broadcast(hot), F.col("_ent") == F.col("_hot"), "left")
              .select("_ent", "_since", F.explode(F.sequence(
                  F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias("_part")))
    dealt = (records.join(F.broadcast(hot), F.col(entity_col) == F.col("_hot"), "left")
                    .withColumn("_salt", F.when(F.col("_salts").isNull(), 0)
                                .otherwise(row_salt(records, F.col("_salts")))))
    j = dealt.join(s, (F.col(entity_col) == F.col("_ent")) & (F.col("_salt") == F.col("_part")), "inner")
    ts = F.col(ts_col).cast("timestamp")
    cond = ts >= F.col("_since") if inclusive else ts > F.col("_since")
    return j.where(cond).select(*records.columns)


def cap_oldest(records: DataFrame, *, entity_col: str, ts_col: str, cap: int,
               tie_cols: Sequence[str] = ()) -> DataFrame:
    """Optional per-entity cap that never skips data: keep the *oldest* ``cap`` rows since the mark
    (ties at the boundary included), so the mark advanced from them cannot pass unread rows.

    ``rank() <= cap`` is planned as a partial ``WindowGroupLimit`` before the shuffle, so a hot
    entity sends at most ``cap`` rows (plus ties) per map task (for caps up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``, raised by ``session.get_session``).
    """
    w = Window.partitionBy(entity_col).orderBy(F.col(ts_col).asc(), *[F.col(c) for c in tie_cols])
    return records.withColumn("_rk", F.rank().over(w)).where(F.col("_rk") <= cap).drop("_rk")


def compute_marks(
    fact: DataFrame,
    dim: DataFrame,
    *,
    fact_id_col: str = "repo_id",
    dim_id_col: str = "repo_id",
    dim_name_col: str = "full_name",
    ts_col: str = "committed_at",
    entity_col: str = "entity_name",
    mark_col: str = "watermark_ts",
) -> DataFrame:
    """``max(fact.ts)`` per dimension name through ``fact.id = dim.id`` (J2 + A2).

    Aggregated below the join by hand (Catalyst does not push it): max per id on the fact first
    (partial aggregation map-side, one row per id), then the join on ids, then max per name (names may
    repeat across ids; max composes, so the result equals the join-then-aggregate form).
    """
    per_id = fact.groupBy(F.col(fact_id_col).alias("_id")).agg(F.max(ts_col).alias("_m"))
    names = dim.select(F.col(dim_id_col).alias("_id"), F.col(dim_name_col).alias(entity_col))
    return (per_id.join(names, "_id", "inner")
                  .groupBy(entity_col).agg(F.max("_m").alias(mark_col)))


def advance_watermark(
    marks: DataFrame,
    fact: DataFrame,
    dim: DataFrame,
    as_of,
    *,
    pipeline: str = S.MARKS_PIPELINE,
    monotone: bool = False,
    changes_only: bool = False,
    **mark_kw,
) -> DataFrame:
    """Marks recomputed from the whole fact after a successful load, upserted per entity.

    As in the reference the new value overwrites (it can go down, or to NULL); ``monotone=True``
    keeps the greatest of old and new instead.  Entities no longer in the dimension keep their row.
    The maximum per repository may stand in for the fact (``operators.rollup.repo_facts``).
    ``changes_only`` gives the marks that are new or moved (with ``_op``).
    """
    new = compute_marks(fact, dim, **mark_kw).select(
        F.lit(pipeline).alias("pipeline_name"), "entity_name", "watermark_ts")
    if monotone:
        old = marks.select("pipeline_name", "entity_name", F.col("watermark_ts").alias("_old"))
        new = (new.join(old, ["pipeline_name", "entity_name"], "left")
                  .select("pipeline_name", "entity_name",
                          F.greatest("watermark_ts", "_old").alias("watermark_ts")))
    stamp = as_of_col(as_of)
    return upsert(marks, new, ["pipeline_name", "entity_name"], ["watermark_ts"],
                  on_update={"updated_at": stamp}, on_insert={"updated_at": stamp},
                  assume_unique=True, changes_only=changes_only, skip_equal=changes_only,
                  before=() if changes_only else None)


def select_entities(staging: DataFrame, k: int | None = 10, *, name_col: str = "full_name",
                    order_col: str = "pushed_at", key_col: str = "repo_id") -> DataFrame:
    """I4: the ``k`` most recently pushed entities (NULLs last, key as tie-break); all when ``k`` is
    None (the set-wise read has no reason to cap)."""
    if k is None:
        return staging.select(name_col)
    return top_k(staging, [F.col(order_col).desc_nulls_last(), F.col(key_col).asc()], k).select(
        name_col)

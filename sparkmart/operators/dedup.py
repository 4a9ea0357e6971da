"""Latest-row selection: per key (W1), latest batch per scope (O1), top-k (O2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.frames import row_salt

FILTER_BITS = 1 << 27  # 16 MB
BATCH_SALTS = 16


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key under ``order_by`` (``DISTINCT ON (k) ... ORDER BY k, ...``).

    ``order_by`` should be a total order within a key (add tie-breakers), so the result is repeatable.
    ``row_number() = 1`` is planned as ``WindowGroupLimit`` Partial before the shuffle and Final after:
    every map task forwards at most one row per key, so a key repeated in a third of the input costs no
    more in the reduce task than a normal one.
    """
    w = Window.partitionBy(*keys).orderBy(*_cols(order_by))
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1)
              .drop("_rn"))


def latest_batch(raw: DataFrame, scope_cols: Sequence[str], ts_col: str = "ingested_at",
                 scope_filter: Column | None = None) -> DataFrame:
    """Rows of the newest batch per scope, all of its chunks (``ORDER BY ingested_at DESC LIMIT 1``).

    ``max(ts)`` per scope is read from the scope and time columns alone (partial aggregation, one small row
    per scope).  The hashes of these rows set bits in a map of ``FILTER_BITS`` bits, broadcast in pieces of
    4 KB (16 MB at most, however many scopes there are).  A payload row whose bit is not set is dropped where
    it is scanned: only newest batches, and of older ones a share of about scopes / ``FILTER_BITS``, go on to
    the exact join, which deals the rows of one batch to ``BATCH_SALTS`` tasks.  ``scope_filter`` (e.g.
    ``col('org_or_user') == 'apache'``) is applied first and reaches the parquet scan.  Rows with a NULL
    scope or time are in no batch.
    """
    if scope_filter is not None:
        raw = raw.where(scope_filter)
    keys = [*scope_cols, ts_col]
    newest = raw.groupBy(*scope_cols).agg(F.max(ts_col).alias(ts_col))
    place = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    bits = (newest.groupBy(F.bitmap_bucket_number(place).alias("_bucket"))
                  .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    near = (raw.withColumn("_bucket", F.bitmap_bucket_number(place))
               .join(F.broadcast(bits), "_bucket")
               .where(F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1)
               .withColumn("_salt", row_salt(raw, BATCH_SALTS)))
    # an inner join on unique keys: a semi join would be pushed below the filter by bits
    dealt = newest.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(BATCH_SALTS - 1))))
    return near.join(dealt, [*keys, "_salt"]).select(*raw.columns)


def top_k(df: DataFrame, order_by: Sequence[str | Column], k: int) -> DataFrame:
    """First ``k`` rows under ``order_by`` (planned as ``TakeOrderedAndProject``: per-partition top-k,
    then one merge of at most ``k`` rows per partition)."""
    return df.orderBy(*_cols(order_by)).limit(k)

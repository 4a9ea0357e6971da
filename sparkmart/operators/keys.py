"""Surrogate keys for new rows (L6, the reference's ``BIGSERIAL``).

Dense, unique and repeatable, from prefix sums over range partitions:

1. the natural keys alone (no other column) are stored, so the source is evaluated once;
2. they are dealt to range partitions and sorted inside them; each row then knows its partition and its
   place there without a window, and the result is stored;
3. rows are counted per partition and summed up: one small row per partition gives its start;
4. key = base + start(partition) + place; the numbers join back on the natural keys.

The number of partitions follows the session's shuffle partitions and AQE, and the natural keys are unique, so
no partition can grow from a repeated key.  The numbering follows the order of the natural keys, whatever
the partitions were.  Keys of existing rows never change; one writer per table is assumed, as with a
sequence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_PLACE = (1 << 33) - 1  # monotonically_increasing_id(): the partition above 33 bits, the row below


def _base(start_after: int | Column | DataFrame, key_col: str) -> Column:
    """The key to count from, as a literal or an uncorrelated scalar subquery (no join needed)."""
    if isinstance(start_after, DataFrame):
        return start_after.agg(F.coalesce(F.max(key_col), F.lit(0)).cast("long")).scalar()
    if isinstance(start_after, Column):
        return start_after.cast("long")
    return F.lit(int(start_after)).cast("long")


def number_keys(keys: DataFrame, key_col: str, start_after: int | Column | DataFrame = 0) -> DataFrame:
    """The rows of ``keys`` (unique) with ``key_col`` = ``start_after`` + 1, + 2, ... in their order."""
    nat = keys.columns
    if any(c in ("_id", "_part") for c in nat):
        raise ValueError("_id and _part are names of the numbering")
    placed = materialize(materialize(keys).repartitionByRange(*nat).sortWithinPartitions(*nat)
                         .withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_id", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row per partition
              .select("_part", (_base(start_after, key_col)
                                + F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_start")))
    return placed.join(F.broadcast(starts), "_part").select(
        *nat, (F.col("_start") + F.col("_id").bitwiseAND(F.lit(_PLACE)) + 1).cast("long").alias(key_col))


def assign_keys(
    df: DataFrame,
    key_col: str,
    natural_keys: Sequence[str],
    start_after: int | Column | DataFrame = 0,
) -> DataFrame:
    """Add ``key_col`` = ``start_after`` + 1, + 2, ... over the rows of ``df``.

    ``start_after`` may be a number, or the existing table (its ``max(key_col)`` is used, 0 if empty).
    ``natural_keys`` must be unique and not NULL in ``df``; they fix the numbering, so a rerun gives the same
    keys.
    """
    nat = list(natural_keys)
    numbers = number_keys(df.select(*nat), key_col, start_after)
    return numbers.select(*df.columns, key_col) if set(nat) == set(df.columns) else df.join(numbers, nat)

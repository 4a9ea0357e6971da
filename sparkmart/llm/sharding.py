"""Contiguous byte-balanced shards from global prefix sums (operator 2).

Documents are put in the order of their id.  Each range partition sums its own bytes and rows; the
prefix sums over those few totals give every partition the global position at which it starts, and a
running sum inside the partition gives each document its own.  A document belongs to the shard in
whose equal share of all bytes its middle byte falls, so a shard differs from the target by less than
the size of one document at each end.

Cases: a null text has no bytes (size 1, CRC 0); a null id sorts first; repeated ids are ordered by
checksum and size, and rows equal in all three are interchangeable; no rows give no rows.  Only the
named id and text columns are read, so further columns, whatever their names, play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, store


def utf8_size(text: Column) -> Column:
    """Bytes that a document takes in a shard: its text in UTF-8 and one separator."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard_by_bytes(docs: DataFrame, n_shards: int = 16, *, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, size, text_crc32, law, shard, slot, grown_shard``.

    ``slot`` counts from 0 without gaps inside a shard, in id order.  Texts are reduced to size and
    checksum in the scan, so shuffles carry about 30 bytes a document.  ``tie`` splits rows that are
    equal in every key, so that many repeated rows do not meet in one range; once stored it is fixed.
    """
    spark = docs.sparkSession
    sized = docs.select(
        F.col(id_col).alias("id"), utf8_size(F.col(text_col)).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("crc"),
        F.rand(17).alias("tie"))
    order = ["id", "crc", "size", "tie"]
    ranged = store(sized.repartitionByRange(shuffle_partitions(spark), *order)
                   .withColumn("part", F.spark_partition_id()), "shard-ranges")

    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding,
                                                    Window.unboundedFollowing)
    starts = totals.select(  # one row per range partition
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte0"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("row0"),
        F.sum("bytes").over(everything).alias("all_bytes"))

    inside = Window.partitionBy("part").orderBy(*order)
    placed = ranged.select(
        "part", "id", "size", "crc",
        F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.row_number().over(inside).alias("nth"))
    placed = placed.join(F.broadcast(starts), "part").select(
        "id", "size", "crc", (F.col("row0") + F.col("nth") - 1).alias("row"),
        F.expr(f"cast((2 * (byte0 + upto) - size) * {n_shards} div (2 * all_bytes) as int)")
        .alias("shard"))
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first_row"))  # n_shards rows
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("first_row")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))

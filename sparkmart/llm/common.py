"""Helpers shared by the operators: stored intermediate tables and the partition count."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.session import checkpoint_root


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and return the table read back.

    Later plans then start from files that every executor can read, so a lost executor never forces
    the upstream work again and non-deterministic columns (partition numbers) are fixed once.
    """
    path = f"{checkpoint_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``, the row's place from 0 in the order of the columns ``order``.

    Range partitions number their own rows and start at the sum of the rows before them, so no task
    sorts more than a range.  Rows equal in all of ``order`` are placed in any order.
    """
    ranged = store(df.repartitionByRange(shuffle_partitions(df.sparkSession), *order)
                   .withColumn("_part", F.spark_partition_id()), "numbered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_part").agg(F.count("*").alias("_n")).select(  # a row per partition
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return (ranged.withColumn("_nth", F.row_number().over(inside)).join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_start") + F.col("_nth") - 1).drop("_part", "_nth", "_start"))

"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def to_ntz(df: DataFrame) -> DataFrame:
    """Cast every zone-aware timestamp column to ``timestamp_ntz`` (UTC wall clock).

    Library tables keep ``timestamp`` like the reference's ``timestamptz``; the driver's tables and
    DuckDB's oracle results are zone-less, so results handed to them are converted at the edge.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame that the optimizer knows to be empty, so that joins with it fall away."""
    return spark.range(1).where(F.lit(False)).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def row_salt(df: DataFrame, salts: int | Column) -> Column:
    """A number from 0 to ``salts`` - 1 by the row's values (numbers, texts, times), the same in every run
    of a task."""
    plain = [c for c, t in df.dtypes if not t.startswith(("array", "map", "struct", "variant"))]
    n = salts if isinstance(salts, Column) else F.lit(salts)
    return F.pmod(F.xxhash64(*plain), n).cast("int")

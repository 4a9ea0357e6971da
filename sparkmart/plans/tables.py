"""Readers for the input tables and the empty warehouse tables used by in-memory plans."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as S
from ..functions.frames import no_rows

# Run timestamps of the reproducible plans: two daily extraction runs.
RUN1 = _dt.datetime(2024, 2, 1, tzinfo=_dt.timezone.utc)
RUN2 = _dt.datetime(2024, 2, 2, tzinfo=_dt.timezone.utc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a scale-factor folder (``<sf_dir>/<name>.parquet``).

    The library's time logic assumes a UTC session zone (zone-less test times are read as UTC and
    written to JSON with a ``Z``); it is pinned here because callers may hand over any session.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def empty(spark: SparkSession, spec: S.TableSpec) -> DataFrame:
    return no_rows(spark, spec.schema)

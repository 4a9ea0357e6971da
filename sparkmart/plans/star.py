"""The warehouse of the reference built in memory from the driver tables (no storage).

``build_star`` runs the daily load twice over the TPC-H-like tables, as two extraction runs whose
commit windows overlap (so the same order arrives in two raw batches and the dedup has work to do):

* run 1 (``RUN1``): every customer as a repository, orders dated before ``SPLIT_LATE``;
* run 2 (``RUN2``): every customer again, orders dated on or after ``SPLIT_EARLY``.

Together the runs cover every order; the overlap year is landed twice.  Each layer is returned as a
DataFrame; ``plans.pipeline`` does the same with a persistent ``Warehouse``.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.incremental import advance_watermark
from ..operators.loads import load_dimension_scd1, load_fact, stage_all_batches, stage_latest_batch
from ..session import materialize
from ..sources.landing import land_commits, land_repos
from .tables import RUN1, RUN2, empty, table

SPLIT_EARLY = _dt.datetime(1997, 1, 1)
SPLIT_LATE = _dt.datetime(1998, 1, 1)


@dataclass
class Star:
    raw_repos: DataFrame
    raw_commits: DataFrame
    stg_repos: DataFrame
    stg_commits: DataFrame
    dim: DataFrame
    fact: DataFrame
    marks: DataFrame


def land_two_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw repository and commit batches of the two overlapping runs."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    orders = table(spark, sf_dir, "orders")
    raw_repos = (land_repos(customer, nation, orders, RUN1)
                 .unionByName(land_repos(customer, nation, orders, RUN2)))
    early = orders.where(F.col("o_orderdate") < F.lit(SPLIT_LATE))
    late = orders.where(F.col("o_orderdate") >= F.lit(SPLIT_EARLY))
    raw_commits = (land_commits(early, customer, RUN1)
                   .unionByName(land_commits(late, customer, RUN2)))
    return raw_repos, raw_commits


def build_star(spark: SparkSession, sf_dir: str, as_of: _dt.datetime = RUN2) -> Star:
    raw_repos, raw_commits = land_two_runs(spark, sf_dir)
    raw_repos, raw_commits = materialize(raw_repos), materialize(raw_commits)
    stg_repos = materialize(
        stage_latest_batch(empty(spark, S.STG_REPOS), raw_repos, as_of, scope=None))
    stg_commits = materialize(stage_all_batches(empty(spark, S.STG_COMMITS), raw_commits, as_of))
    dim = materialize(load_dimension_scd1(empty(spark, S.DIM_REPOSITORY), stg_repos, as_of))
    fact = materialize(load_fact(empty(spark, S.FACT_COMMITS), stg_commits, stg_repos, as_of))
    marks = advance_watermark(empty(spark, S.ETL_WATERMARK), fact, dim, as_of)
    return Star(raw_repos, raw_commits, stg_repos, stg_commits, dim, fact, marks)

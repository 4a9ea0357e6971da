"""Summaries of the fact that follow its change rows (I3, Q1-Q3, D1) instead of scanning it.

A change row says what a commit is now and, for an update, which repository and time it had before.  It adds
one where it is and takes one from where it was; a row that stayed where it was adds nothing.  Counts are
sums of these, so a load costs its own rows and the groups that they touch.

A group's newest time needs more care: it falls when its newest commit moved away or back in time.  Only
groups that lost a row at or above every time they are known to keep are computed from the fact again.

Every row carries the fact version that it reflects; the newest of them is where the summary stands.  A
summary that stands behind a whole version of the fact (a full run, or rows written by others) is built anew.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import materialize
from ..sources.warehouse import Warehouse

#: What change rows of the fact must tell about the row before.
BEFORE = ("repo_id", "committed_at")


def _by_repo(prefix: str) -> dict[str, Column]:
    return {"repo_id": F.col(f"{prefix}repo_id")}


def _by_month(prefix: str) -> dict[str, Column]:
    return {"repo_id": F.col(f"{prefix}repo_id"),
            "month_start": F.date_trunc("month", F.col(f"{prefix}committed_at"))}


def contributions(changes: DataFrame, group: Callable[[str], Mapping[str, Column]]) -> DataFrame:
    """``<group>, sign, ts``: a row added and a row taken for each commit that came or moved."""
    stayed = ((F.col("_op") == "U") & F.col("repo_id").eqNullSafe(F.col("_old_repo_id"))
              & F.col("committed_at").eqNullSafe(F.col("_old_committed_at")))
    now, was = group(""), group("_old_")
    signed = changes.where(~stayed).select(F.explode(F.filter(F.array(
        F.struct(*[c.alias(k) for k, c in now.items()], F.lit(1).alias("sign"), F.col("committed_at").alias("ts")),
        F.when(F.col("_op") == "U", F.struct(*[c.alias(k) for k, c in was.items()], F.lit(-1).alias("sign"),
                                             F.col("_old_committed_at").alias("ts")))),
        lambda x: x.isNotNull())).alias("x"))
    return signed.select("x.*")


def summarise(fact: DataFrame, group: Callable[[str], Mapping[str, Column]], newest: str | None,
              version: int) -> DataFrame:
    """The summary of the whole fact."""
    aggs = [F.count(F.lit(1)).alias("n_commits")]
    if newest:
        aggs.append(F.max("committed_at").alias(newest))
    return (fact.groupBy(*[c.alias(k) for k, c in group("").items()]).agg(*aggs)
            .withColumn("fact_version", F.lit(version).cast("long")))


def merge_summary(summary: DataFrame, changes: DataFrame, fact: DataFrame,
                  group: Callable[[str], Mapping[str, Column]], newest: str | None, version: int) -> DataFrame:
    """The groups of ``summary`` that ``changes`` alter, as change rows with ``_op``."""
    keys = list(group(""))
    moved = contributions(changes, group).groupBy(*keys).agg(
        F.sum("sign").alias("_dn"), F.max(F.when(F.col("sign") > 0, F.col("ts"))).alias("_top"),
        F.max(F.when(F.col("sign") < 0, F.col("ts"))).alias("_gone"))
    known = summary.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("n_commits").alias("_n"),
                           *([F.col(newest).alias("_max")] if newest else []))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    merged = moved.join(known, same, "left").select(
        *keys, (F.coalesce(F.col("_n"), F.lit(0)) + F.col("_dn")).cast("long").alias("n_commits"),
        *([F.greatest("_max", "_top").alias(newest),
           ((F.col("_gone") >= F.coalesce("_max", "_gone"))
            & F.coalesce(F.col("_top") <= F.col("_gone"), F.lit(True))).alias("_lowered")] if newest else []),
        F.when(F.col("_n").isNull(), "I").otherwise("U").alias("_op"),
        F.lit(version).cast("long").alias("fact_version"))
    if newest is None:
        return merged
    merged = materialize(merged.withColumn("_lowered", F.coalesce("_lowered", F.lit(False))))
    again = merged.where("_lowered").select(*[F.col(k).alias(f"_a_{k}") for k in keys])
    if again.limit(1).count() == 0:
        return merged.drop("_lowered")
    at = F.lit(True)
    for k, c in group("").items():
        at = at & c.eqNullSafe(F.col(f"_a_{k}"))
    fresh = fact.join(again, at, "left_semi").groupBy(*[c.alias(f"_f_{k}") for k, c in group("").items()]).agg(
        F.max("committed_at").alias("_fresh"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_f_{k}"))
    return merged.join(fresh, on, "left").select(*[
        F.when(F.col("_lowered"), F.col("_fresh")).otherwise(F.col(newest)).alias(newest)
        if c == newest else F.col(c) for c in merged.columns if c != "_lowered"])


def _advance(wh: Warehouse, table: S.TableSpec, group, newest: str | None) -> None:
    states = wh.versions(S.FACT_COMMITS.name)
    if not states:
        return
    stands = wh.read(table.name).agg(F.max("fact_version")).first()[0] if wh.versions(table.name) else None
    if stands == states[-1]:
        return
    fact = wh.read(S.FACT_COMMITS.name)
    changes = None if stands is None else wh.changes(S.FACT_COMMITS.name, stands, BEFORE)
    if changes is None:
        wh.replace(table.name, summarise(fact, group, newest, states[-1]))
    else:
        wh.append_changes(table.name, merge_summary(wh.read(table.name), changes, fact, group, newest,
                                                    states[-1]))


def advance_by_repo(wh: Warehouse) -> None:
    """Bring ``fact_by_repo`` to the current fact."""
    _advance(wh, S.FACT_BY_REPO, _by_repo, "last_committed_at")


def advance_by_month(wh: Warehouse) -> None:
    """Bring ``fact_by_month`` to the current fact."""
    _advance(wh, S.FACT_BY_MONTH, _by_month, None)


def repo_facts(wh: Warehouse) -> DataFrame:
    """``fact_by_repo`` in the fact's own names, for the marks and the checks: a row per repository with its
    number of commits ``n`` and its newest time ``committed_at``."""
    return wh.read(S.FACT_BY_REPO.name).where("n_commits > 0").select(
        "repo_id", F.col("last_committed_at").alias("committed_at"), F.col("n_commits").alias("n"))


def monthly_activity(wh: Warehouse) -> DataFrame:
    """D1 from ``fact_by_month`` and the dimension: ``full_name, month_start, n_commits``."""
    names = wh.read(S.DIM_REPOSITORY.name).select("repo_id", "full_name")
    return (wh.read(S.FACT_BY_MONTH.name).where("n_commits > 0").join(names, "repo_id")
            .groupBy("full_name", "month_start").agg(F.sum("n_commits").cast("long").alias("n_commits")))

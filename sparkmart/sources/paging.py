"""Paged extraction rules over landed records.

The reference pulls pages ``1..max_pages`` of ``per_page`` records and stops at the first empty page
or right after the first short page.  Here pages are rows ``(entity, page, n, ...)`` and the rule is a
running count of short pages *before* each page, per entity: a page is kept when that count is 0, it is
not empty and ``page <= max_pages``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import MAX_PAGES, PER_PAGE


def number_pages(records: DataFrame, entity_col: str, order_by: Sequence[str | Column], *,
                 per_page: int = PER_PAGE, max_pages: int = MAX_PAGES) -> DataFrame:
    """Cut each entity's records, in ``order_by`` order, into pages of ``per_page``; adds ``page``.

    Only the first ``per_page * max_pages`` records of an entity can land on a page the rule keeps,
    so the numbering is a top-k per entity: ``row_number() <= k`` runs as a partial
    ``WindowGroupLimit`` before the shuffle, and a hot entity ships at most ``k`` rows per map task
    (Spark applies it up to ``spark.sql.optimizer.windowGroupLimitThreshold``, raised by
    ``session.get_session``).
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    w = Window.partitionBy(entity_col).orderBy(*order)
    return (records.withColumn("_rn", F.row_number().over(w))
                   .where(F.col("_rn") <= per_page * max_pages)
                   .withColumn("page", (F.floor((F.col("_rn") - 1) / per_page) + 1).cast("int"))
                   .drop("_rn"))


def keep_fetched_pages(pages: DataFrame, entity_col: str, *, page_col: str = "page",
                       size_col: str = "n", per_page: int = PER_PAGE,
                       max_pages: int = MAX_PAGES) -> DataFrame:
    """Pages a paging client would have fetched: stop at the first empty page, or after the first
    page shorter than ``per_page``, never beyond ``max_pages``.  One row per page in, so the window
    sorts page rows, not records."""
    w = (Window.partitionBy(entity_col).orderBy(page_col)
               .rowsBetween(Window.unboundedPreceding, -1))
    short = F.when(F.col(size_col) < per_page, 1).otherwise(0)
    return (pages.where(F.col(page_col) <= max_pages)
                 .withColumn("_short_before", F.coalesce(F.sum(short).over(w), F.lit(0)))
                 .where((F.col("_short_before") == 0) & (F.col(size_col) > 0))
                 .drop("_short_before"))


def pages_of(records: DataFrame, entity_col: str, order_by: Sequence[str | Column],
             aggs: Sequence[Column], *, per_page: int = PER_PAGE,
             max_pages: int = MAX_PAGES) -> DataFrame:
    """Records -> kept pages with ``n`` and the given per-page aggregates."""
    numbered = number_pages(records, entity_col, order_by, per_page=per_page, max_pages=max_pages)
    pages = numbered.groupBy(entity_col, "page").agg(F.count(F.lit(1)).alias("n"), *aggs)
    return keep_fetched_pages(pages, entity_col, per_page=per_page, max_pages=max_pages)

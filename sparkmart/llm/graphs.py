"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


HUBS = 1024  # a node with more than one in so many of all links is joined by broadcast


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; root is the smallest node reached.

    Alternating star joins: each node's larger neighbours are linked to the smallest node around it,
    then its smaller ones, until every link leads to a root.  The number of rounds grows with the
    logarithm of the longest path, and one small table is written in each.  Fewer than ``HUBS`` nodes can
    have more than 1 / ``HUBS`` of all links, so those get their smallest neighbour by a broadcast, and the
    links of a hub are dealt to all tasks.
    """
    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    def towards(links: DataFrame, n: int) -> DataFrame:
        least = links.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        hubs = least.where(F.col("n") * HUBS > n).select("u", F.col("m").alias("hub"))
        # Links of hubs meet no row of the second join and are dealt by their other end.
        rows = links.join(F.broadcast(hubs), "u", "left").withColumn(
            "spread", F.when(F.col("hub").isNotNull(), F.xxhash64("v")))
        rest = least.select("u", "m", F.lit(0).cast("long").alias("spread"))
        return (rows.withColumn("spread", F.coalesce("spread", F.lit(0))).join(rest, ["u", "spread"], "left")
                .select("u", "v", F.coalesce("hub", "m").alias("m")))

    links = store(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u != v").distinct(), "graph-links")
    before = state(links)
    while before[0]:
        n = before[0]
        both = links.union(links.select("v", "u"))
        large = towards(both, 2 * n).where("v > u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v"))
        links = store(
            towards(large, n).select(F.explode(F.array(
                F.struct("u", F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*").where("u != v").distinct(), "graph-links")
        after = state(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

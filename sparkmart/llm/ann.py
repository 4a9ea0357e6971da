"""Approximate nearest neighbours over learned partitions (operator 4).

1. From a bounded sample (64 vectors a part, ``SAMPLE`` at least, the first in the order of a hash of
   their id): the exact neighbour graph, cut into equal parts by recursive spectral bisection at the
   median.  Parts grow with the table, one per ``ROWS_A_PART`` rows, from ``PARTS`` to ``MAX_PARTS``.
2. A small classifier (one hidden layer) learns, for a vector, the shares of its graph neighbours in
   each part.  The number of parts to search is the smallest that finds ``AIM`` of the neighbours of
   sample vectors kept out of the training; nearest neighbours are closer in a larger table, so this
   errs on the safe side.
3. Every vector of the table goes to its most probable part.  A query goes to its most probable
   parts and is ranked there by exact cosine, in double precision on the original components.

Parts are searched in blocks of candidates and of queries, so no task holds a whole part.  Of equal
vectors, only the ``k + 1`` smallest ids can be among a query's ``k`` nearest, so the others are left
out of the blocks; this is exact.

Cases: vectors that are null, empty, zero, or with null or non-finite components take no part, nor do
null ids.  Rows equal in id and vector count once.  Rows with one id and different vectors are all
candidates, and each is a query of its own if its id is one, told apart by ``query_hash``; a query's own
row alone is no candidate for it.  Vectors are compared within their length: the index covers the
commonest length, the others are searched whole, in blocks.  Components of any size are scaled by a power
of two before they are squared.  Tables with fewer vectors than ``LEAST`` have one part, which makes the
search exact; no rows give no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import store

SAMPLE = 4096  # 64 * MAX_PARTS at most
LEAST = 512
PARTS = 16
MAX_PARTS = 256
ROWS_A_PART = 4096
NEIGHBOURS = 10
HIDDEN = 64
AIM = 0.95
BLOCK = 8192


@dataclass(frozen=True)
class Index:
    layers: tuple[np.ndarray, ...]  # hidden weights and bias, output weights and bias
    probes: int

    def parts(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` most probable parts of each unit vector, the most probable first."""
        if not self.layers:
            return np.zeros((len(x), 1), np.int64)
        return np.argsort(-_scores(self.layers, x), axis=1, kind="stable")[:, :n]


def _scores(layers, x: np.ndarray) -> np.ndarray:
    a, b, c, d = layers
    return np.maximum(x @ a + b, 0) @ c + d


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that the largest component is near 1 and no square overflows."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


def unit(v: np.ndarray) -> np.ndarray:
    v = scaled(v)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def n_parts(rows: int) -> int:
    """Parts for a table of so many rows: a power of two."""
    return min(MAX_PARTS, max(PARTS, 1 << max(0, rows // ROWS_A_PART).bit_length()))


def _nearest(x: np.ndarray, y: np.ndarray, k: int, own: bool) -> np.ndarray:
    """Places in y of the k nearest of each x, in blocks of rows."""
    found = []
    for at in range(0, len(x), 512):
        s = x[at:at + 512] @ y.T
        if own:
            s[np.arange(len(s)), at + np.arange(len(s))] = -2
        found.append(np.argpartition(-s, k, axis=1)[:, :k])
    return np.concatenate(found)


def bisected(graph: np.ndarray, parts: int) -> np.ndarray:
    """Part of each vertex of a neighbour graph (rows of neighbours); parts is a power of two."""
    n = len(graph)
    part = np.zeros(n, np.int64)
    rng = np.random.default_rng(5)
    src = np.repeat(np.arange(n), graph.shape[1])
    ends = np.concatenate([np.stack([src, graph.ravel()]), np.stack([graph.ravel(), src])], axis=1)
    size = 1
    while size < parts:
        inside = part[ends[0]] == part[ends[1]]  # edges between halves no longer count
        a, b = ends[:, inside]
        degree = np.maximum(np.bincount(a, minlength=n), 1)
        members = np.bincount(part, minlength=size)
        x = rng.standard_normal(n)
        for _ in range(60):  # towards the second eigenvector of each part's random walk
            x = 0.5 * x + 0.5 * np.bincount(a, weights=x[b], minlength=n) / degree
            x -= (np.bincount(part, weights=x * degree, minlength=size)
                  / np.bincount(part, weights=degree, minlength=size))[part]
            x /= np.sqrt(np.bincount(part, weights=x * x, minlength=size) / members)[part] + 1e-12
        order = np.lexsort((x, part))
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n) - np.repeat(np.cumsum(members) - members, members)
        part = 2 * part + (rank >= (members // 2)[part])
        size *= 2
    return part


def learn(v: np.ndarray, *, parts: int = PARTS, aim: float = AIM, k: int = 5) -> Index:
    """Index from the sample's vectors."""
    if len(v) < LEAST:
        return Index((), 1)
    x = unit(v.astype(np.float64))
    rng = np.random.default_rng(9)
    kept_out = np.zeros(len(x), bool)
    kept_out[rng.permutation(len(x))[:len(x) // 8]] = True
    fit, probe = x[~kept_out], x[kept_out]
    graph = _nearest(fit, fit, NEIGHBOURS, own=True)
    part = bisected(graph, parts)
    target = np.zeros((len(fit), parts))
    for j in range(NEIGHBOURS):
        target[np.arange(len(fit)), part[graph[:, j]]] += 0.5 / NEIGHBOURS
    target[np.arange(len(fit)), part] += 0.5
    d = x.shape[1]
    layers = [rng.standard_normal((d, HIDDEN)) * (2 / d) ** 0.5 * d ** 0.5 / 4, np.zeros(HIDDEN),
              rng.standard_normal((HIDDEN, parts)) * (1 / HIDDEN) ** 0.5, np.zeros(parts)]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    for step in range(1, 301):  # Adam on the whole sample
        h = np.maximum(fit @ layers[0] + layers[1], 0)
        z = h @ layers[2] + layers[3]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p = (p / p.sum(axis=1, keepdims=True) - target) / len(fit)
        back = (p @ layers[2].T) * (h > 0)
        grads = [fit.T @ back + 1e-4 * layers[0], back.sum(0), h.T @ p + 1e-4 * layers[2], p.sum(0)]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            layers[i] -= 0.01 * (first[i] / (1 - 0.9 ** step)) / (
                np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    index = Index(tuple(layers), parts)
    home = index.parts(fit, 1)[:, 0]
    near = home[_nearest(probe, fit, k, own=False)]  # parts in which a search must look
    order = index.parts(probe, parts)
    for n in range(1, parts + 1):
        if (near[:, :, None] == order[:, None, :n]).any(2).mean() >= aim:
            return Index(tuple(layers), n)
    return index


def usable(vec: Column) -> Column:
    """Whether a vector can have a cosine: finite components, not all zero."""
    return vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (
        F.abs(x) == float("inf"))) & F.exists(vec, lambda x: x != 0)


def search(vectors: DataFrame, *, every: int = 50, k: int = 5, sample: int = SAMPLE,
           parts: int | None = None, aim: float = AIM, block: int = BLOCK, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score, query_hash``: the ``k`` nearest found of each row whose id is
    divisible by ``every``."""
    spark = vectors.sparkSession
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"),
                           F.col(vec_col).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & usable(F.col("v"))).distinct())
    rows = store(rows.withColumn("d", F.size("v")), "ann-vectors")
    common = rows.groupBy("d").count().orderBy(F.desc("count"), "d").first()
    length, total = (common.d, common["count"]) if common is not None else (0, 0)
    parts = parts or n_parts(total)
    drawn = (rows.where(F.col("d") == length).orderBy(F.xxhash64("id"), "id", "v")
             .limit(max(sample, 64 * parts)).toPandas())
    index = learn(np.stack(drawn.v) if len(drawn) else np.zeros((0, 1)), parts=parts, aim=aim, k=k)
    held = spark.sparkContext.broadcast((index.layers, index.probes))

    def routed(n: int | None):
        @F.pandas_udf("array<int>")
        def route(v: pd.Series) -> pd.Series:
            layers, probes = held.value
            covered = v.map(len).to_numpy() == length
            out = [[0]] * len(v)
            if covered.any():
                found = Index(layers, probes).parts(unit(np.stack(v[covered])), n or probes)
                for at, chosen in zip(np.flatnonzero(covered), found):
                    out[at] = chosen
            return pd.Series(out)

        return route

    indexed = store(rows.withColumn("part", routed(1)("v")[0]), "ann-index")  # every vector
    queries = rows.where(F.col("id") % every == 0).select(
        "d", F.col("id").alias("qid"), F.col("v").alias("qv"), F.explode(routed(None)("v")).alias("part"))
    queries = store(queries, "ann-queries")
    first = Window.partitionBy("part", "v").orderBy("id")
    offered = indexed.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    offered = store(offered.select("d", "part", "id", "v"), "ann-offered")

    def largest(df: DataFrame) -> int:
        return df.groupBy("d", "part").count().agg(F.max("count")).first()[0] or 0

    blocks, turns = -(-largest(offered) // block) or 1, -(-largest(queries) // block) or 1
    every_turn = F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    dealt_c = offered.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")) \
        .withColumn("turn", every_turn)
    dealt_q = queries.withColumn("turn", F.pmod(F.xxhash64("qid", "qv"), F.lit(turns)).cast("int")) \
        .withColumn("query_hash", F.xxhash64("qv")).withColumn("block", every_block)

    def nearest(q: pa.Table, c: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if q.num_rows and c.num_rows:
            qi, ci, qh = q["qid"].to_numpy(), c["id"].to_numpy(), q["query_hash"].to_numpy()
            qo, co = (np.asarray(t.combine_chunks().flatten()).reshape(len(t), -1)
                      for t in (q["qv"], c["v"]))
            qv, cv = scaled(qo), scaled(co)
            qn, cn = np.linalg.norm(qv, axis=1), np.linalg.norm(cv, axis=1)
            cu = cv / cn[:, None]
            for at in range(0, len(qv), 256):
                near = (qv[at:at + 256] / qn[at:at + 256, None]) @ cu.T
                for r in range(len(near)):
                    s, own = near[r], np.flatnonzero(ci == qi[at + r])
                    own = own[(co[own] == qo[at + r]).all(axis=1)]
                    s[own] = -2
                    least = np.partition(s, -k)[-k] if len(s) > k else -1.5
                    some = np.flatnonzero(s >= max(least - 1e-9, -1.5))
                    exact = np.einsum("ij,j->i", cv[some], qv[at + r]) / (cn[some] * qn[at + r])
                    best = np.lexsort((ci[some], -exact))[:k]
                    out += [(qi[at + r], int(ci[some[b]]), float(exact[b]), qh[at + r]) for b in best]
        cols = list(zip(*out)) or [[], [], [], []]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()),
                         "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64()),
                         "query_hash": pa.array(cols[3], pa.int64())})

    keys = ["d", "part", "block", "turn"]
    found = dealt_q.groupBy(*keys).cogroup(dealt_c.groupBy(*keys)).applyInArrow(
        nearest, "query_id bigint, vec_id bigint, score double, query_hash bigint")
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score", "query_hash"))

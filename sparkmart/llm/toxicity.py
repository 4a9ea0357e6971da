"""Toxicity by cumulative-link ordinal regression (operator 5).

The severity y of a text has ordered grades 0 .. K-1, and P(y <= k) = sigmoid(theta_k - w.x): all
thresholds share the weights w, and theta_0 < theta_1 < ...  x holds the presence of hashed features:
words and their prefixes of 4, 5 and 6 bytes, in 2^18 places.  The output is the expected severity
sum k P(y = k) and the most probable grade; a text is toxic when P(y >= 1) reaches ``threshold``.

Training takes at most ``per_grade`` labelled rows of each label value, the first in the order of a
hash of the id, and of these the ``SELECTED`` features that tell labels apart best.  Labels with more
than two values are the grades.  Two values are split: toxic rows with more strong features than the
median toxic row have grade 2.  Only sparse rows of the bounded sample reach the driver.

Cases: null and empty texts have no features and the severity of the thresholds alone; null labels or
ids teach nothing; a document labelled more than once has its largest label; without two label values
every severity is 0; fewer rows than the bound are all used; further columns are ignored; no rows give
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import store
from .text import U, slices, words

PREFIXES = (4, 5, 6)
FEATURE_BITS = 18
PER_GRADE = 4000
MAX_GRADES = 16
SELECTED = 4096
MIN_STRENGTH = 18.0  # likelihood ratio (G) of a selected feature; over four standard deviations
L2 = 1e-4
STEPS = 400
THRESHOLD = 0.3


def features(column: pa.Array) -> list[np.ndarray]:
    """Distinct places of each text's features, ascending."""
    found: list[np.ndarray] = []
    for lo, hi in slices(column):
        h, bounds = words(column[lo:hi], PREFIXES)
        at = (h >> U(64 - FEATURE_BITS)).astype(np.int32)
        found += [np.unique(at[:, a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    return found


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # (2^FEATURE_BITS,) float32
    thetas: np.ndarray  # ascending, one less than the grades

    def grades(self, rows: list[np.ndarray]) -> np.ndarray:
        """Probability of each grade, one row per text."""
        score = np.array([self.weights[r].sum(dtype=np.float64) for r in rows])
        return probabilities(score, self.thetas)


def probabilities(score: np.ndarray, thetas: np.ndarray) -> np.ndarray:
    z = np.clip(thetas[None, :] - score[:, None], -500, 500)
    upto = np.concatenate([np.zeros((len(score), 1)), 1 / (1 + np.exp(-z)), np.ones((len(score), 1))], 1)
    return np.diff(upto, axis=1)


def labelled_sample(docs: DataFrame, labels: DataFrame, per_grade: int, *, id_col: str, text_col: str,
                    label_col: str) -> list[tuple[int, np.ndarray]]:
    """(label, features) of at most ``per_grade`` rows of each of ``MAX_GRADES`` labels at most."""
    ids = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .where("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y"))
             .join(ids, "id", "left_semi"))
    known = store(known, "toxicity-labels")
    values = [r.y for r in known.groupBy("y").count().orderBy(F.desc("count"), "y")
              .limit(MAX_GRADES).collect()]
    chosen = None
    for y in values:
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_grade)
        chosen = part if chosen is None else chosen.union(part)
    if chosen is None:
        return []
    chosen = store(chosen, "toxicity-sample")  # MAX_GRADES * per_grade rows at most

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("y"),
                pa.array(features(batch.column("text")), pa.list_(pa.int32()))], names=["id", "y", "at"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    got = (rows.join(F.broadcast(chosen), "id").select("id", "y", "text")
           .mapInArrow(sparse, T.StructType([
               T.StructField("id", chosen.schema["id"].dataType), T.StructField("y", T.IntegerType()),
               T.StructField("at", T.ArrayType(T.IntegerType()))]))
           .dropDuplicates(["id"]).orderBy("id").toArrow())
    return [(y.as_py(), np.asarray(at.values)) for y, at in zip(got["y"], got["at"])]


def train(sample: list[tuple[int, np.ndarray]], *, l2: float = L2, steps: int = STEPS) -> Model:
    """Weights and thresholds by AdaGrad on the penalised likelihood."""
    values = sorted({y for y, _ in sample})
    weights = np.zeros(1 << FEATURE_BITS, np.float32)
    if len(values) < 2:
        return Model(weights, np.array([500.0]))
    y = np.array([values.index(v) for v, _ in sample])
    at = np.concatenate([r for _, r in sample])
    row = np.repeat(np.arange(len(sample)), [len(r) for _, r in sample])

    toxic = (y > 0).astype(float)
    seen = np.bincount(at, minlength=len(weights))
    bad = np.bincount(at, weights=toxic[row], minlength=len(weights))
    good = seen - bad
    share = toxic.mean()

    def part(n: np.ndarray, p: float) -> np.ndarray:
        """Likelihood ratio of n of the rows that hold a feature, against a share p of them."""
        return np.where(n > 0, n * np.log(np.maximum(n, 1e-9) / np.maximum(seen * p, 1e-9)), 0.0)

    strength = 2 * (part(bad, share) + part(good, 1 - share))
    chosen = np.sort(np.argsort(-strength, kind="stable")[:SELECTED])
    chosen = chosen[strength[chosen] >= MIN_STRENGTH]
    place = np.full(len(weights), -1)
    place[chosen] = np.arange(len(chosen))
    if len(values) == 2:
        strong = (strength >= MIN_STRENGTH) & (bad > seen * share)
        hits = np.bincount(row, weights=strong[at], minlength=len(sample))
        if (y > 0).any():
            y = y + ((y > 0) & (hits > np.median(hits[y > 0])))
    top = int(y.max())
    kept = place[at] >= 0
    cols, rows = place[at[kept]], row[kept]

    w, thetas = np.zeros(len(chosen)), np.linspace(-0.5, 0.5, top) if top > 1 else np.zeros(1)
    gw, gt = np.full(len(w), 1e-8), np.full(len(thetas), 1e-8)
    n = len(sample)
    for _ in range(steps):
        score = np.bincount(rows, weights=w[cols], minlength=n)
        p = np.maximum(probabilities(score, thetas)[np.arange(n), y], 1e-12)
        cut = 1 / (1 + np.exp(-np.clip(thetas[None, :] - score[:, None], -500, 500)))
        slope = cut * (1 - cut)  # of P(y <= k) by theta_k
        upper = np.where(y < top, slope[np.arange(n), np.minimum(y, top - 1)], 0.0) / p
        lower = np.where(y > 0, slope[np.arange(n), np.maximum(y - 1, 0)], 0.0) / p
        dw = np.bincount(cols, weights=(upper - lower)[rows], minlength=len(w)) / n + l2 * w
        dt = np.array([lower[y == k + 1].sum() - upper[y == k].sum() for k in range(top)]) / n
        gw += dw * dw
        gt += dt * dt
        w -= 0.3 * dw / np.sqrt(gw)
        thetas = np.sort(thetas - 0.3 * dt / np.sqrt(gt))
    weights[chosen] = w
    return Model(weights, thetas)


def learn(docs: DataFrame, labels: DataFrame, *, per_grade: int = PER_GRADE, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> Model:
    return train(labelled_sample(docs, labels, per_grade, id_col=id_col, text_col=text_col,
                                 label_col=label_col))


def graded(docs: DataFrame, model: Model, *, threshold: float = THRESHOLD,
           text_col: str = "text") -> DataFrame:
    """Rows of two structs: ``row``, the columns of ``docs`` as they are, and ``_tox``: grade, severity
    (expected), p_toxic and toxic; so no column of ``docs`` can clash."""
    held = docs.sparkSession.sparkContext.broadcast((model.weights, model.thetas))

    @F.pandas_udf("grade int, severity double, p_toxic double, toxic boolean")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = Model(*held.value)
        for series in texts:
            texts_of = pa.array(series, pa.large_string(), from_pandas=True)
            p = np.concatenate([np.zeros((0, len(fitted.thetas) + 1)), *(
                fitted.grades(features(texts_of[lo:hi])) for lo, hi in slices(texts_of))])
            bad = 1 - p[:, 0]
            yield pd.DataFrame({"grade": p.argmax(axis=1).astype("int32"),
                                "severity": p @ np.arange(p.shape[1]), "p_toxic": bad,
                                "toxic": bad >= threshold})

    rows = docs.select(F.struct("*").alias("row"))
    return rows.select("row", predict(F.col("row")[text_col]).alias("_tox"))


def severities(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``id_col, grade, severity, p_toxic, toxic`` of every document."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    model = learn(docs, labels, **options)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return graded(rows, model).select(F.col("row.id").alias(id_col), "_tox.grade", "_tox.severity",
                                      "_tox.p_toxic", "_tox.toxic")


def not_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text is not toxic."""
    model = learn(docs, labels, **options)
    found = graded(docs, model, text_col=options.get("text_col", "text"))
    return found.where(~F.col("_tox.toxic")).select("row.*")

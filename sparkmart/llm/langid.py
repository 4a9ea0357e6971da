"""Language identification (operator 3).

Features are TF-IDF weights of character 1- to 3-grams in 2^14 hashed counters; TF is 1 + ln count
and a document's vector has length 1.  Document frequencies are counted over all learnable rows.  A
multinomial logistic regression is trained on a bounded sample of them by FTRL-Proximal, one set of
per-coordinate states for each language, with L1 and L2 (elastic-net) penalties.  A temperature,
fitted on sample rows kept out of the training, calibrates the probabilities.

The sample has at most ``max_per_language`` rows of each language, the first in the order of a hash of
id and text, and at most ``max_train_rows`` in all, languages in turn.  So it depends on the rows alone, not on their
partitions.  Of the sample, only sparse counts (at most 2^14 a row) reach the driver.

Cases: a null text and one without a letter are ``und`` with score 0, as is every text when nothing
can be learned; rows with a null language teach nothing; a single language is predicted with score 1;
ties go to the language that sorts first; equal texts get equal predictions; a null id counts as held
out.  Further columns are ignored, and no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import store
from .ngrams import FEATURES, counts

MAX_PER_LANGUAGE, MAX_TRAIN_ROWS = 1000, 20_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
TASKS_A_GROUP = 32  # tasks whose first rows of a language meet in one group
CALIBRATION_SHARE = 5  # one sample row in so many fits the temperature
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray  # (FEATURES,)
    weights: np.ndarray  # (FEATURES, languages), divided by the temperature

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not any(c.isalpha() for c in text):
            return UNKNOWN, 0.0
        at, x = vector(counts(text), self.idf)
        p = softmax(x @ self.weights[at])
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def vector(n: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and TF-IDF values, of length 1, of a row of counts."""
    at = np.flatnonzero(n)
    x = (1 + np.log(n[at])) * idf[at]
    return at, x / max(np.sqrt(x @ x), 1e-12)


def held_out(id_col: Column) -> Column:
    """Rows that teach nothing: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Rows that hold each feature, and all rows; a task hands on one row of counters."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                df += counts(text.as_py()) > 0
                n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([[n, *df]], pa.list_(pa.int64()))], names=["df"])

    # counters add up place by place: (FEATURES + 1) sums, whatever the number of tasks
    got = (texts.mapInArrow(count, "df array<bigint>").select(F.posexplode("df").alias("at", "n"))
           .groupBy("at").agg(F.sum("n").alias("n")).orderBy("at").collect())
    if not got:
        return np.zeros(FEATURES, np.int64), 0
    return np.array([r.n for r in got[1:]], np.int64), got[0].n


def _sample(rows: DataFrame, per_language: int, max_rows: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, places, counts) of at most ``max_rows`` learnable rows, in the order of a hash."""
    # The first rows of groups of tasks hold the first of all, so no task gets a whole language's candidates.
    in_group = Window.partitionBy("lang", "tasks").orderBy("order", "id")
    in_turn = Window.partitionBy("lang").orderBy("order", "id")
    chosen = (rows.select("id", "lang", F.xxhash64(F.col("id").cast("string"), "text").alias("order"),
                          F.floor(F.spark_partition_id() / TASKS_A_GROUP).alias("tasks"))
              .withColumn("nth", F.row_number().over(in_group)).where(F.col("nth") <= per_language)
              .withColumn("nth", F.row_number().over(in_turn)).where(F.col("nth") <= per_language)
              .orderBy("nth", "order", "lang").limit(max_rows))
    chosen = store(chosen.select("id", "lang", "order", "nth"), "langid-sample")
    texts = rows.join(F.broadcast(chosen.select("id", "order").distinct()),  # at most max_rows
                      F.xxhash64(rows["id"].cast("string"), "text") == F.col("order"), "left_semi")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = [], []
            for text in batch.column("text"):
                c = counts(text.as_py())
                at.append(np.flatnonzero(c).astype(np.int32))
                n.append(c[at[-1]].astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column("order"), batch.column("lang"), pa.array(at, pa.list_(pa.int32())),
                pa.array(n, pa.list_(pa.int32()))], names=["order", "lang", "at", "n"])

    got = (texts.select(F.xxhash64(F.col("id").cast("string"), "text").alias("order"), "lang", "text")
           .dropDuplicates(["order", "lang"])
           .mapInArrow(sparse, "order bigint, lang string, at array<int>, n array<int>")
           .orderBy("order", "lang").toArrow())
    return [(lang.as_py(), np.asarray(at.values), np.asarray(n.values)) for lang, at, n in
            zip(got["lang"], got["at"], got["n"])]


def train(sample: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray, *, epochs: int = EPOCHS,
          alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> Model:
    """FTRL-Proximal with elastic-net penalties, then the temperature."""
    languages = tuple(sorted({lang for lang, _, _ in sample}))
    k = len(languages)
    if not k:
        return Model((), idf, np.zeros((FEATURES, 0)))
    rows = []
    for lang, at, n in sample:
        x = (1 + np.log(n)) * idf[at]
        rows.append((languages.index(lang), at, x / max(np.sqrt(x @ x), 1e-12)))
    fit = [r for i, r in enumerate(rows) if i % CALIBRATION_SHARE or len(rows) < 10 * CALIBRATION_SHARE]
    tune = [r for i, r in enumerate(rows) if i % CALIBRATION_SHARE == 0] or rows
    z, n2 = np.zeros((FEATURES, k)), np.zeros((FEATURES, k))

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        w = -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2)
        return np.where(np.abs(zs) <= l1, 0.0, w)

    order = np.random.default_rng(3)
    for _ in range(epochs):
        for i in order.permutation(len(fit)):
            y, at, x = fit[i]
            w = weights(z[at], n2[at])
            error = softmax(x @ w)
            error[y] -= 1
            g = x[:, None] * error
            sigma = (np.sqrt(n2[at] + g * g) - np.sqrt(n2[at])) / alpha
            z[at] += g - sigma * w
            n2[at] += g * g
    w = weights(z, n2)
    logits = np.array([x @ w[at] for _, at, x in tune]).reshape(len(tune), k)
    truth = np.array([y for y, _, _ in tune], int)
    grid = np.geomspace(0.25, 20, 81)

    def loss(t: float) -> float:
        p = softmax(logits / t)[np.arange(len(truth)), truth]
        return -np.log(np.maximum(p, 1e-9)).mean()

    return Model(languages, idf, w / min(grid, key=loss))


def learn(docs: DataFrame, *, max_per_language: int = MAX_PER_LANGUAGE,
          max_train_rows: int = MAX_TRAIN_ROWS, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Model:
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang")).where(
        "text is not null and lang is not null").where(~held_out(F.col("id")))
    df, n = _frequencies(rows.select("text"))
    idf = np.log((1 + n) / (1 + df)) + 1
    return train(_sample(rows, max_per_language, max_train_rows), idf)


def identify(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """Rows of two structs: ``row``, the columns of ``docs`` as they are, and ``_lang``, the whole text's
    ``lang_pred`` and ``score``; so no column of ``docs`` can clash."""
    held = docs.sparkSession.sparkContext.broadcast((model.languages, model.idf, model.weights))

    @F.pandas_udf(T.StructType([T.StructField("lang_pred", T.StringType()),
                                T.StructField("score", T.DoubleType())]))
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = Model(*held.value)
        for series in texts:
            got = [fitted.predict(t) for t in series]
            yield pd.DataFrame(got, columns=["lang_pred", "score"])

    rows = docs.select(F.struct("*").alias("row"))
    return rows.select("row", predict(F.col("row")[text_col]).alias("_lang"))


def predictions(docs: DataFrame, *, max_per_language: int = MAX_PER_LANGUAGE,
                max_train_rows: int = MAX_TRAIN_ROWS, id_col: str = "doc_id",
                text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id_col, held_out, lang_pred, score`` of every document, learned from the rows of ``docs``."""
    model = learn(docs, max_per_language=max_per_language, max_train_rows=max_train_rows, id_col=id_col, text_col=text_col,
                  lang_col=lang_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return identify(rows, model).select(
        F.col("row.id").alias(id_col), held_out(F.col("row.id")).alias("held_out"),
        F.col("_lang.lang_pred").alias("lang_pred"), F.col("_lang.score").alias("score"))


def identified(docs: DataFrame, *, min_score: float = 0.5, **columns) -> DataFrame:
    """The rows of ``docs`` in some learned language: not ``und``, and at least ``min_score``."""
    model = learn(docs, **columns)
    text_col = columns.get("text_col", "text")
    found = identify(docs, model, text_col=text_col)
    return found.where((F.col("_lang.lang_pred") != UNKNOWN)
                       & (F.col("_lang.score") >= min_score)).select("row.*")

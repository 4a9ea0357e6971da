"""MinHash fingerprints of texts and of their edited copies (operator 8).

A fingerprint holds, for each of ``PERMUTATIONS`` universal hash functions h -> (a h + b) mod 2^64
(a odd), the smallest value over the text's five-word shingles, mixed and cut to 16 bits.  The minimum
of n hashes is about 2^64 / n, so its own upper bits are nearly all zero in long texts; those of the
mixed minimum are even at any length.  ``near_edited`` and ``near_next`` are the shares of equal components
of two fingerprints, which estimate the Jaccard similarity of the shingle sets; components of unequal minima
agree by chance once in 2^16.  ``similar_pairs`` joins bands of the signatures in Spark
and verifies the Jaccard similarity of what meets.

Cases: null and empty texts are the empty text, whose fingerprint is all ones (as of any text without
words); two such fingerprints are alike 1.  Fewer than five words make one shingle.  The order of
documents is by id, a null id first, repeated ids by text; the single document of a one-row table is
its own next one.  Every row of the input gives one row, repeated rows too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shuffle_partitions, store
from .text import U, mix, shingles

SHINGLE_WORDS = 5
PERMUTATIONS = 64
_rng = np.random.default_rng(8)
_A = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * U(2) + U(1)
_B = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_BLOCK = 1 << 15  # shingles handled at once


def signatures(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of ``PERMUTATIONS`` minima per text; all ones for a text without shingles."""
    n = len(bounds) - 1
    out = np.full((n, PERMUTATIONS), np.iinfo(np.uint64).max, U)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + _BLOCK, "right")) - 1)
        for lo in range(bounds[row], bounds[end], 8 * _BLOCK):  # one long text in several goes
            hi = min(lo + 8 * _BLOCK, bounds[end])
            block = h[lo:hi]
            full = row + np.flatnonzero(np.diff(np.clip(bounds[row:end + 1], lo, hi)))
            at = np.maximum(bounds[full], lo) - lo
            for j in range(PERMUTATIONS):
                least = np.minimum.reduceat(block * _A[j] + _B[j], at)
                out[full, j] = np.minimum(out[full, j], least)
        row = end
    return out


def short(signature: np.ndarray) -> np.ndarray:
    """16 bits of each mixed minimum, even whatever the text's length; equal minima give equal parts."""
    none = signature == np.iinfo(np.uint64).max  # no shingles: all ones
    return np.where(none, U(0xFFFF), mix(signature) >> U(48)).astype(">u2")


def text_signatures(column: pa.Array) -> np.ndarray:
    return signatures(*shingles(column, SHINGLE_WORDS))


def _hex(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * 2
    raw = np.ascontiguousarray(rows).tobytes().hex()
    return pa.array([raw[i * 2 * width:(i + 1) * 2 * width] for i in range(len(rows))], pa.string())


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many from the start of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_OUT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])


def _digest(ids: list, texts: list[str], following: str) -> pa.RecordBatch:
    """Result rows of consecutive documents; ``following`` comes after the last."""
    after = texts[1:] + [following]
    changed = [edited(t, f) for t, f in zip(texts, after)]
    own = short(text_signatures(pa.array([*texts, following], pa.large_string())))
    other = short(text_signatures(pa.array(changed, pa.large_string())))
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed]),
        _hex(own[:-1]), _hex(other), pa.array((own[:-1] == other).mean(axis=1)),
        pa.array((own[:-1] == own[1:]).mean(axis=1))], names=_OUT.names)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (range, tail, id, text) to results; a tail row only follows the last document."""
    ids: list = []
    texts: list[str] = []
    size, closed = 0, False  # closed: a tail row of the current range has been used

    def flush(following: str) -> Iterator[pa.RecordBatch]:
        if ids:
            yield _digest(ids, texts, following)
            ids.clear()
            texts.clear()

    for batch in batches:
        cols = [batch.column(i) for i in range(4)]
        for k in range(batch.num_rows):
            tail, text = cols[1][k].as_py(), cols[3][k].as_py()
            if tail:
                if not closed:
                    yield from flush(text)
                closed, size = True, 0
                continue
            closed = False
            if size > 1 << 22:
                yield from flush(text)
                size = 0
            ids.append(cols[2][k].as_py())
            texts.append(text)
            size += len(text)
    if ids:
        raise AssertionError("a range of documents has no following document")


def fingerprint(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Contract columns for every document.

    The ids alone give range bounds (one id per shuffle partition).  Texts are shuffled once, to
    their range; the first document of a range also goes to the range before it, as what follows
    there, and the first of all to the last range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = shuffle_partitions(spark)
    shares = [k / n for k in range(1, n)] or [0.5]
    found = rows.agg(F.min("id").alias("least"), F.percentile_approx("id", shares, 10_000).alias("b"),
                     F.count_if(F.col("id").isNull()).alias("nulls")).first()
    # One bound per range, the first id in it; null ids come before all others.
    bounds = [found.least, *(found.b or [])] if found.least is not None else []
    bounds = np.unique(np.array(bounds, np.int64))
    nulls = bool(found.nulls)
    last = max(0, len(bounds) - 1 + nulls)

    @F.pandas_udf("array<int>")
    def ranges(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(bounds, ids.fillna(0).astype("int64"), "right") - 1 + nulls
        at[ids.isna()] = 0
        opens = ids.isin(bounds) | ids.isna()
        return pd.Series([[a, (a - 1) % (last + 1) - last - 1] if o else [a]
                          for a, o in zip(at.tolist(), opens)])

    # A negative number is the range, counted from the end, to which a row goes as tail.
    dealt = rows.select("id", "text", F.explode(ranges("id")).alias("r")).select(
        F.when(F.col("r") < 0, F.col("r") + (last + 1)).otherwise(F.col("r")).alias("part"),
        (F.col("r") < 0).alias("tail"), "id", "text")
    return (dealt.repartition(n, "part").sortWithinPartitions("part", "tail", "id", "text")
            .mapInArrow(_neighbours, _OUT))


def similar_pairs(docs: DataFrame, *, threshold: float = 0.8, band_rows: int = 4,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pairs ``(id_a, id_b, jaccard)`` of different texts at or above ``threshold``.

    Equal texts are joined as one, under their smallest id.  Signatures are cut into bands of
    ``band_rows`` minima; texts that share a band are verified on their whole shingle sets.  The
    links of a bucket of k texts are up to k^2 / 2 by nature; ``neardup`` gives classes instead.
    """
    texts = (docs.where(F.col(text_col).isNotNull())
             .groupBy(F.col(text_col).alias("text")).agg(F.min(id_col).alias("id")))

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, bounds = shingles(batch.column("text"), SHINGLE_WORDS)
            sig = signatures(h, bounds)
            some = np.diff(bounds) > 0
            keys = [[f"{b}:{row[b * band_rows:(b + 1) * band_rows].tobytes().hex()}"
                     for b in range(PERMUTATIONS // band_rows)] if s else []
                    for row, s in zip(sig, some)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(keys, pa.list_(pa.string()))], names=["id", "bands"])

    id_type = texts.schema["id"].dataType
    stored = store(texts, "fingerprint-texts")
    banded = store(stored.mapInArrow(bands, T.StructType([
        T.StructField("id", id_type), T.StructField("bands", T.ArrayType(T.StringType()))]))
        .select("id", F.explode("bands").alias("band")), "fingerprint-bands")
    a, b = banded.alias("a"), banded.alias("b")
    pairs = (a.join(b, "band").where("a.id < b.id")
             .select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b")).distinct())
    both = (pairs.join(stored.select(F.col("id").alias("id_a"), F.col("text").alias("text_a")), "id_a")
            .join(stored.select(F.col("id").alias("id_b"), F.col("text").alias("text_b")), "id_b"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (ha, ba), (hb, bb) = (shingles(batch.column(c), SHINGLE_WORDS) for c in ("text_a", "text_b"))
            jaccard = np.empty(batch.num_rows)
            for k in range(batch.num_rows):
                x, y = np.unique(ha[ba[k]:ba[k + 1]]), np.unique(hb[bb[k]:bb[k + 1]])
                common = len(np.intersect1d(x, y, assume_unique=True))
                jaccard[k] = common / (len(x) + len(y) - common)
            out = pa.RecordBatch.from_arrays([batch.column("id_a"), batch.column("id_b"),
                                              pa.array(jaccard)], names=["id_a", "id_b", "jaccard"])
            yield out.filter(pa.array(jaccard >= threshold))

    return both.select("id_a", "id_b", "text_a", "text_b").mapInArrow(verify, T.StructType([
        T.StructField("id_a", id_type), T.StructField("id_b", id_type),
        T.StructField("jaccard", T.DoubleType())]))

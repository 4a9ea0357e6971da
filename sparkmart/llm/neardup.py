"""Near-duplicate classes by consistent weighted sampling over TF-IDF shingles (operator 7).

1. Document frequencies of five-word shingles are counted over all texts, in 2^18 hashed counters.
2. Equal texts become one node, named by the digest of the text.  Each node gets improved consistent
   weighted samples of its TF-IDF shingles, in ``BANDS`` bands of ``BAND_ROWS`` samples, and as many
   bands of samples of its plain set of shingles.
3. Nodes that share a band are a bucket.  In star rounds, every member is verified against one node
   of its bucket, another in each round, which costs one pair a member however large the bucket is.
   The links join components, and members already in the leading node's component are left out.
4. Once the pairs of different components in all buckets are no more than the members, or after
   ``STAR_ROUNDS`` rounds, those pairs are verified one by one, except those that cannot be near: a
   bitmap of ``SKETCH`` bits of the shingles, in each text, gives a lower bound of how many shingles
   only one of the two has.  So no link between components is lost; pairs inside one component
   cannot change the classes.
5. The class of a document is its component, named by the smallest id in it.

A pair counts as near when the weighted Jaccard similarity of the TF-IDF shingles reaches
``threshold``, or that of the plain shingle sets does.  The IDF is ln(100 + min(N / df, 100)): what
fewer than 1 % of the texts share has one weight, and the weight of what all share is lower by an
eighth, so that weighted and plain similarity stay close in large groups of copies.  TF is 1 + ln
count.  A pair at the threshold by either rule meets in some band of that rule with probability
1 - (1 - 0.8^5)^20 = 0.9996.

Cases: equal texts form one class, empty ones too; a null text is a class of its own and so is a text
without words that no other equals; fewer than five words make one shingle.  A null id counts as
larger than all others when a class is named.  Repeated rows stay repeated.  No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import store
from .cws import WeightedSampler, band_keys
from .graphs import components
from .text import U, mix, shingles, slices, unique_counts

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 20, 5
COUNTER_BITS = 18
_SLICES = 64  # rows in which a task hands on its counters
TASKS_A_SUM = 256  # tasks whose counters are added first
STAR_ROUNDS = 2
SKETCH = 2048  # bits of the bitmaps of members of crowded buckets
BLOCK = 2000  # members of a bucket that are compared with as many others in one task
SMOOTH = 100.0  # added to and upper bound of N / df


def node_of(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def counter(h: np.ndarray) -> np.ndarray:
    return (h >> U(64 - COUNTER_BITS)).astype(np.int64)


def document_frequencies(texts: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Texts per hashed shingle counter, and all texts.  2^18 counters, whatever the input's size."""
    size = 1 << COUNTER_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(size, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for lo, hi in slices(batch.column(0)):
                h, bounds = shingles(batch.column(0)[lo:hi], SHINGLE_WORDS)
                for a, b in zip(bounds[:-1], bounds[1:]):
                    df[np.unique(counter(h[a:b]))] += 1
        if n:
            parts = df.astype("<i4").reshape(_SLICES, -1)
            yield pa.RecordBatch.from_arrays([
                pa.array([*range(_SLICES), -1], pa.int32()),
                pa.array([*(p.tobytes() for p in parts), np.int64(n).tobytes()], pa.binary())],
                names=["slice", "counts"])

    def total(kind: str):
        def add(key: tuple, table: pa.Table) -> pa.Table:
            slice_ = key[0].as_py()
            acc = sum(np.frombuffer(raw.as_py(), "<i8" if slice_ < 0 else kind).astype(np.int64)
                      for raw in table["counts"])
            return pa.table({"slice": pa.array([slice_], pa.int32()),
                             "counts": pa.array([acc.tobytes()], pa.binary())})
        return add

    # Counters are added by groups of tasks, then over the groups: a group's size is bounded.
    schema = "slice int, counts binary"
    rows = {r.slice: np.frombuffer(r.counts, np.int64) for r in
            texts.select(text_col).mapInArrow(count, schema)
            .withColumn("tasks", F.floor(F.spark_partition_id() / TASKS_A_SUM))
            .groupBy("slice", "tasks").applyInArrow(total("<i4"), schema)
            .groupBy("slice").applyInArrow(total("<i8"), schema).collect()}
    if not rows:
        return np.zeros(size, np.int64), 0
    return np.concatenate([rows[k] for k in range(_SLICES)]), int(rows[-1][0])


def inverse_frequencies(df: np.ndarray, n: int) -> np.ndarray:
    return np.log(SMOOTH + np.minimum(n / np.maximum(df, 1), SMOOTH)).astype(np.float32)


def weighted_sets(column: pa.Array, idf: np.ndarray):
    """Distinct shingles of each text, their TF-IDF weights, and bounds."""
    h, counts, bounds = unique_counts(*shingles(column, SHINGLE_WORDS))
    weights = idf[counter(h)]
    more = counts > 1
    weights[more] *= 1 + np.log(counts[more]).astype(np.float32)
    return h, weights, bounds


def similarity(a: tuple, b: tuple) -> float:
    """The larger of weighted and plain Jaccard similarity of two (shingles, weights)."""
    (ha, wa), (hb, wb) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    common = hb[at] == ha
    least = float(np.minimum(wa[common], wb[at[common]]).sum(dtype=np.float64))
    both = float(wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64))
    n = int(common.sum())
    return max(least / (both - least), n / (len(ha) + len(hb) - n))


def _sampled(texts: DataFrame, idf, text_col: str) -> DataFrame:
    """Adds ``bands`` to (id, node, text) and drops the text."""
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = idf.value
        sampler = plain = None
        for batch in (b[lo:hi] for b in batches for lo, hi in slices(b.column(text_col))):
            h, w, bounds = weighted_sets(batch.column(text_col), weight)
            some = np.diff(bounds) > 0
            if sampler is None:
                sampler = WeightedSampler(BANDS * BAND_ROWS, np.float32(np.log(2 * SMOOTH)))
                plain = WeightedSampler(BANDS * BAND_ROWS, np.float32(1), seed=13)
            at = np.append(bounds[:-1][some], len(h))
            keys = np.hstack([band_keys(sampler.signatures(h, w, at), BAND_ROWS),
                              band_keys(~plain.signatures(h, np.ones_like(w), at), BAND_ROWS)])
            bands = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(some * 2 * BANDS)]), pa.int32()),
                pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("node"), bands],
                                             names=["id", "node", "bands"])

    return texts.mapInArrow(sample, T.StructType([
        T.StructField("id", texts.schema["id"].dataType), T.StructField("node", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType()))]))


def _sets(names: pa.Array, texts: pa.Array, idf: np.ndarray):
    """Row number to (shingles, weights); the set of a node that comes again is made once."""
    codes = names.dictionary_encode().indices.to_numpy()
    _, first = np.unique(codes, return_index=True)
    h, w, bounds = weighted_sets(texts.take(pa.array(first)), idf)
    return lambda k: (h[bounds[codes[k]]:bounds[codes[k] + 1]], w[bounds[codes[k]]:bounds[codes[k] + 1]])


def _verified(pairs: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """Those of the node pairs (a, b) that are near."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = idf.value
        for batch in (b[lo:hi] for b in batches for lo, hi in slices(b.column("text_b"))):
            near = np.zeros(batch.num_rows, bool)
            sets = [_sets(batch.column(c), batch.column(f"text_{c}"), weight) for c in "ab"]
            for k in range(batch.num_rows):
                near[k] = similarity(sets[0](k), sets[1](k)) >= threshold
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")],
                                             names=["a", "b"]).filter(pa.array(near))

    side = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))
    return (pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
            .mapInArrow(verify, "a binary, b binary"))


def _sketched(texts: DataFrame, idf) -> DataFrame:
    """``(node, sketch, n, w)``: bitmap of the hashed shingles, 64 bits to a number, their number and
    the sum of their weights."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = idf.value
        for batch in (b[lo:hi] for b in batches for lo, hi in slices(b.column("text"))):
            h, w, bounds = weighted_sets(batch.column("text"), weight)
            n = np.diff(bounds)
            bits = np.zeros((batch.num_rows, SKETCH), bool)
            bits[np.repeat(np.arange(batch.num_rows), n), (mix(h) % U(SKETCH)).astype(np.int64)] = True
            flat = pa.array(np.packbits(bits, axis=1).view(np.int64).ravel())
            at = pa.array(np.arange(batch.num_rows + 1) * (SKETCH // 64), pa.int32())
            total = np.concatenate([[0.0], np.cumsum(w, dtype=np.float64)])
            yield pa.RecordBatch.from_arrays([
                batch.column("node"), pa.ListArray.from_arrays(at, flat), pa.array(n, pa.int64()),
                pa.array(total[bounds[1:]] - total[bounds[:-1]])], names=["node", "sketch", "n", "w"])

    return store(texts.select("node", "text").mapInArrow(
        sketch, "node binary, sketch array<bigint>, n bigint, w double"), "neardup-sketches")


def _candidates(parted: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of a bucket whose components differ and that can be near.

    Bits in which two bitmaps differ stand for as many shingles, at least, that only one text has; each
    weighs ln(1 + ``SMOOTH``) or more.  A similarity of s needs a difference of at most (1 - s) / (1 + s)
    of both sizes together, and the sizes differ by no more.  A pair comes from the smallest of the keys
    that it shares.  The members of a bucket are dealt to blocks of about ``BLOCK``, and every two blocks, or a
    block and itself, meet in a cell of their own: a crowded bucket is compared by as many tasks as it has cells.
    """
    share = (1 - threshold) / (1 + threshold) + 1e-5  # more than the weights' rounding
    least = float(np.log(1 + SMOOTH))
    differ = "aggregate(zip_with(x.sketch, y.sketch, (p, q) -> p ^ q), 0, (n, z) -> n + bit_count(z))"
    keys = parted.groupBy("node").agg(F.collect_set("key").alias("keys"))  # one a band at most
    blocks = (parted.groupBy("key").agg(F.count("*").alias("n"))
              .select("key", F.ceil(F.col("n") / BLOCK).alias("blocks")))
    dealt = (parted.join(blocks, "key")
             .withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("key", "node", "root", "block", F.least("block", "other").alias("low"),
                     F.greatest("block", "other").alias("high")))
    rows = store(dealt.join(sketches, "node").join(keys, "node"), "neardup-rest")
    return (rows.alias("x").join(rows.alias("y"), F.expr(f"""
        x.key = y.key and x.low = y.low and x.high = y.high and x.root < y.root
        and (x.low = x.high or x.block != y.block)
        and (abs(x.n - y.n) <= {share!r}D * (x.n + y.n) or abs(x.w - y.w) <= {share!r}D * (x.w + y.w))
        and {differ} <= {share!r}D * greatest(x.n + y.n, (x.w + y.w) / {least!r}D)
        and array_min(array_intersect(x.keys, y.keys)) = x.key"""))
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")))


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The roots of all nodes once the components that the links (a, b) touch are one."""
    ends = (links.join(roots.toDF("a", "ra"), "a").join(roots.toDF("b", "rb"), "b")
            .select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    tops = store(components(ends), "neardup-tops").toDF("root", "top")
    return store(roots.join(tops, "root", "left")
                 .select("node", F.coalesce("top", "root").alias("root")), "neardup-roots")


def classes(docs: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``(id, node, class_id)`` for every row of ``docs``; see the module's text."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), node_of(F.col(text_col)).alias("node"),
                       F.col(text_col).alias("text"))
    texts = base.where("text is not null")
    df, n = document_frequencies(texts, "text")
    idf = spark.sparkContext.broadcast(inverse_frequencies(df, n))  # 2^18 floats

    sampled = store(_sampled(texts, idf, "text"), "neardup-bands")
    nodes = sampled.groupBy("node").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
    keyed = nodes.select("node", "rep", F.explode("bands").alias("key"))
    buckets = (keyed.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("n"))
               .where("n > 1").drop("n"))
    members = store(keyed.join(buckets, "key"), "neardup-members")

    # One text of each node that shares a bucket.
    wanted = members.groupBy("node").agg(F.first("rep").alias("rep"))
    held = texts.alias("t").join(wanted.alias("w"), F.expr("t.node = w.node and t.id <=> w.rep"))
    held = store(held.select("t.node", "t.text").dropDuplicates(["node"]), "neardup-texts")

    pairs = store(members.where("node != lead").select(F.col("lead").alias("a"), F.col("node").alias("b"))
                  .distinct(), "neardup-pairs")
    links = store(_verified(pairs, held, idf, threshold), "neardup-links")
    roots = store(held.select("node").join(components(links), "node", "left")
                  .select("node", F.coalesce("root", "node").alias("root")), "neardup-roots")
    tried, size = pairs, members.count()
    for turn in range(1, STAR_ROUNDS + 1):
        parted = members.join(roots, "node").select("key", "node", "root")
        sizes = parted.groupBy("key", "root").agg(F.count("*").alias("n"))
        split = (sizes.groupBy("key").agg(
            F.expr("sum(n) * sum(n) - sum(n * n)").alias("twice")).where("twice > 0"))
        parted = store(parted.join(split, "key"), "neardup-parted")
        left = parted.groupBy("key").agg(F.first("twice").alias("t")).agg(F.sum("t") / 2).first()[0]
        if not left:
            break
        every = turn == STAR_ROUNDS or left <= size
        if every:
            pairs = _candidates(parted, _sketched(held.join(parted.select("node").distinct(), "node"),
                                                  idf), threshold)
        else:
            lead = parted.groupBy("key").agg(F.min_by(
                F.struct("node", "root"), F.xxhash64("node", F.lit(turn))).alias("l"))
            pairs = (parted.alias("x").join(lead.select("key", "l.*").alias("y"),
                                            F.expr("x.key = y.key and x.root != y.root"))
                     .select(F.least("x.node", "y.node").alias("a"),
                             F.greatest("x.node", "y.node").alias("b")).distinct())
        pairs = store(pairs.join(tried, ["a", "b"], "left_anti"), "neardup-pairs")
        tried = tried.union(pairs)
        links = store(_verified(pairs, held, idf, threshold), "neardup-links")
        roots = _merged(roots, links)
        if every:
            break

    reps = (sampled.groupBy("node").agg(F.min("id").alias("rep")).join(roots, "node", "left")
            .select("node", "rep", F.coalesce("root", "node").alias("root")))
    reps = store(reps, "neardup-reps")
    named = reps.join(reps.groupBy("root").agg(F.min("rep").alias("class_id")), "root").select(
        "node", "class_id")
    without = base.where("text is null").select("id", "node", F.col("id").alias("class_id"))
    return (sampled.select("id", "node").join(named, "node").select("id", "node", "class_id")
            .unionByName(without))


def near_duplicates(docs: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(id_col, class_id)``, one row per row of ``docs``."""
    found = classes(docs, threshold=threshold, id_col=id_col, text_col=text_col)
    return found.select(F.col("id").alias(id_col), "class_id")


def one_of_each(docs: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each class: the one whose id names the class.

    Rows with a null text are kept.  Of rows equal in id and text, one is kept.
    """
    found = classes(docs, threshold=threshold, id_col=id_col, text_col=text_col)
    kept = (found.where("node is not null and id <=> class_id").groupBy("id", "node")
            .agg(F.count("*").alias("times")).select(F.col("id").alias("kept_id"),
                                                    F.col("node").alias("kept_node"), "times"))
    kept = store(kept, "neardup-kept")
    has_text = F.col(text_col).isNotNull()
    rows = docs.where(has_text).select(F.struct(*docs.columns).alias("row"),
                                       node_of(F.col(text_col)).alias("node"))
    rows = rows.join(kept, (F.col("node") == F.col("kept_node"))
                     & F.col(f"row.{id_col}").eqNullSafe(F.col("kept_id")))
    once = rows.where("times = 1").select("row.*")
    again = (rows.where("times > 1").groupBy("kept_id", "kept_node")
             .agg(F.first("row").alias("row")).select("row.*"))
    return once.unionByName(again).unionByName(docs.where(~has_text))

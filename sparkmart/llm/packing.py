"""Variable-capacity best-fit packing of documents into training sequences (operator 6).

A document's length is its number of tokens, runs of characters other than Unicode white space; documents
longer than the largest permitted sequence are cut into pieces of that length and a rest.  Pieces are
dealt by hash into groups of about ``GROUP`` pieces, and each group is packed on its own:

* pieces in descending order of length, each into the open bin with the least room that holds it;
* if none does, a bin opens with the permitted length of least net cost: ``OVERHEAD`` a sequence plus
  its tokens, less what the shorter pieces still to come can fill of its room;
* at the end every bin shrinks to the smallest permitted length that holds its contents.

Only the last bins of a group are badly filled, so the waste of grouping is about one bin in
``GROUP`` pieces, whatever the number of documents.

Cases: a null or empty text, or one without words, has one piece of length 0 in no bin (null bin);
repeated rows are counted first and each copy gets its own pieces and bins, in blocks of ``COPIES`` dealt
to tasks; different texts with one id are told apart by ``text_hash``; null ids are packed like others; no
rows give no rows; further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import store

CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 32  # cost of a sequence besides its tokens
GROUP = 4096
COPIES = 4096  # copies of a repeated row that one task writes out
# Unicode's White_Space beyond U+0009 to U+000D and U+0020, which \s holds.
_SPACES = "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
                            0x3000)))


def n_tokens(text: Column) -> Column:
    """Tokens of a text, counted without building them."""
    return F.regexp_count(F.translate(text, _SPACES, " " * len(_SPACES)), F.lit(r"\S+"))


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES,
         overhead: int = OVERHEAD) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and start of each piece, and the capacity of each bin.

    Pieces must be sorted in descending order and none may exceed the largest capacity.
    """
    sizes = sorted(capacities)
    after = np.concatenate([np.cumsum(lengths[::-1])[::-1], [0]])  # tokens from a piece on
    ascending = lengths[::-1]
    rooms: list[tuple[int, int]] = []  # (room, bin), ascending
    used: list[int] = []
    bins, starts = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, n in enumerate(lengths.tolist()):
        at = bisect_left(rooms, (n, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            def net(c: int) -> int:
                """Cost of opening a bin of c tokens for this piece, less what may still fill it."""
                room = c - n
                first = max(k + 1, len(lengths) - int(np.searchsorted(ascending, room, "right")))
                return overhead + c - min(room, int(after[first]))

            room = min((c for c in sizes if c >= n), key=lambda c: (net(c), c))
            b = len(used)
            used.append(0)
        bins[k], starts[k] = b, used[b]
        used[b] += n
        if room > n:
            insort(rooms, (room - n, b))
    return bins, starts, [next(c for c in sizes if c >= u) for u in used]


def pieces(docs: DataFrame, largest: int, *, id_col: str, text_col: str) -> DataFrame:
    """``id, n_tokens, text_hash, copy, piece, start, length``: documents cut at multiples of ``largest``
    tokens.  Rows with one id and one text are told apart by ``copy``, from 1.
    """
    row = ["id", "n_tokens", "text_hash"]
    sized = docs.select(F.col(id_col).alias("id"),
                        F.coalesce(n_tokens(F.col(text_col)), F.lit(0)).alias("n_tokens"),
                        F.xxhash64(text_col).alias("text_hash"))
    counted = sized.groupBy(*row).agg(F.count("*").alias("copies"))
    blocks = counted.select(*row, "copies", F.explode(F.sequence(
        F.lit(1).cast("long"), F.col("copies"), F.lit(COPIES).cast("long"))).alias("first"))
    return (blocks.repartition(*row, "first")
            .select(*row, F.explode(F.sequence("first", F.least(
                F.col("copies"), F.col("first") + COPIES - 1))).alias("copy"))
            .select(*row, "copy", F.posexplode(F.sequence(
                F.lit(0), F.greatest(F.col("n_tokens") - 1, F.lit(0)), F.lit(largest))).alias("piece", "start"))
            .select(*row, "copy", "piece", "start",
                    F.least(F.col("n_tokens") - F.col("start"), F.lit(largest)).alias("length")))


def pack_documents(docs: DataFrame, *, capacities: tuple[int, ...] = CAPACITIES,
                   overhead: int = OVERHEAD, group: int = GROUP, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per piece: ``id_col, n_tokens, text_hash, copy, piece, start, length, bin_group, bin,
    capacity, offset``.

    A bin is named by (bin_group, bin); ``offset`` is the place of the piece in its sequence.
    """
    cut = store(pieces(docs, max(capacities), id_col=id_col, text_col=text_col), "packing-pieces")
    total = cut.where("length > 0").count()
    groups = max(1, -(-total // group))
    dealt = cut.where("length > 0").withColumn(
        "bin_group", F.pmod(F.xxhash64("id", "n_tokens", "text_hash", "copy", "piece"), F.lit(groups)))
    schema = T.StructType([*dealt.schema, T.StructField("bin", T.LongType()),
                           T.StructField("capacity", T.IntegerType()),
                           T.StructField("offset", T.LongType())])

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("id", "ascending"), ("n_tokens", "ascending"),
                               ("text_hash", "ascending"), ("copy", "ascending"), ("piece", "ascending")])
        bins, starts, sizes = pack(table["length"].to_numpy(), capacities, overhead)
        return (table.append_column("bin", pa.array(bins))
                .append_column("capacity", pa.array(np.array(sizes, np.int32)[bins]))
                .append_column("offset", pa.array(starts)))

    packed = dealt.groupBy("bin_group").applyInArrow(place, schema)
    empty = cut.where("length = 0").select(
        "*", *[F.lit(None).cast(schema[c].dataType).alias(c)
               for c in ("bin_group", "bin", "capacity", "offset")])
    return packed.unionByName(empty).withColumnRenamed("id", id_col)

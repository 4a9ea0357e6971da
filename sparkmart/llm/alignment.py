"""Alignment of two tokenizers over one text by sparse incidence matrices (operator 13).

Space + text is encoded by a byte-level BPE (A) and, as the text itself, by a SentencePiece model (B), which
puts the space there.  Both then cover the same bytes.

1. A space between two characters that are no white space starts a token of A (its pattern takes such a
   space with what follows) and of B (no piece holds a space after something else; checked when the model
   is loaded).  What lies between such spaces is a *segment*: it is encoded alone, with one result wherever
   it stands, and each worker keeps the results of frequent segments.
2. The tokens of new segments are rows of two token-byte incidence matrices in compressed rows.  The product
   A * B' by Gustavson's rows has an entry for each pair of tokens that share bytes: the *overlap links*.
3. Places where tokens of both end cut the tokens into groups.  The products of the segment-by-group count
   matrices of A and B have the *shared-group links* of each segment on their diagonal; pairs within a
   group are never written out, so a group may have any size.
4. Texts are handled in blocks of about ``BLOCK`` bytes.  A block gives one row for each document (its
   segments) and one for the id pairs of its links.  Pairs are counted over the corpus and their counts go
   back to each block, once per block and pair; so what is shuffled grows with the blocks' distinct pairs,
   not with the links.
5. Each block adds up its documents' segments.

Cases: null and empty texts, and texts that a tokenizer does not give back byte for byte, have no tokens:
zeros and an empty digest; they add nothing to the corpus counts.  Repeated rows and ids and null ids keep
their rows; further columns are ignored; no rows give no rows.  Special tokens' strings are plain text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import store
from .csr import Csr, incidence, membership, product, ranges

MODEL_A = "/opt/tokenizers/byte_bpe_50k.json"
MODEL_B = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK = 4 << 20  # characters of texts handled together
HELD = 200_000  # segments that a worker keeps from block to block
LEARNT = 1 << 15  # segments encoded together
LONG = 10_000  # characters of a segment that goes to the tokenizer with a heap of merges
PART = 1 << 20  # characters of a long text that are cut into segments at once
#: Fixed value: how A's byte-level pre-tokenizer cuts a text.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SEGMENT = re.compile(r" \S++(?= \S)|[\s\S]+?(?:(?<=\S)(?= \S)|\Z)")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others
    for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def bytes_of_a(path: str) -> dict[int, bytes]:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    return {i: bytes(letters[c] for c in token) for token, i in spec["model"]["vocab"].items()}


def merges_in_order(path: str) -> bool:
    """Whether the ids of the merged tokens follow the order of the merges, so that ids serve as ranks."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"][x + y] for x, y in pairs]
    return all(i < j for i, j in zip(ids, ids[1:])) and (not ids or ids[0] == 256)


def bytes_of_b(path: str) -> dict[int, bytes]:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if re.search("[^▁]▁", piece):
            raise ValueError(f"piece {i} holds a space after something else: {piece!r}")
        pieces[i] = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
    return pieces


class Aligner:
    """Segments and what their alignment gives; filled as texts come."""

    def __init__(self, path_a: str, path_b: str):
        import tiktoken
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = _listed(bytes_of_a(path_a)), _listed(bytes_of_b(path_b))
        self.lengths_a, self.lengths_b = (np.fromiter(map(len, tokens), np.int64, len(tokens))
                                          for tokens in (self.bytes_a, self.bytes_b))
        # the same merges without offsets and strings of tokens, which is several times faster
        self.ranks = tiktoken.Encoding("a", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            token: i for i, token in enumerate(self.bytes_a) if token}) if merges_in_order(path_a) else None
        self.written_a = [[f"{i}{end}" for i in range(len(self.bytes_a))] for end in ",|"]
        self.written_b = [[f"{i}{end}" for i in range(len(self.bytes_b))] for end in ",;\n"]
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.groups: list[str] = []  # by segment: ids of A and B by group
        # by segment: whole, tokens of A, of B, groups, overlap links, shared-group links
        self.facts = np.empty((0, 6), np.int64)
        # by segment: its id pairs (A's id and B's id in one number) and how many links hold them
        self.pairs = Csr(np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), 0)

    @staticmethod
    def parts(text: str) -> Iterator[str]:
        """Space + ``text`` in pieces of about ``PART`` characters, cut between segments."""
        text, at = " " + text, 0
        while len(text) - at > PART and (cut := _CUT.search(text, at + PART)):
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    @classmethod
    def segments(cls, text: str) -> list[str]:
        """The segments of space + ``text``."""
        return [s for part in cls.parts(text) for s in _SEGMENT.findall(part)]

    def number(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of the segments of each text; an empty text has none."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0

        def flush() -> None:
            numbers = self.numbers
            new = list(dict.fromkeys(s for _, segments in held for s in segments if s not in numbers))
            for at in range(0, len(new), LEARNT):
                self.learn(new[at:at + LEARNT])
            for i, segments in held:
                out[i].append(np.fromiter(map(numbers.__getitem__, segments), np.int64, len(segments)))
            held.clear()

        for i, text in enumerate(texts):
            for part in self.parts(text) if text else ():
                held.append((i, _SEGMENT.findall(part)))
                size += len(part)
                if size >= PART:
                    flush()
                    size = 0
        flush()
        return [np.concatenate([np.empty(0, np.int64), *arrays]) for arrays in out]

    def encoded(self, new: list[str]) -> list[list[int]]:
        """A's ids of each segment."""
        if self.ranks is None:
            return [e.ids for e in self.a.encode_batch(new, add_special_tokens=False)]
        return [self.ranks.encode_ordinary(s) if len(s) < LONG else
                self.a.encode(s, add_special_tokens=False).ids for s in new]

    def learn(self, new: list[str]) -> None:
        ids_a, ids_b = self.encoded(new), self.b.encode([s[1:] for s in new], num_threads=1)
        raw = [s.encode() for s in new]
        whole = np.ones(len(new), bool)
        for tokens, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b)):
            joined = [b"".join(map(tokens.__getitem__, i)) for i in ids]
            if joined != raw:
                whole &= np.fromiter((x == y for x, y in zip(joined, raw)), bool, len(new))
        for i in np.flatnonzero(~whole).tolist():
            ids_a[i], ids_b[i] = [], []
        facts, pairs, groups = self.align(ids_a, ids_b)
        self.numbers.update(zip(new, range(len(self.numbers), len(self.numbers) + len(new))))
        self.groups += groups
        self.facts = np.concatenate([self.facts, np.column_stack([whole, facts])])
        self.pairs = Csr(np.concatenate([self.pairs.indptr, self.pairs.indptr[-1] + pairs.indptr[1:]]),
                         np.concatenate([self.pairs.indices, pairs.indices]),
                         np.concatenate([self.pairs.data, pairs.data]), 0)

    def align(self, ids_a: list[list[int]], ids_b: list[list[int]]) -> tuple[np.ndarray, Csr, list[str]]:
        """Of segments whose tokens cover the same bytes: tokens of A, of B, groups, overlap links and
        shared-group links of each; its id pairs with their links; its groups as text."""
        a, n_a = _flat(ids_a)
        b, n_b = _flat(ids_b)
        rows_a, rows_b = incidence(self.lengths_a[a]), incidence(self.lengths_b[b])
        links = product(rows_a, rows_b.transposed())
        of_a = np.repeat(np.arange(len(n_a)), n_a)
        of_b = np.repeat(np.arange(len(n_b)), n_b)

        ends_of_a = np.zeros(rows_a.n_columns + 1, bool)
        ends_of_a[rows_a.indptr[1:]] = True
        ends = rows_b.indptr[1:][ends_of_a[rows_b.indptr[1:]]]
        group_a = np.searchsorted(ends, rows_a.indptr[1:])
        group_b = np.searchsorted(ends, rows_b.indptr[1:])
        in_a = product(membership(of_a, len(n_a)).transposed(), membership(group_a, len(ends)))
        in_b = product(membership(of_b, len(n_b)).transposed(), membership(group_b, len(ends)))
        shared = product(in_a, in_b.transposed())  # segments share no groups: a diagonal
        n_shared = np.zeros(len(n_a), np.int64)
        n_shared[shared.rows()] = shared.data

        segment = of_a[links.rows()]
        key = a[links.rows()] << 32 | b[links.indices]
        order = np.lexsort((key, segment))
        key, segment = key[order], segment[order]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (segment[1:] != segment[:-1])
        at = np.flatnonzero(first)
        per_segment = np.bincount(segment[at], minlength=len(n_a))
        pairs = Csr(np.concatenate([[0], np.cumsum(per_segment)]), key[at],
                    np.diff(np.append(at, len(key))), 0)
        facts = np.column_stack([n_a, n_b, np.diff(in_a.indptr),
                                 np.bincount(segment, minlength=len(n_a)), n_shared])

        # the last token of a group is followed by | in A and ; in B, the last of a segment by a line end
        end_a = np.diff(group_a, append=len(ends)) > 0
        end_b = (np.diff(group_b, append=len(ends)) > 0) + (np.diff(of_b, append=len(n_b)) > 0).astype(int)
        words = [self.written_a[e][i] for i, e in zip(a.tolist(), end_a.tolist())]
        words += [self.written_b[e][i] for i, e in zip(b.tolist(), end_b.tolist())]
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        lines = iter("".join(map(words.__getitem__, order.tolist())).split("\n"))
        return facts, pairs, [next(lines) if n else "" for n in n_b.tolist()]


def _listed(tokens: dict[int, bytes]) -> list[bytes]:
    return [tokens.get(i, b"") for i in range(max(tokens) + 1)]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner: tasks of one Python worker share it."""
    return Aligner(path_a, path_b)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (by row) between consecutive bounds."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _encoded(path_a: str, path_b: str, names: list[str]):
    """Batches of (block number's partition, id, text) to rows of documents and of blocks."""
    def block_rows(known: Aligner, block: int, ids: list, texts: list[str]) -> pa.RecordBatch:
        if len(known.numbers) > HELD:
            known.clear()
        numbers = known.number(texts)
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in numbers])]).astype(np.int64)
        every = np.concatenate([np.empty(0, np.int64), *numbers])
        whole = _sums(known.facts[:, 0][every], bounds) == np.diff(bounds)
        sums = [_sums(known.facts[:, c][every], bounds) * whole for c in range(1, 6)]
        digests = [hashlib.sha256(";".join(map(known.groups.__getitem__, x.tolist())).encode()).hexdigest()
                   if ok and len(x) else "" for x, ok in zip(numbers, whole)]
        used, local = np.unique(np.concatenate([np.empty(0, np.int64), *[
            x for x, ok in zip(numbers, whole) if ok]]), return_inverse=True)
        held, at = [], 0
        for x, ok in zip(numbers, whole):
            held.append(local[at:at + len(x)].astype(np.uint32).tobytes() if ok else b"")
            at += len(x) * bool(ok)
        times = np.bincount(local, minlength=len(used))
        width = np.diff(known.pairs.indptr)[used]
        entries = ranges(known.pairs.indptr[used], width)
        key, pair = np.unique(known.pairs.indices[entries], return_inverse=True)
        each = known.pairs.data[entries]
        total = np.zeros(len(key), np.int64)
        np.add.at(total, pair, each * np.repeat(times, width))
        n = len(ids)
        columns = [pa.array([block] * (n + 1), pa.int64()), pa.array([*ids, None], names[0]),
                   *[pa.array([*s.tolist(), None], pa.int64()) for s in sums],
                   pa.array([*digests, None], pa.string()), pa.array([*held, None], pa.binary()),
                   *[pa.array([None] * n + [x], pa.list_(pa.int64()))
                     for x in (key.tolist(), total.tolist())],
                   *[pa.array([None] * n + [x.astype(np.uint32).tobytes()], pa.binary())
                     for x in (width, pair, each)]]
        return pa.RecordBatch.from_arrays(columns, names[1:])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(path_a, path_b)
        ids, texts, size, block = [], [], 0, None
        for batch in batches:
            for part, name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                        batch.column(2)):
                text = text.as_py() or ""
                block = part << 32 if block is None else block
                ids.append(name)
                texts.append(text)
                size += len(text)
                if size >= BLOCK:
                    yield block_rows(known, block, ids, texts)
                    ids, texts, size, block = [], [], 0, block + 1
        if ids:
            yield block_rows(known, block, ids, texts)

    return encoded


def _added(out_names: list[str]):
    """One block's rows and the corpus counts of its pairs to its documents' results."""
    def added(left: pa.Table, right: pa.Table) -> pa.Table:
        is_block = left["keys"].is_valid().to_numpy(zero_copy_only=False)
        docs = left.filter(pa.array(~is_block))
        row = left.filter(pa.array(is_block)).to_pylist()[0]
        width, pair, each = (np.frombuffer(row[c], np.uint32).astype(np.int64)
                             for c in ("width", "pair", "each"))
        count = np.zeros(len(row["keys"]), np.int64)
        best = np.zeros(len(row["keys"]), np.int64)
        at = right["i"].to_numpy()
        count[at] = right["n_corpus"].to_numpy()
        best[at] = right["is_best"].to_numpy()
        bounds = np.concatenate([[0], np.cumsum(width)])
        value = _sums(np.column_stack([each * best[pair], each * count[pair]]), bounds)
        sums = [value[np.frombuffer(s, np.uint32)].sum(axis=0).tolist()
                for s in docs["segments"].to_pylist()]
        docs = docs.append_column("n_best", pa.array([s[0] for s in sums], pa.int64()))
        docs = docs.append_column("count_sum", pa.array([s[1] for s in sums], pa.int64()))
        return docs.select(out_names)

    return added


def align_documents(docs: DataFrame, path_a: str = MODEL_A, path_b: str = MODEL_B, *,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256,
    n_shared``; see the contract of operator 13; ``n_shared`` counts pairs of tokens within one group."""
    id_type = docs.schema[id_col].dataType
    counts = ["n_a", "n_b", "n_groups", "n_links", "n_shared"]
    long, raw = T.LongType(), T.BinaryType()
    schema = T.StructType([
        T.StructField(n, t) for n, t in [
            ("block", long), ("id", id_type), *[(c, long) for c in counts], ("groups_sha256", T.StringType()),
            ("segments", raw), ("keys", T.ArrayType(long)), ("totals", T.ArrayType(long)),
            ("width", raw), ("pair", raw), ("each", raw)]])
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.spark_partition_id().cast("long").alias("part"), F.col(id_col).alias("id"),
                       F.col(text_col).alias("text"))
    encode = _encoded(path_a, path_b, [to_arrow_type(id_type), *schema.names])
    blocks = store(rows.mapInArrow(encode, schema), "alignment-blocks")

    used = blocks.where("keys is not null").select("block", F.posexplode(F.arrays_zip("keys", "totals"))).select(
        "block", F.col("pos").alias("i"), F.col("col.keys").alias("key"), F.col("col.totals").alias("n"))
    corpus = used.groupBy("key").agg(F.sum("n").alias("n_corpus"))
    # a row per id of A at most under one id of B
    of_b = Window.partitionBy(F.col("key").bitwiseAND(0xFFFFFFFF))
    corpus = corpus.withColumn("is_best", (F.col("n_corpus") == F.max("n_corpus").over(of_b)).cast("long"))
    counted = used.join(corpus, "key").select(F.col("block").alias("of"), "i", "n_corpus", "is_best")

    out = ["id", *counts[:4], "n_best", "count_sum", "groups_sha256", "n_shared"]
    out_schema = T.StructType([T.StructField(n, id_type if n == "id" else T.StringType()
                                             if n == "groups_sha256" else long) for n in out])
    done = blocks.groupBy("block").cogroup(counted.groupBy("of")).applyInArrow(_added(out), out_schema)
    return done.select(F.col("id").alias(id_col), *out[1:])

"""SentencePiece encoding and decoding by a max-plus parallel scan (operator 10).

A text is cut into the pieces of a vocabulary whose scores have the largest sum (unigram decoding).
Texts of at most ``CHUNK`` characters are one chunk and are decoded in one go.  Longer ones are cut
into chunks:

1. Each chunk yields its transfer matrix M[e][x]: the best score when the piece before covers the
   chunk's first e characters and its own last piece reaches x characters into the next one.
2. Matrices combine by the max-plus product, which is associative: first in groups of ``FAN`` chunks,
   then the groups of a text.  The best states at the bounds of the groups, and from them at the
   bounds of the chunks, follow from the products.
3. With its two states given, each chunk is traced on its own.

Scores are integers, so sums are exact in any order, and ties are broken by a further, far smaller term
that depends on the places of the cuts alone.  The result is the same for every chunk size.

Vocabulary: the normal pieces of a SentencePiece file, whose path is a parameter.  The score of the
piece with rank r among them is ln(1 / r) by Zipf's law, in steps of 1/1024, because the scores of a
BPE file are merge ranks and no log probabilities.  A character in no piece becomes its UTF-8 bytes.
A space is U+2581 in pieces, and a text starts with one more; U+2581 itself becomes bytes, so decoding
gives back exactly the text.  No piece of the file holds a space after something else, a line end, or
a mark or digit after a letter, so the parts of a text between such places are independent, and the
pieces of a frequent part are kept (``CACHE`` parts a worker, and as many tokens, that is parts between two
spaces).  Files with such pieces have larger parts.  New tokens of up to ``SHORT`` characters are decoded
together, place by place, by the same recurrence as the others; their sums fit 64 bits.

Cases: null and empty texts have no pieces; repeated rows and ids and null ids each keep their row;
further columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import store
from .text import U, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 32768
FAN = 64
CACHE = 400_000
SHORT = 64
BATCH = 1 << 19  # characters of the texts whose new parts are decoded together
_SHIFT = 40  # a step of the score is more than the tie-breaking terms of 256 pieces
_PREFIX = 1  # instead of a score (at most 0): the start of longer pieces only
_MARK, _LITERAL = "▁", "\udc81"  # a space; U+2581 in the text, a code that no text can hold
_DIGEST = 1 << 40


def load_pieces(path: str) -> tuple[list[tuple[str, int]], list[int]]:
    """The normal pieces with their ids, and the ids of the 256 byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    normal, raw = [], [0] * 256
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            raw[int(model.id_to_piece(i)[3:5], 16)] = i
        elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
            normal.append((model.id_to_piece(i), i))
    return normal, raw


def _tie(place: int) -> int:
    """32 pseudo-random bits of a cut's place in its word."""
    x = (place + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    x = (x ^ x >> 27) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    return x >> 32


_TIES = [_tie(place) for place in range(1 << 12)]


_TOKENS = re.compile(f"{_MARK}+[^{_MARK}\n]*|\n[^{_MARK}\n]*")


class Numbers(dict):
    """Numbers of tokens, and the ids of their pieces; tokens asked for the first time wait in ``new``."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.ids = np.zeros(0, np.int32)
        self.n, self.start = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, token: str) -> int:
        self.new.append(token)
        got = self[token] = len(self)
        return got

    def learn(self, ids: np.ndarray, n: np.ndarray) -> None:
        """The pieces of the tokens in ``new``, one token's after the other's."""
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(n) - n])
        self.n, self.ids = np.concatenate([self.n, n]), np.concatenate([self.ids, ids.astype(np.int32)])
        self.new = []


class Lattice:
    def __init__(self, normal: list[tuple[str, int]], raw: list[int]):
        zipf = -np.rint(1024 * np.log(np.arange(1, len(normal) + 1))).astype(int)
        self.score = {p: int(s) << _SHIFT for (p, _), s in zip(normal, zipf)}
        self.id = dict(normal)
        self.raw = raw
        self.fallback = (int(zipf.min()) - 10 * 1024) << _SHIFT  # of a character in no piece
        self.nodes = {p[:n]: _PREFIX for p in self.id for n in range(1, len(p))} | self.score
        self.width = max(map(len, self.id))  # states at a bound: 0 .. width - 1
        self.text_of = {i: p for p, i in normal} | {i: chr(0xDC00 + b) if b > 127 else chr(b)
                                                   for b, i in enumerate(raw)}
        # Parts ("words") begin at a run of spaces after something else, at a line end, and at a mark
        # after another character, if no piece goes across such a place.
        pairs = {(a, b) for p in self.id for a, b in zip(p, p[1:])}
        whole = any(_MARK in p.lstrip(_MARK) or "\n" in p for p in self.id)
        marks = {c for p in self.id for c in p if not c.isalpha() and c not in (_MARK, "\n")}
        while out := {b for a, b in pairs if b in marks and a != _MARK and a not in marks}:
            marks -= out
        kind = "".join(re.escape(c) for c in sorted(marks))
        first = f"[{kind}]*" if marks else ""
        self.words = re.compile(".+" if whole else f"\n|{_MARK}*{first}[^{_MARK}\n{kind}]+|"
                                f"{_MARK}*[{kind or _MARK}]+|{_MARK}+", re.S)
        self.apart = not whole  # parts begin at every run of spaces and at every line end
        self.cache: dict[str, tuple[int, tuple[int, ...]]] = {}
        self.tokens = Numbers()

        # the tree of pieces: moves (node, letter) -> node, sorted; score and id of each node's piece
        number = {node: k for k, node in enumerate(["", *self.nodes])}
        letters = sorted(set("".join(self.id)))
        self.letter = np.zeros(0x110000, np.int32)  # 0: in no piece
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.n_letters = len(letters) + 1
        moves = np.array([number[node[:-1]] * self.n_letters + int(self.letter[ord(node[-1])])
                          for node in self.nodes], np.int64)
        order = np.argsort(moves)
        self.moves, self.reached = moves[order], order + 1
        self.node_score = np.array([_PREFIX, *self.nodes.values()], np.int64)
        self.node_id = np.array([-1, *[self.id.get(node, -1) for node in self.nodes]], np.int64)

    def reach(self, s: str, entry: int, stop: int, offset: int) -> tuple[list, list]:
        """Best scores and last cuts before all places of ``s``, from ``entry``, where pieces start
        before ``stop``; ``offset`` is the place of ``s`` in its word."""
        best: list = [None] * (len(s) + 1)
        back = [0] * (len(s) + 1)
        best[entry] = 0
        nodes, n = self.nodes, len(s)
        ties = _TIES if offset + n < len(_TIES) else [_tie(offset + j) for j in range(n + 1)]
        shift = offset if ties is _TIES else 0
        for i in range(entry, min(stop, n)):
            here = best[i]
            if here is None:
                continue
            j = i + 1
            value = nodes.get(s[i:j])
            if value is None or value == _PREFIX:
                found = here + self.fallback + ties[shift + j]
                if best[j] is None or found > best[j]:
                    best[j], back[j] = found, i
            while value is not None:
                if value != _PREFIX:
                    found = here + value + ties[shift + j]
                    old = best[j]
                    if old is None or found > old:
                        best[j], back[j] = found, i
                j += 1
                if j > n:
                    break
                value = nodes.get(s[i:j])
        return best, back

    def ids(self, piece: str) -> list[int]:
        i = self.id.get(piece)
        if i is not None:
            return [i]
        return [self.raw[b] for b in (_MARK if piece == _LITERAL else piece).encode()]

    def path(self, s: str, back: list, entry: int, end: int) -> list[int]:
        cuts = [end]
        while cuts[-1] > entry:
            cuts.append(back[cuts[-1]])
        cuts.reverse()
        return [i for a, b in zip(cuts, cuts[1:]) for i in self.ids(s[a:b])]

    def word(self, s: str) -> tuple[int, tuple[int, ...]]:
        """Best score and ids of a whole word."""
        got = self.cache.get(s)
        if got is None:
            best, back = self.reach(s, 0, len(s), 0)
            got = best[-1], tuple(self.path(s, back, 0, len(s)))
            if len(self.cache) >= CACHE:
                self.cache.clear()
            if len(s) <= SHORT:
                self.cache[s] = got
        return got

    def together(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many tokens of up to ``SHORT`` characters, and how many each has: what ``reach`` and ``path`` do
        at a place of one part, for all tokens at once."""
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        first = np.concatenate([[0], np.cumsum(size + 1)[:-1]])  # of a token's places, one more than characters
        text = "\n".join(tokens) + "\n"  # a line end is a part of its own
        letter = self.letter[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
        part = np.fromiter(map(len, self.words.findall(text)), np.int64)
        in_part = np.arange(len(text)) - np.repeat(np.cumsum(part) - part, part)
        owner = np.repeat(np.arange(len(tokens)), size)
        at = np.arange(len(owner)) + owner  # the place before each character

        # all pieces from all places, a letter longer at a time; a single letter in no piece is one as well
        node, start, end, found = np.zeros(len(at), np.int64), at, (first + size)[owner], []
        for n in range(1, self.width + 1):
            move = node * self.n_letters + letter[start + n - 1]
            k = np.minimum(np.searchsorted(self.moves, move), len(self.moves) - 1)
            node = np.where(self.moves[k] == move, self.reached[k], 0)  # 0, the root: no piece begins so
            score, piece = self.node_score[node], self.node_id[node]
            if n == 1:
                found.append((start, np.full(len(start), n), np.where(piece < 0, self.fallback, score), piece))
            else:
                whole = piece >= 0
                found.append((start[whole], np.full(whole.sum(), n), score[whole], piece[whole]))
            on = (node != 0) & (start + n < end)
            node, start, end = node[on], start[on], end[on]
            if not len(start):
                break
        start, length, score, piece = (np.concatenate(c) for c in zip(*found))
        score = score + np.array(_TIES[:SHORT + 1], np.int64)[in_part[start] + length]
        place = start - first[np.repeat(np.arange(len(tokens)), size + 1)[start]]
        group = (place * (self.width + 1) + length).astype(np.int32)  # the ends of a group's pieces differ
        order = np.argsort(group, kind="stable")
        start, length, score, piece, group = (c[order] for c in (start, length, score, piece, group))
        best = np.full(len(letter), np.iinfo(np.int64).min)
        best[first] = 0
        back, last = np.zeros(len(letter), np.int64), np.full(len(letter), -1)
        cuts = (np.flatnonzero(np.diff(group)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(group)]):
            begin = start[a:b]
            to, value = begin + length[a:b], best[begin] + score[a:b]
            better = np.flatnonzero(value > best[to])
            to = to[better]
            best[to], back[to], last[to] = value[better], begin[better], piece[a:b][better]

        # from the ends back to the starts
        on_way, here, of = np.zeros(len(letter), bool), first + size, np.arange(len(tokens))
        while len(here):
            on_way[here] = True
            here = back[here]
            on = here > first[of]
            here, of = here[on], of[on]
        ends = np.flatnonzero(on_way)
        ids, of = last[ends], np.repeat(np.arange(len(tokens)), size + 1)[ends]
        bytes_at = np.flatnonzero(ids < 0)  # a character in no piece becomes its bytes
        if len(bytes_at):
            raw = [self.ids(text[k - 1]) for k in ends[bytes_at].tolist()]
            times = np.ones(len(ids), np.int64)
            times[bytes_at] = [len(r) for r in raw]
            ids, of = np.repeat(ids, times), np.repeat(of, times)
            ids[ids < 0] = list(chain.from_iterable(raw))
        return ids, np.bincount(of, minlength=len(tokens))

    def wholes(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of the pieces of whole marked texts."""
        if not self.apart:
            yield from (np.array([i for part in self.words.findall(s) for i in self.word(part)[1]], np.int32)
                        for s in texts)
            return
        at = 0
        while at < len(texts):
            end, n = at, 0
            while end < len(texts) and (end == at or n + len(texts[end]) <= BATCH):
                n += len(texts[end])
                end += 1
            yield from self._wholes(texts[at:end])
            at = end

    def _wholes(self, texts: list[str]) -> list[np.ndarray]:
        known = self.tokens
        if len(known) >= CACHE:
            known.forget()
        rows = []
        for s in texts:
            # a token is a line end or a run of spaces with what follows it; its name lacks the first space
            t = s.replace("\n", _MARK + "\n")
            if _MARK + _MARK not in t:
                names = t.split(_MARK)[1:]
            else:
                names = [k[1:] if k[0] == _MARK else k for k in _TOKENS.findall(s)]
            rows.append(list(map(known.__getitem__, names)))
        if known.new:
            new = [k if k.startswith("\n") else _MARK + k for k in known.new]
            short = [k for k in new if len(k) <= SHORT]
            ids, n = self.together(short) if short else (np.zeros(0, int), np.zeros(0, int))
            if len(short) < len(new):
                held = iter(np.split(ids, np.cumsum(n)[:-1]) if short else ())
                each = [next(held) if len(k) <= SHORT else
                        [i for part in self.words.findall(k) for i in self.word(part)[1]] for k in new]
                ids, n = np.concatenate(each), np.array([len(e) for e in each])
            known.learn(ids, n)
        took = np.fromiter(chain.from_iterable(rows), np.int64)
        n, start = known.n[took], known.start[took]
        ends = np.cumsum(n)
        ids = known.ids[np.repeat(start - (ends - n), n) + np.arange(n.sum())]
        size = np.cumsum([len(r) for r in rows])
        return np.split(ids, np.concatenate([[0], ends])[size[:-1]])

    def chunk(self, body: str, n: int, offset: int) -> tuple[list[tuple[int, int]], int, int]:
        """Word spans of a chunk of ``n`` characters and a look ahead, and which of them, counted from
        the first and after the last, lie whole inside the chunk."""
        spans = [m.span() for m in self.words.finditer(body) if m.start() < n]
        first = 1 if spans and (offset or spans[0][1] > n) else 0
        last = len(spans) - (len(spans) > first and spans[-1][1] > n)
        return spans, first, last

    def transfer(self, body: str, n: int, offset: int) -> list[list]:
        w = self.width
        spans, first, last = self.chunk(body, n, offset)
        inside = sum(self.word(body[a:b])[0] for a, b in spans[first:last])
        ends: list = [None] * w
        if last < len(spans):  # from the start of the last word past the end of the chunk
            a, b = spans[last]
            tail, _ = self.reach(body[a:b], 0, n - a, 0)
            ends = [tail[n + x - a] if n + x <= b else None for x in range(w)]
        elif last > first or not spans or spans[-1][1] == n:
            ends[0] = 0
        matrix = []
        for e in range(w):
            row: list = [None] * w
            if e >= n:
                if e - n < w:
                    row[e - n] = 0
            elif first:  # a word that began before, or that is longer than the chunk
                b = spans[0][1]
                if e <= b:
                    head, _ = self.reach(body[:b], e, n, offset)
                    if b > n or (b == n and len(spans) == 1):
                        row = [head[n + x] if n + x <= b else None for x in range(w)]
                    elif head[b] is not None:
                        row = [None if v is None else head[b] + inside + v for v in ends]
            elif e == 0:
                row = [None if v is None else inside + v for v in ends]
            matrix.append(row)
        return matrix

    def trace(self, body: str, n: int, offset: int, entry: int, leave: int) -> list[int]:
        """Ids of the pieces that start in the chunk, given its states."""
        if entry >= n:
            return []
        spans, first, last = self.chunk(body, n, offset)
        out: list[int] = []
        if first:
            b = spans[0][1]
            end = min(b, n + leave)
            _, back = self.reach(body[:b], entry, n, offset)
            out += self.path(body, back, entry, end)
        for a, b in spans[first:last]:
            out += self.word(body[a:b])[1]
        if last < len(spans) and last >= first:
            a, b = spans[last]
            _, back = self.reach(body[a:b], 0, n - a, 0)
            out += self.path(body[a:b], back, 0, n + leave - a)
        return out

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The characters of the pieces; a space is a space, also the one before the text."""
        s = "".join(map(self.text_of.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids)).replace(_MARK, " ")
        return s if s.isascii() else s.encode("utf-8", "surrogateescape").decode("utf-8", "surrogateescape")


def marked(text: str) -> str:
    return _MARK + text.replace(_MARK, _LITERAL).replace(" ", _MARK) if text else ""


def n_bytes(s: str) -> int:
    """UTF-8 bytes that a marked text stands for."""
    return len(s.replace(_MARK, " ").replace(_LITERAL, _MARK).encode())


def product(a: list[list], b: list[list]) -> list[list]:
    """Max-plus product."""
    out = []
    for row in a:
        got: list = [None] * len(b[0])
        for u, other in zip(row, b):
            if u is not None:
                for x, v in enumerate(other):
                    if v is not None and (got[x] is None or u + v > got[x]):
                        got[x] = u + v
        out.append(got)
    return out


def states(matrices: list[list[list]], entry: int, leave: int) -> list[tuple[int, int]]:
    """Entry and exit state of each matrix on the best way from ``entry`` to ``leave``."""
    vectors = [[0 if e == entry else None for e in range(len(matrices[0]))]]
    for m in matrices:
        vectors.append(product([vectors[-1]], m)[0])
    out = []
    for v, m in zip(reversed(vectors[:-1]), reversed(matrices)):
        e = max((e for e in range(len(v)) if v[e] is not None and m[e][leave] is not None),
                key=lambda e: v[e] + m[e][leave])
        out.append((e, leave))
        leave = e
    return out[::-1]


def cut(text: str, size: int, lattice: Lattice) -> list[tuple[int, str, int, int]]:
    """Chunks (start, body with the look ahead, characters, place in the word) of a marked text."""
    out, word = [], 0
    starts = iter(m.start() for m in lattice.words.finditer(text))
    following = next(starts, None)
    for at in range(0, len(text), size):
        while following is not None and following <= at:
            word, following = following, next(starts, None)
        n = min(size, len(text) - at)
        out.append((at, text[at:at + n + lattice.width - 1], n, at - word))
    return out


_RESULT = [T.StructField("n_pieces", T.LongType()), T.StructField("digest", T.LongType()),
           T.StructField("round_trip", T.BooleanType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]


def _summary(lattice: Lattice, ids: list[int] | np.ndarray, source: str, start: int) -> tuple[int, int, bool]:
    """Pieces, digest of (place, id) of all pieces, and whether decoding gives back the source."""
    at = np.array(ids, np.int64)
    if len(ids):
        widths = lattice.widths[at]
        places = start + np.concatenate([[0], np.cumsum(widths[:-1])])
        digest = int((mix(mix(places.astype(U)) + at.astype(U)) >> U(24)).sum() % U(_DIGEST))
    else:
        digest = 0
    plain = source.replace(_MARK, " ").replace(_LITERAL, _MARK)
    return len(ids), digest, lattice.decode(ids) == plain


def _widths(lattice: Lattice) -> np.ndarray:
    """UTF-8 bytes that each id stands for."""
    out = np.ones(max(lattice.text_of) + 1, np.int64)
    for p, i in lattice.id.items():
        out[i] = len(p.replace(_MARK, " ").encode())
    return out


_LATTICES: dict[str, Lattice] = {}


def worker_lattice(name: str, held: Broadcast) -> Lattice:
    """The worker's lattice: tasks of one Python worker share it and the words it has met."""
    made = _LATTICES.get(name)
    if made is None:
        _LATTICES.clear()
        made = _LATTICES[name] = Lattice(*held.value)
        made.widths = _widths(made)
    return made


def encode(docs: DataFrame, model_path: str = MODEL, *, chunk: int = CHUNK, fan: int = FAN,
           with_ids: bool = True, by_chunk: bool = False, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``id_col, n_pieces, digest, round_trip`` of every document, and ``ids`` if asked for.

    ``digest`` sums a hash of place and id over all pieces, modulo 2^40; ``round_trip`` says whether
    decoding the ids gives the text.  The ids of a long text come as one array at the end; with
    ``by_chunk`` each chunk is a row of its own, so that no row outgrows a chunk.  Such rows also have
    ``row``, which tells the texts of one id apart, and ``chunk`` from 0 (0 alone for a short text); the ids of
    a text are those of its chunks in order.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(load_pieces(model_path))

    def lattice() -> Lattice:
        return worker_lattice(model_path, held)

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    id_field = T.StructField("id", rows.schema["id"].dataType)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = lattice()
        for batch in batches:
            got, ids = [], []
            texts = [marked(text.as_py()) for text in batch.column("text")]
            for s, found in zip(texts, made.wholes(texts)):
                got.append(_summary(made, found, s, 0))
                ids.append(np.array(found, np.int32) if with_ids else None)
            n, digest, same = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(n, pa.int64()), pa.array(digest, pa.int64()),
                pa.array(same, pa.bool_()), pa.array(ids, pa.list_(pa.int32())), batch.column("row")],
                names=["id", "n_pieces", "digest", "round_trip", "ids", "row"])

    short = rows.where(F.char_length("text") < chunk).mapInArrow(whole, T.StructType([
        id_field, *_RESULT, T.StructField("row", T.LongType())]))
    short = short.withColumn("chunk", F.lit(0).cast("long")) if by_chunk else short.drop("row")

    giants = store(rows.where(F.char_length("text") >= chunk), "pieces-long-texts")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = lattice()
        for batch in batches:
            for row, text in zip(batch.column("row"), batch.column("text")):
                plain = text.as_py()
                parts = cut(marked(plain), chunk, made)
                # U+2581 of the text travels as itself, spaces as spaces
                start = np.cumsum([0] + [n_bytes(b[:n]) for _, b, n, _ in parts])
                yield pa.RecordBatch.from_arrays([
                    pa.array([row.as_py()] * len(parts)), pa.array(range(len(parts)), pa.int64()),
                    pa.array([p[1].replace(_MARK, " ").replace(_LITERAL, _MARK) for p in parts]),
                    pa.array([p[2] for p in parts], pa.int64()),
                    pa.array([p[3] for p in parts], pa.int64()), pa.array(start[:-1], pa.int64())],
                    names=["row", "chunk", "body", "n", "offset", "start"])

    chunks = store(giants.mapInArrow(
        split, "row bigint, chunk bigint, body string, n bigint, offset bigint, start bigint"),
        "pieces-chunks")

    def inner(body: str) -> str:
        return body.replace(_MARK, _LITERAL).replace(" ", _MARK)

    def transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = lattice()
        for batch in batches:
            got = [json.dumps(made.transfer(inner(b), n, o)) for b, n, o in zip(
                *(batch.column(c).to_pylist() for c in ("body", "n", "offset")))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("chunk"),
                                              pa.array(got, pa.string())], names=["row", "chunk", "m"])

    parts = store(chunks.mapInArrow(transfers, "row bigint, chunk bigint, m string").withColumn(
        "fan", F.expr(f"chunk div {fan}")), "pieces-transfers")

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        m = None
        for text in pdf.sort_values("chunk").m:
            m = json.loads(text) if m is None else product(m, json.loads(text))
        return pd.DataFrame({"row": pdf.row[:1], "fan": pdf.fan[:1], "m": [json.dumps(m)]})

    def bounds(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("fan")
        got = states([json.loads(m) for m in pdf.m], 0, 0)
        return pd.DataFrame({"row": pdf.row, "fan": pdf.fan, "entry": [e for e, _ in got],
                             "leave": [x for _, x in got]})

    def within(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        got = states([json.loads(m) for m in pdf.m], int(pdf.entry.iloc[0]), int(pdf.leave.iloc[0]))
        return pd.DataFrame({"row": pdf.row, "chunk": pdf.chunk, "entry": [e for e, _ in got],
                             "leave": [x for _, x in got]})

    fans = parts.groupBy("row", "fan").applyInPandas(fold, "row bigint, fan bigint, m string")
    edges = fans.groupBy("row").applyInPandas(bounds, "row bigint, fan bigint, entry bigint, leave bigint")
    ways = (parts.join(edges, ["row", "fan"]).groupBy("row", "fan")
            .applyInPandas(within, "row bigint, chunk bigint, entry bigint, leave bigint"))

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = lattice()
        for batch in batches:
            got, ids = [], []
            for body, n, o, start, e, x in zip(*(batch.column(c).to_pylist() for c in (
                    "body", "n", "offset", "start", "entry", "leave"))):
                s = inner(body)
                found = made.trace(s, n, o, e, x)
                source = s[e:n + x]
                got.append(_summary(made, found, source if e < n else "", start + n_bytes(s[:e])))
                ids.append(np.array(found, np.int32) if with_ids else None)
            k, digest, same = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("chunk"), pa.array(k, pa.int64()),
                pa.array(digest, pa.int64()), pa.array(same, pa.bool_()),
                pa.array(ids, pa.list_(pa.int32()))],
                names=["row", "chunk", "n_pieces", "digest", "round_trip", "ids"])

    long = (chunks.join(ways, ["row", "chunk"])
            .select("row", "chunk", "body", "n", "offset", "start", "entry", "leave")
            .mapInArrow(traced, T.StructType([T.StructField("row", T.LongType()),
                                              T.StructField("chunk", T.LongType()), *_RESULT])))
    if not by_chunk:
        long = long.groupBy("row").agg(
            F.sum("n_pieces").alias("n_pieces"), (F.sum("digest") % _DIGEST).alias("digest"),
            F.every("round_trip").alias("round_trip"),
            F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))),
                                  lambda s: s["ids"])).alias("ids"))
    long = giants.select("row", "id").join(long, "row")
    out = short.unionByName(long if by_chunk else long.drop("row")).withColumnRenamed("id", id_col)
    return out if with_ids else out.drop("ids")

"""Operator 10: chunks against whole texts, a brute-force lattice, the library, and round trips."""

import itertools
import random
import re

import numpy as np
import pytest

from sparkmart.llm import sentencepieces as S
from sparkmart.llm.queries import op10_sentencepiece

SF = "/root/testdata/sf0.001"
ALPHABET = "aeinrst  hhello▁\n日é.!🙂xq"


@pytest.fixture(scope="module")
def lattice():
    return S.Lattice(*S.load_pieces(S.MODEL))


def texts(n, seed=1):
    rng = random.Random(seed)
    for k in range(n):
        letters = [ALPHABET, "ab the", "aathe", " "][k % 4]
        yield "".join(rng.choice(letters) for _ in range(rng.randint(1, 120)))


def test_chunks_give_the_whole_texts_pieces(lattice):
    for text in texts(200):
        s = S.marked(text)
        whole = lattice.trace(s, len(s), 0, 0, 0)
        assert lattice.decode(whole) == " " + text
        for size in (lattice.width, 23, 50):
            parts = S.cut(s, size, lattice)
            ways = S.states([lattice.transfer(b, n, o) for _, b, n, o in parts], 0, 0)
            got = [i for (_, b, n, o), (e, x) in zip(parts, ways) for i in lattice.trace(b, n, o, e, x)]
            assert got == whole


def test_new_words_of_a_batch_are_decoded_together(monkeypatch):
    """The search place by place in Python is left to long tokens, and gives the same pieces."""
    made, calls = S.Lattice(*S.load_pieces(S.MODEL)), []
    search = S.Lattice.reach
    given = [*texts(400, seed=9), "", " \n ", "\n", "  a  \n\n b ", "\u0301a \u0301", "y" * 500 + " z"]
    want = [made.trace(s := S.marked(t), len(s), 0, 0, 0) for t in given]
    made.cache.clear()
    monkeypatch.setattr(S.Lattice, "reach", lambda self, *a: calls.append(a[0]) or search(self, *a))
    for _ in range(2):  # new, then known
        assert [ids.tolist() for ids in made.wholes([S.marked(t) for t in given])] == want
    assert all(len(part) > S.SHORT or any(len(k) > S.SHORT and part in k for k in made.tokens) for part in calls)
    assert len(calls) < len(made.tokens) / 10


def test_tokens_are_forgotten_beyond_the_cache(monkeypatch, lattice):
    monkeypatch.setattr(S, "CACHE", 50)
    monkeypatch.setattr(S, "BATCH", 300)
    made, given = S.Lattice(*S.load_pieces(S.MODEL)), list(texts(60, seed=4))
    got = [ids.tolist() for ids in made.wholes([S.marked(t) for t in given])]
    assert got == [lattice.trace(s := S.marked(t), len(s), 0, 0, 0) for t in given]


def test_whole_texts_of_a_file_whose_pieces_hold_spaces():
    pieces = ["▁", "a", "b", "a▁b", "\n", "▁a", "b\na"]
    made = S.Lattice([(p, i + 256) for i, p in enumerate(pieces)], list(range(256)))
    given = ["a b\na", "\na", "", "b", "a b a b"]
    want = [made.trace(s := S.marked(t), len(s), 0, 0, 0) for t in given]
    assert [ids.tolist() for ids in made.wholes([S.marked(t) for t in given])] == want


def test_product_is_associative(lattice):
    rng = random.Random(2)
    m = [[[rng.choice([None, rng.randint(-99, 0)]) for _ in range(4)] for _ in range(4)] for _ in range(3)]
    assert S.product(S.product(m[0], m[1]), m[2]) == S.product(m[0], S.product(m[1], m[2]))


def test_best_score_by_brute_force():
    made = S.Lattice([(p, i + 256) for i, p in enumerate(["▁", "a", "b", "ab", "▁a", "ba", "bab", "▁ab"])],
                     list(range(256)))
    for n in range(1, 9):
        for letters in itertools.product("ab", repeat=n):
            s = "▁" + "".join(letters)
            best = max(sum(made.score[c] >> S._SHIFT for c in cut) for cut in _segmentations(s, made))
            ids = made.trace(s, len(s), 0, 0, 0)
            assert sum(made.score[made.text_of[i]] >> S._SHIFT for i in ids) == best


def _segmentations(s, made):
    if not s:
        yield []
    for k in range(1, len(s) + 1):
        if s[:k] in made.score:
            for rest in _segmentations(s[k:], made):
                yield [s[:k], *rest]


def test_scores_equal_the_librarys_unigram_decoder(lattice, tmp_path):
    """The same pieces and scores as a unigram file, decoded by the library."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(S.MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    for p in model.pieces:
        if p.type == pb.ModelProto.SentencePiece.NORMAL:
            p.score = (lattice.score[p.piece] >> S._SHIFT) / 1024
    library = SentencePieceProcessor(model_proto=model.SerializeToString())
    for text in texts(60, seed=5):
        text = text.replace("▁", "").replace("🙂", "x")
        if not text:
            continue
        s = S.marked(text)
        ours = lattice.trace(s, len(s), 0, 0, 0)
        theirs = library.encode(text)

        def total(ids):
            return sum(library.get_score(i) for i in ids if not library.is_byte(i))

        assert library.decode(ours) == library.decode(theirs)
        assert abs(total(ours) - total(theirs)) < 0.01 * len(ours)


ROWS = [(1, "hello world " * 40), (2, None), (3, ""), (None, "▁ literal ▁▁ mark  two spaces "),
        (5, "x" * 300), (5, "x" * 300), (6, "日本語🙂é\n\n\ttab" * 30), (7, " "), (8, "thethe" * 200)]


@pytest.mark.parametrize("chunk", [16, 64, 10_000])
def test_operator_in_spark(spark, lattice, chunk):
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in ROWS], "doc_id long, text string, ids string, row int")
    got = S.encode(df, chunk=chunk, fan=3).collect()
    want = []
    for i, t in ROWS:
        s = S.marked(t or "")
        want.append((i, lattice.trace(s, len(s), 0, 0, 0)))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, list(r.ids)) for r in got), key=key) == sorted(want, key=key)
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in got)
    whole = S.encode(df, chunk=10_000, with_ids=False).collect()
    assert sorted((r.doc_id or 0, r.digest) for r in got) == sorted((r.doc_id or 0, r.digest) for r in whole)


def test_no_rows(spark):
    assert S.encode(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_over_the_whole_table(spark, lattice):
    rows = op10_sentencepiece(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs) and all(r.round_trip for r in rows)
    for r in rows[:50]:
        s = S.marked(docs[r.doc_id] or "")
        assert r.n_pieces == len(lattice.trace(s, len(s), 0, 0, 0))


def test_query_returns_the_ids(spark, lattice):
    rows = op10_sentencepiece(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in rows[:50]:
        s = S.marked(docs[r.doc_id] or "")
        assert r.chunk == 0 and list(r.ids) == lattice.trace(s, len(s), 0, 0, 0)


def test_ids_by_chunk(spark, lattice):
    df = spark.createDataFrame([(i, t) for i, t in ROWS], "doc_id long, text string")
    rows = S.encode(df, chunk=64, fan=3, by_chunk=True).collect()
    assert max(len(r.ids) for r in rows) <= 4 * 64 and all(r.round_trip for r in rows)
    texts = {}
    for k, r in enumerate(sorted(rows, key=lambda r: r.chunk)):
        texts.setdefault((r.doc_id, r.row), []).extend(r.ids)
    want = [(i, lattice.trace(s := S.marked(t or ""), len(s), 0, 0, 0)) for i, t in ROWS]
    assert sorted(((i, ids) for (i, _), ids in texts.items()), key=str) == sorted(want, key=str)

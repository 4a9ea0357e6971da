"""Alignment against whole-text encoding and a plain two-pointer walk; products against dense matrices."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkmart.llm import alignment
from sparkmart.llm.csr import Csr, incidence, product


def dense(m):
    out = np.zeros((m.n_rows, m.n_columns), np.int64)
    np.add.at(out, (m.rows(), m.indices), m.data)
    return out


@given(st.integers(0, 2**32), st.integers(0, 8), st.integers(1, 8), st.integers(1, 8))
def test_products(seed, n, k, m):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 3, (n, k)), rng.integers(0, 3, (k, m))

    def csr(x):
        r, c = np.nonzero(x)
        return Csr(np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(x)))]), c, x[r, c], x.shape[1])

    assert (dense(product(csr(a), csr(b))) == a @ b).all()
    assert (dense(csr(a).transposed()) == a.T).all()


def test_products_in_parts(monkeypatch):
    monkeypatch.setattr("sparkmart.llm.csr.EXPANDED", 3)
    a, b = incidence(np.array([2, 5, 0, 1])), incidence(np.array([1, 1, 4, 2]))
    assert (dense(product(a, b.transposed())) == dense(a) @ dense(b).T).all()


@pytest.fixture(scope="module")
def tokenizers():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(alignment.MODEL_A)
    a.encode_special_tokens = True
    return (a, SentencePieceProcessor(model_file=alignment.MODEL_B),
            alignment.bytes_of_a(alignment.MODEL_A), alignment.bytes_of_b(alignment.MODEL_B))


def plain(texts, tokenizers):
    a, b, bytes_a, bytes_b = tokenizers
    rows, links_of, corpus = [], [], Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        if not text or b"".join(bytes_a[i] for i in x) != raw or b"".join(bytes_b[i] for i in y) != raw:
            rows.append((0, 0, 0, 0, "", 0))
            links_of.append([])
            continue
        ends_x = np.cumsum([len(bytes_a[i]) for i in x]).tolist()
        ends_y = np.cumsum([len(bytes_b[i]) for i in y]).tolist()
        groups, links, i, j, i0, j0 = [], [], 0, 0, 0, 0
        while i < len(x):
            links.append((x[i], y[j]))
            if ends_x[i] == ends_y[j]:
                i, j = i + 1, j + 1
                groups.append((x[i0:i], y[j0:j]))
                i0, j0 = i, j
            elif ends_x[i] < ends_y[j]:
                i += 1
            else:
                j += 1
        written = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        rows.append((len(x), len(y), len(groups), len(links), hashlib.sha256(written.encode()).hexdigest(),
                     sum(len(g) * len(h) for g, h in groups)))
        links_of.append(links)
        corpus.update(links)
    top = Counter()
    for (_, q), n in corpus.items():
        top[q] = max(top[q], n)
    return [(*r[:4], sum(corpus[p] == top[p[1]] for p in links), sum(corpus[p] for p in links), *r[4:])
            for r, links in zip(rows, links_of)]


def found(spark, texts, parts=3):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    rows = {r.doc_id: tuple(r)[1:] for r in alignment.align_documents(docs).collect()}
    assert len(rows) == len(texts)
    return [rows[i] for i in range(len(texts))]


AWKWARD = [
    None, "", " ", "   ", "a", " a", "a ", "  a  b ", "\n", "a\n b", "a \nb", "tab\tx y", "it's the dog's 's",
    "naïve façade — “quoted” text… 😀 😀😀 é ́", "x y z w a　 b", "▁ a▁b ▁", "a ▁b",
    "<|endoftext|> </s> <s> <unk> <0x41>", "1234567890 " * 30, "a" * 5000, "1.5% of $3,000.00!",
    "​ ‌ \x1c \x85 a\x85b \x00 c", "日本語 テスト 中文", "ﬁ ﬂ Å K", "x  y   z    w", "  " * 300 + "end",
    "a , b . c ; d", "\r\n x\r\n\r\ny", "Ünïcödé Ωmega λ x", "</s>", "﻿bom a",
]


def test_awkward_texts(spark, tokenizers):
    assert found(spark, AWKWARD) == plain(AWKWARD, tokenizers)


def test_given_documents(spark, tokenizers):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    texts = [r.text for r in docs]
    want = plain(texts, tokenizers)
    assert found(spark, texts) == want and all(r[0] for r, t in zip(want, texts) if t)


def test_small_blocks_and_parts(spark, tokenizers, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()
    texts = [r.text for r in docs] + AWKWARD
    monkeypatch.setattr(alignment, "PART", 64)
    known = alignment.Aligner(alignment.MODEL_A, alignment.MODEL_B)
    for text in filter(None, texts):
        segments = known.segments(text)
        assert "".join(segments) == " " + text
        assert [i for s in segments for i in tokenizers[0].encode(s, add_special_tokens=False).ids] == \
            tokenizers[0].encode(" " + text, add_special_tokens=False).ids
        assert [i for s in segments for i in tokenizers[1].encode(s[1:])] == tokenizers[1].encode(text)


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(st.sampled_from("ab1 .,'é\n\t▁  😀s"), max_size=40))
def test_segments_encode_alone(tokenizers, text):
    segments = alignment.Aligner.segments(text)
    assert "".join(segments) == " " + text
    a, b, *_ = tokenizers
    assert [i for s in segments for i in a.encode(s, add_special_tokens=False).ids] == a.encode(
        " " + text, add_special_tokens=False).ids
    if text and "▁" not in text:
        assert [i for s in segments for i in b.encode(s[1:])] == b.encode(text)


def test_rows_ids_and_columns(spark):
    docs = spark.createDataFrame([(1, "one two", 5), (1, "one two", 6), (None, "one two", 7), (2, None, 8)],
                                 "doc_id long, text string, block long")
    rows = alignment.align_documents(docs).collect()
    assert sorted((r.doc_id or 0, r.n_a) for r in rows) == [(0, 2), (1, 2), (1, 2), (2, 0)]
    assert {r.count_sum for r in rows} == {6, 0}  # two links, three occurrences each
    assert alignment.align_documents(docs.limit(0)).collect() == []
    names = spark.createDataFrame([("x", "one")], "doc_id string, text string")
    assert alignment.align_documents(names).first().doc_id == "x"


def test_ranks_encode_as_the_tokenizer(tokenizers):
    known = alignment.Aligner(alignment.MODEL_A, alignment.MODEL_B)
    texts = [" " + t for t in AWKWARD if t] + [" " + "ab" * 200_000, " " + "x1é" * 100_000]
    assert known.ranks is not None
    assert known.encoded(texts) == [tokenizers[0].encode(t, add_special_tokens=False).ids for t in texts]
    short = [t for t in texts if len(t) < alignment.LONG]
    known.ranks = None
    assert known.encoded(short) == [tokenizers[0].encode(t, add_special_tokens=False).ids for t in short]


def test_a_group_without_common_ends_is_not_expanded(spark, tokenizers):
    texts = ["é" * 3000 + " " + "́" * 3000]
    assert found(spark, texts) == plain(texts, tokenizers)

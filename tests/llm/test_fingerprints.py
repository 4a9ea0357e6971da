"""Operator 8 against a plain reading of its contract, and the band join against all pairs."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sparkmart.llm.fingerprints import SHINGLE_WORDS, _A, _B, edited, fingerprint, similar_pairs
from sparkmart.llm.queries import op8_fingerprints
from sparkmart.llm.text import mix, shingles

SF = "/root/testdata/sf0.001"


def shingle_set(text, k=5):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a or b else 1.0


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (i, t) in enumerate(rows):
        t, f = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        e = t[:len(t) - half] + f[:half]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), jaccard(t, e), jaccard(t, f)))
    return out


def alike(a, b):
    return sum(a[k:k + 4] == b[k:k + 4] for k in range(0, 256, 4)) / 64


def plain_fingerprint(text):
    """All hashes of all shingles, their minima, 16 mixed bits of each."""
    h, _ = shingles(pa.array([text]), SHINGLE_WORDS)
    if not len(h):
        return "f" * 256
    least = [min((int(x) * int(a) + int(b)) % 2 ** 64 for x in h) for a, b in zip(_A, _B)]
    return "".join(f"{int(x) >> 48:04x}" for x in mix(np.array(least, np.uint64)))


def check(df, rows):
    got = sorted(df.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.n_chars, r.edited_sha256))
    want = sorted(expected(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in got] == [w[:3] for w in want]
    for r, w in zip(got, want):
        assert abs(r.near_edited - w[3]) < 0.3 and abs(r.near_next - w[4]) < 0.3
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 256
        assert r.near_edited == alike(r.fingerprint, r.edited_fingerprint)
    if len(got) > 50:
        assert abs(sum(r.near_edited - w[3] for r, w in zip(got, want)) / len(got)) < 0.02


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet")
            .select("doc_id", "text").collect()]
    check(op8_fingerprints(spark, SF), rows)


def test_every_fingerprint_is_recomputed(spark):
    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert len({i for i, _ in rows}) == len(rows)
    got = {r.doc_id: r for r in op8_fingerprints(spark, SF).collect()}
    for k, (i, text) in enumerate(rows):
        j, following = rows[(k + 1) % len(rows)]
        assert got[i].near_next == alike(got[i].fingerprint, got[j].fingerprint)
        if len(text) < 20_000:
            assert got[i].fingerprint == plain_fingerprint(text)
            assert got[i].edited_fingerprint == plain_fingerprint(edited(text, following))


@pytest.mark.parametrize("rows", [
    [(1, "ab c"), (2, None), (3, ""), (None, "null id é日本"), (5, "x" * 7), (5, "x" * 7), (5, "y")],
    [(7, "only one document here to read")], [(None, "a b"), (None, "c d e")],
    [(1, "A b C d E f " * 20000), (2, "tail words")]])
def test_edge_rows(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                               "doc_id long, text string, fingerprint string, id int")
    check(fingerprint(df), rows)


def test_no_rows(spark):
    assert fingerprint(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_equal_texts_have_equal_fingerprints(spark):
    df = spark.createDataFrame([(i, "same words in every copy of it") for i in range(9)],
                               "doc_id long, text string")
    rows = fingerprint(df).collect()
    assert len(rows) == 9 and len({r.fingerprint for r in rows}) == 1
    assert all(r.near_next == 1.0 for r in rows)


def test_unrelated_long_texts_are_not_alike(spark):
    texts = [" ".join(f"{c}{k}" for k in range(120_000)) for c in "abc"]
    texts.append(texts[2][:len(texts[2]) // 2] + texts[0][len(texts[0]) // 2:])  # a third of c in common
    rows = sorted(fingerprint(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    assert [r.near_next for r in rows[:2]] == [0.0, 0.0]
    assert abs(rows[2].near_next - jaccard(texts[2], texts[3])) < 0.2
    assert all(abs(r.near_edited - 1 / 3) < 0.2 for r in rows[:2])
    parts = [[r.fingerprint[k:k + 4] for k in range(0, 256, 4)] for r in rows]
    assert sum(a == b for a, b in zip(parts[0], parts[1])) <= 1
    assert all(len(set(p)) > 60 for p in parts)


def test_similar_pairs_against_all_pairs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        base = [f"w{rng.randrange(300)}" for _ in range(120)]
        for k in range(3):
            copy = list(base)
            for _ in range(k):
                copy[rng.randrange(120)] = f"z{rng.randrange(999)}"
            rows.append((3 * i + k, " ".join(copy)))
    rows += [(900, rows[0][1]), (901, None), (902, "")]
    got = {(r.id_a, r.id_b): r.jaccard for r in similar_pairs(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {(a, b): jaccard(s, t) for (a, s), (b, t) in itertools.combinations(rows[:180], 2)
            if jaccard(s, t) >= 0.8}
    assert set(got) <= set(want) and len(got) >= 0.99 * len(want)
    assert all(abs(got[p] - want[p]) < 1e-9 for p in got)

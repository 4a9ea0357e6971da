"""Operator 7 against all pairs; sampling against exact similarity; graph components."""

import itertools
import random

import numpy as np
import pytest

from sparkmart.llm import graphs, neardup
from sparkmart.llm.cws import WeightedSampler
from sparkmart.llm.graphs import components
from sparkmart.llm.queries import op7_neardup
from sparkmart.llm.text import mix

from .helpers import jaccard, words

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, node string, class_id int, lang string"


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def brute(rows):
    """Class of each row by plain Jaccard of all pairs of texts; ids must be ascending."""
    links = [(a, b) for (a, (_, s)), (b, (_, t)) in itertools.combinations(enumerate(rows), 2)
             if s is not None and t is not None and (s == t or jaccard(s, t) >= 0.8)]
    return [rows[r][0] for r in roots(len(rows), links)]


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10 ** 6)}"
        out.append(" ".join(copy))
    return out


def test_query_over_the_whole_table(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = dict(op7_neardup(spark, SF).collect())
    assert [got[i] for i, _ in docs] == brute(docs)


def test_families_against_all_pairs(spark):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(900)]
    texts = []
    for _ in range(12):
        texts += family(rng, rng.choices(vocabulary, k=150), 8, 5)
    texts += family(rng, rng.choices(vocabulary, k=120), 60, 6)  # a large group, links and near misses
    shared = rng.choices(vocabulary, k=40)
    texts += [" ".join(shared + rng.choices(vocabulary, k=120)) for _ in range(40)]  # a shared passage
    texts += [texts[0]] * 30
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, "n", 1, "en") for i, t in rows], SCHEMA)
    got = dict(neardup.near_duplicates(df).collect())
    want = brute(rows)
    wrong = [i for i, _ in rows if got[i] != want[i]]
    # what differs may do so by the weights only: a pair within 0.02 of the threshold
    for i in wrong:
        assert any(abs(jaccard(texts[i], t) - 0.8) < 0.02 for t in texts)
    assert len(wrong) <= 3


def test_near_by_the_plain_rule_alone(spark):
    """Texts against themselves three times over: plain similarity 0.96, weighted about 0.46."""
    rng = random.Random(6)
    once = [" ".join(f"p{rng.randrange(10 ** 6)}" for _ in range(104)) for _ in range(30)]
    rows = [(2 * k + j, t if not j else " ".join([t] * 3)) for k, t in enumerate(once) for j in (0, 1)]
    got = dict(neardup.near_duplicates(spark.createDataFrame(
        [(i, t, "n", 1, "en") for i, t in rows], SCHEMA)).collect())
    assert [got[i] for i, _ in rows] == brute(rows) == [i - i % 2 for i, _ in rows]


@pytest.mark.parametrize("block", [neardup.BLOCK, 4])
def test_no_near_pair_of_a_bucket_is_pruned(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(8)
    texts = []
    for n in (9, 40, 104, 400, 6000):
        base = [f"q{rng.randrange(10 ** 6)}" for _ in range(n)]
        texts += [" ".join(base), " ".join(base * 3), " ".join(base[:n // 2])]
        texts += family(rng, base, 6, max(2, n // 40))
    rows = [(bytes([k]), t) for k, t in enumerate(texts)]
    idf = spark.sparkContext.broadcast(neardup.inverse_frequencies(np.ones(1 << neardup.COUNTER_BITS), 50))
    sketches = neardup._sketched(spark.createDataFrame(rows, "node binary, text string"), idf)
    parted = spark.createDataFrame([(1, node, node) for node, _ in rows], "key long, node binary, root binary")
    found = [(r.a[0], r.b[0]) for r in neardup._candidates(parted, sketches, 0.8).collect()]
    kept = set(found)
    assert len(found) == len(kept)  # every two members meet in one cell
    import pyarrow as pa
    h, w, at = neardup.weighted_sets(pa.array(texts), idf.value)
    sets = [(h[a:b], w[a:b]) for a, b in zip(at[:-1], at[1:])]
    pairs = list(itertools.combinations(range(len(texts)), 2))
    near = {(a, b) for a, b in pairs if neardup.similarity(sets[a], sets[b]) >= 0.8}
    assert near and near <= kept and len(kept) < len(pairs) / 2


def test_edge_rows(spark):
    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, "one two"), (6, "One, TWO!"), (7, "one two three"),
            (8, "z " * 60_000), (9, "z " * 60_000 + "y"), (9, "z " * 60_000 + "y"), (None, "one two")]
    df = spark.createDataFrame([(i, t, "n", 1, "en") for i, t in rows], SCHEMA)
    got = [tuple(r) for r in neardup.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (2, 2), (3, 3), (4, 3), (5, 5), (6, 5), (7, 7), (8, 8),
                                           (9, 8), (9, 8), (None, 5)], key=str)
    kept = neardup.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5, 7, 8]


def test_repeated_rows_keep_one(spark):
    df = spark.createDataFrame([(1, "same words in all of these rows", "n", 1, "en")] * 50, SCHEMA)
    assert neardup.one_of_each(df).count() == 1


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert neardup.near_duplicates(df).collect() == [] and neardup.one_of_each(df).collect() == []


def test_samples_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(2)
    sampler = WeightedSampler(600, 2.0)
    for share in (0.2, 0.5, 0.8, 0.95):
        h = mix(rng.integers(0, 1 << 62, 500, dtype=np.uint64))
        wa = np.where(rng.random(500) < 0.7, 2.0, rng.uniform(0.5, 6, 500)).astype(np.float32)
        wb = wa.copy()
        changed = rng.random(500) > share
        wb[changed] *= rng.choice([0.25, 3.0], changed.sum()).astype(np.float32)
        exact = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
        both = sampler.signatures(np.concatenate([h, h]), np.concatenate([wa, wb]), np.array([0, 500, 1000]))
        assert abs((both[0] == both[1]).mean() - exact) < 0.07


@pytest.mark.parametrize("tasks", [neardup.TASKS_A_SUM, 1])
def test_document_frequencies(spark, monkeypatch, tasks):
    monkeypatch.setattr(neardup, "TASKS_A_SUM", tasks)
    texts = ["a b c d e f", "a b c d e f g", None, "x", "a b c d e f"]
    df = spark.createDataFrame([(t,) for t in texts if t is not None], "text string")
    counted, n = neardup.document_frequencies(df.repartition(3), "text")
    assert n == 4 and counted.max() == 3 and counted.sum() == 2 + 3 + 1 + 2


@pytest.mark.parametrize("edges", [
    [], [(1, 2), (2, 3), (5, 9), (9, 7)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 150)],
    [(i, (i * 7 + 3) % 61) for i in range(61)]])
@pytest.mark.parametrize("hubs", [graphs.HUBS, 4])
def test_components(spark, monkeypatch, edges, hubs):
    monkeypatch.setattr(graphs, "HUBS", hubs)
    got = dict(components(spark.createDataFrame(edges, "a int, b int")).collect())
    n = 1 + max((max(e) for e in edges), default=0)
    want = roots(n, edges)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: want[x] for x in linked}


def test_words_are_those_of_the_contract():
    import pyarrow as pa

    from sparkmart.llm.text import words as hashed
    texts = ["Ab c-d 1é.x", "", None, "éa" * 9, "a" * 3_000_000 + " b", "ab C D 1é x"]
    h, bounds = hashed(pa.array(texts))
    assert np.diff(bounds).tolist() == [len(words(t)) for t in texts]
    assert (h[bounds[0]:bounds[1]] == h[bounds[5]:bounds[6]]).all()
    assert len(set(h.tolist())) == len({w for t in texts for w in words(t)})

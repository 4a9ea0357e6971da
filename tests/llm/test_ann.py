"""Operator 4 against brute force."""

import numpy as np
import pytest

from sparkmart.llm import ann
from sparkmart.llm.queries import op4_ann

SCHEMA = "vec_id long, embedding array<float>, label int, part string"


def brute(ids, v, every=50, k=5):
    v = v.astype(np.float64)
    n = np.linalg.norm(v, axis=1)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        s = np.einsum("ij,j->i", v, v[q]) / (n * n[q])
        s[q] = -9
        best = np.lexsort((ids, -s))[:min(k, len(ids) - 1)]
        out[int(ids[q])] = [(int(ids[b]), float(s[b])) for b in best]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_query(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").toPandas()
    want = brute(rows.vec_id.to_numpy(), np.stack(rows.embedding))
    got = found(op4_ann(spark, f"/root/testdata/{sf}"))
    assert recall(got, want) >= 0.9
    for q in want:
        exact = dict(want[q])
        assert all(abs(s - exact[i]) < 1e-12 for i, s in got[q] if i in exact)


def test_clustered_vectors_search_few_parts(spark):
    rng = np.random.default_rng(4)
    v = (rng.standard_normal((40, 32))[np.arange(3000) % 40] * 3 + rng.standard_normal((3000, 32))).astype("f4")
    index = ann.learn(v)
    assert index.probes <= 4
    sizes = np.bincount(index.parts(ann.unit(v.astype(float)), 1)[:, 0], minlength=ann.PARTS)
    assert sizes.max() < len(v) / 3
    df = spark.createDataFrame([(i, x.tolist(), 0, "") for i, x in enumerate(v)], SCHEMA)
    assert recall(found(ann.search(df, block=500)), brute(np.arange(3000), v)) >= 0.9


def test_equal_vectors_ties_and_blocks(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((400, 8)).astype("f4")
    v[100:300] = v[100]
    df = spark.createDataFrame([(i, x.tolist(), 0, "") for i, x in enumerate(v)], SCHEMA)
    for block in (37, 8192):
        got, want = found(ann.search(df, block=block)), brute(np.arange(400), v)
        assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in want.items()}


def test_edge_rows(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (1, [0.0, 2.0]), (2, None), (100, [0.0, 0.0]),
            (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 2.0]),
            (6, [1.0, 2.0, 3.0]), (1, [0.0, 2.0]), (150, [])]
    got = found(ann.search(spark.createDataFrame([(i, v, 0, "") for i, v in rows], SCHEMA)))
    assert {q: [i for i, _ in r] for q, r in got.items()} == {0: [50, 1], 50: [0, 1]}
    assert got[0][1][1] == 0.0 and abs(got[50][0][1] - 2 ** -0.5) < 1e-12


def test_every_row_of_a_repeated_id_is_a_candidate(spark):
    rows = [(0, [1.0, 0.0]), (7, [-5.0, 1.0]), (7, [1.0, 0.01]), (7, [1.0, 0.01]), (8, [1.0, 0.5]),
            (50, [0.0, 1.0]), (50, [0.0, -1.0])]
    got = ann.search(spark.createDataFrame([(i, v, 0, "") for i, v in rows], SCHEMA)).collect()
    first = sorted((r["rank"], r.vec_id) for r in got if r.query_id == 0)
    assert [i for _, i in first] == [7, 8, 50, 50, 7]
    sets = {}
    for r in got:
        sets.setdefault((r.query_id, r.query_hash), []).append((r["rank"], r.vec_id, round(r.score, 3)))
    assert len(sets) == 3  # two queries share the id 50, each sees the other
    assert sorted(sorted(s)[-1] for (q, _), s in sets.items() if q == 50) == [(5, 50, -1.0)] * 2


def test_lengths_are_searched_apart_and_large_components_keep_their_score(spark):
    rng = np.random.default_rng(8)
    v, w = rng.standard_normal((600, 4)), rng.standard_normal((90, 3)) * 1e200
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(1000 + i, x.tolist()) for i, x in enumerate(w)]
    got = found(ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=64))
    want = brute(np.arange(1000, 1090), w / 1e200)
    assert {q for q in got if q >= 1000} == set(want) and {q for q in got if q < 1000} == set(range(0, 600, 50))
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert all(abs(a - b) < 1e-12 for (_, a), (_, b) in zip(got[q], want[q]))
    assert recall({q: r for q, r in got.items() if q < 1000}, brute(np.arange(600), v)) >= 0.9


def test_parts_grow_with_the_rows():
    assert [ann.n_parts(n) for n in (0, 10_000, 65_535, 65_536, 300_000, 10 ** 9)] == [16, 16, 16, 32, 128, 256]


def test_a_large_clustered_table_scores_few_candidates(spark):
    rng = np.random.default_rng(10)
    n = 70_000
    v = (rng.standard_normal((400, 32))[np.arange(n) % 400] * 2 + rng.standard_normal((n, 32))).astype("f4")
    index = ann.learn(v[rng.permutation(n)[:ann.SAMPLE]], parts=ann.n_parts(n))
    home = np.bincount(index.parts(ann.unit(v.astype(float)), 1)[:, 0], minlength=32)
    probed = index.parts(ann.unit(v[::50].astype(float)), index.probes)
    share = home[probed].sum(axis=1).mean() / n
    import pandas as pd
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": v.tolist()}))
    rate = recall(found(ann.search(df)), brute(np.arange(n), v))
    print(f"70,000 rows: {index.probes} of 32 parts, {share:.2f} of the rows scored, recall {rate:.3f}")
    assert rate >= 0.9 and share <= 0.25


def test_no_rows_and_a_single_row(spark):
    assert ann.search(spark.createDataFrame([], SCHEMA)).collect() == []
    assert ann.search(spark.createDataFrame([(0, [1.0], 0, "")], SCHEMA)).collect() == []


def test_bisection_is_balanced_and_follows_the_graph():
    rng = np.random.default_rng(6)
    x = ann.unit(np.repeat(np.eye(4), 64, axis=0) * 5 + rng.standard_normal((256, 4)) * 0.3)
    graph = ann._nearest(x, x, 10, own=True)
    part = ann.bisected(graph, 4)
    assert np.bincount(part).tolist() == [64] * 4
    assert (part[graph] == part[:, None]).mean() > 0.8

"""Operator 6: every token once, no overflow, least bins, tight fill."""

import numpy as np
from pyspark.sql import functions as F

from sparkmart.llm import packing
from sparkmart.llm.queries import op6_packing

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, bin int, piece string"


def check(rows, tokens):
    """rows: results; tokens: multiset {(id, tokens)} as a list."""
    whole = {}
    for r in rows:
        whole.setdefault((r.doc_id, r.n_tokens, r.copy), []).append((r.start, r.length))
    lengths = []
    for (doc, n_tokens, _), parts in whole.items():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        assert sum(n for _, n in parts) == n_tokens
        lengths.append((doc, n_tokens))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(lengths, key=key) == sorted(tokens, key=key)
    bins = {}
    for r in rows:
        assert (r.bin is None) == (r.length == 0)
        if r.bin is not None:
            bins.setdefault((r.bin_group, r.bin), []).append(r)
    for parts in bins.values():
        parts.sort(key=lambda r: r.offset)
        used = 0
        for r in parts:
            assert r.offset == used
            used += r.length
        assert parts[0].capacity == min(c for c in packing.CAPACITIES if c >= used)
    return bins


def test_query_over_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = op6_packing(spark, SF).collect()
    bins = check(rows, [(r.doc_id, len((r.text or "").split())) for r in docs])
    used = sum(r.length for r in rows)
    assert used / sum(b[0].capacity for b in bins.values()) > 0.97


def test_edge_rows_and_groups(spark):
    texts = [(1, None), (2, ""), (3, " \n "), (None, "a b"), (5, "w " * 20_000), (6, "x y z"), (6, "x y z"),
             (6, "q r"), *((100 + i, "t " * (i % 90)) for i in range(500))]
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in texts], SCHEMA)
    check(packing.pack_documents(df, group=64).collect(), [(i, len((t or "").split())) for i, t in texts])


def test_unicode_white_space_separates_tokens(spark):
    text = "a\u00a0b\u3000c d\u2028e\u0085f\u200bg"  # U+200B is no white space
    rows = packing.pack_documents(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [r.n_tokens for r in rows] == [6]


def test_texts_of_one_id_are_told_apart_and_copies_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(packing, "COPIES", 3)
    texts = [(4, "a b c")] * 10 + [(4, "d e f")] * 2 + [(None, "g h")] * 4 + [(5, None)] * 7
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("text_hash", F.lit("clash"))
    rows = packing.pack_documents(df).collect()
    copies = {}
    for r in rows:
        copies.setdefault((r.doc_id, r.n_tokens, r.text_hash), []).append(r.copy)
    assert sorted(sorted(c) for c in copies.values()) == [
        [1, 2], [1, 2, 3, 4], list(range(1, 8)), list(range(1, 11))]


def test_no_rows(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def plain(lengths, capacities, overhead):
    """The same rule, written without search structures."""
    bins = []
    out = []
    for k, n in enumerate(lengths):
        fits = [(b["cap"] - b["used"], i) for i, b in enumerate(bins) if b["cap"] - b["used"] >= n]
        if fits:
            i = min(fits)[1]
        else:
            def net(c):
                return overhead + c - min(c - n, sum(m for m in lengths[k + 1:] if m <= c - n))
            cap = min((c for c in capacities if c >= n), key=lambda c: (net(c), c))
            i = len(bins)
            bins.append({"cap": cap, "used": 0})
        out.append((i, bins[i]["used"]))
        bins[i]["used"] += n
    return out, [min(c for c in capacities if c >= b["used"]) for b in bins]


def test_pack_against_the_plain_rule():
    rng = np.random.default_rng(1)
    for _ in range(40):
        n = int(rng.integers(1, 90))
        lengths = np.sort(np.minimum(1 + rng.geometric(0.02, n), 128))[::-1]
        bins, starts, sizes = packing.pack(lengths, (16, 32, 64, 128), 4)
        want, caps = plain(lengths.tolist(), (16, 32, 64, 128), 4)
        assert list(zip(bins.tolist(), starts.tolist())) == want and sizes == caps

"""Spelling variants against a plain comparison of all words."""

import re
from collections import Counter, defaultdict
from zlib import crc32

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkmart.llm import spelling


def tally(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 5}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def plain(n):
    by_length = defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if is_near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = spelling.variants(docs).collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = plain(tally(rows))
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs).collect()}
    assert got == want and sum(v[0] is not None for v in want.values()) > 10


def test_awkward_words(spark):
    words = {"aabbcc": 5, "abbccé": 30, "aabbccc": 25, "aaabbcc": 130, "aabbcd": 26, "aabbc": 99,
             "bbbbbb": 5, "bbbbbbb": 25, "bbbbbbbb": 125, "bbbbbbbbb": 625, "ÿerung": 5, "×erung": 5,
             "x" * 4000: 5, "x" * 3999 + "y": 30, "x" * 1999 + "z" + "x" * 2000: 30}
    rows = [(None, None), (1, ""), (1, "12 34")]
    rows += [(10_000 + i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())]
    rows.append((5, "-ABBBBBB " * 7 + "Āabbccé"))
    want = plain(tally(rows))
    assert len(want) > 10 and found(spark, rows) == want


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.text("abé", min_size=6, max_size=8), st.integers(5, 60), max_size=40))
def test_small_alphabets(spark, words):
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())]
    assert found(spark, rows + [(0, None)]) == plain(tally(rows))


def test_no_words_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "letter " * 30, 3, 4), (2, "lettr lettre " * 5, 3, 4)],
                                 "doc_id long, text string, n long, w long")
    got = {r.word: r.form for r in spelling.variants(docs).collect()}
    assert got == {r: f for r, (f, *_) in plain(tally([(1, "letter " * 30), (2, "lettr lettre " * 5)])).items()}
    assert spelling.variants(docs.limit(0)).collect() == []


def test_no_pair_outgrows_the_alphabet(spark):
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]
    words = spark.createDataFrame([(i, "stem" + c + "tail") for i, c in enumerate(letters)] + [(90, "stemtail")],
                                  "w long, word string")
    got = {r.w: (r.n_near, r.best) for r in spelling.neighbours(words).collect()}
    assert got == {i: (90, 0 if i else 1) for i in range(91)}
    entries = words.mapInArrow(spelling._entries, "p1 long, p2 long, s1 long, s2 long, w long, role tinyint")
    most = entries.groupBy(*spelling.PAIR).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    assert most == 91


def test_no_table_of_words_is_broadcast(spark, monkeypatch):
    words = {"bbbbbb": 5, "bbbbbbb": 25, "bbbbbbbb": 125, "bbbbbbbbb": 625, "other words": 5}
    docs = spark.createDataFrame([(i, f"{w} " * n) for i, (w, n) in enumerate(words.items())],
                                 "doc_id long, text string")
    plans, store = {}, spelling.store

    def planned(df, name):
        df.collect()  # the plan that ran, joins chosen on the way included
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())

    def stored(df, name):
        if name != "spelling-numbered":  # a row for each partition is broadcast there
            planned(df, name)
        return store(df, name)

    monkeypatch.setattr(spelling, "store", stored)
    planned(spelling.variants(docs), "result")
    joins = {name: [p.count("SortMergeJoin") for p in found] for name, found in plans.items()}
    assert all(n >= 1 for name in ("spelling-linked", "spelling-roots", "result") for n in joins[name])
    assert not [name for name, found in plans.items() for p in found if "Broadcast" in p]

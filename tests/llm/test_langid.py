"""Operator 3: held-out accuracy, what it may learn from, and edge rows."""

import zlib

import numpy as np

from pyspark.sql import functions as F

from sparkmart.llm import langid
from sparkmart.llm.ngrams import counts
from sparkmart.llm.queries import op3_langid

SF = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, lang string, score double, _lang string"


def test_held_out_accuracy(spark):
    rows = op3_langid(spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def corpus(n=60):
    rng = np.random.default_rng(1)
    kinds = {"xx": ["abra", "cada", "bra"], "yy": ["zuzu", "wiwi", "kux"]}
    return [(i, " ".join(rng.choice(kinds[k], 12)), k, 1.0, "c")
            for i, k in enumerate(["xx", "yy"] * n)]


def test_null_labels_and_held_out_rows_teach_nothing(spark):
    rows = corpus()
    other = [(r[0], r[1], "zz" if zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[2], *r[3:]) for r in rows]
    other += [(9000 + i, "qqq qqq", None, 0.0, None) for i in range(30)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in
           langid.predictions(spark.createDataFrame(other, COLUMNS)).collect()}
    plain = {r.doc_id: (r.lang_pred, r.score) for r in
             langid.predictions(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert {v[0] for v in got.values()} <= {"xx", "yy"}
    assert all(got[i] == plain[i] for i in plain)


def test_sample_is_that_of_one_task(spark, monkeypatch):
    """The first rows of each language by the hash, however the rows lie in tasks."""
    monkeypatch.setattr(langid, "TASKS_A_GROUP", 2)
    df = spark.createDataFrame(corpus(), COLUMNS).select(F.col("doc_id").alias("id"), "text", "lang")
    plain = lambda rows: [(g, at.tolist(), n.tolist()) for g, at, n in langid._sample(rows, 7, 12)]
    assert plain(df.repartition(9)) == plain(df.coalesce(1))
    first = (df.select("lang", F.xxhash64(F.col("id").cast("string"), "text").alias("o")).collect())
    ranked = sorted((sorted(r.o for r in first if r.lang == g).index(x.o), x.o, g)
                    for g in ("xx", "yy") for x in first if x.lang == g)
    chosen = sorted((o, g) for _, o, g in ranked[:12])
    assert [g for g, _, _ in plain(df)] == [g for _, g in chosen]


def test_edge_rows(spark):
    rows = corpus() + [(500, None, "xx", 0.0, ""), (501, "", "xx", 0.0, ""), (502, "123 !?", "yy", 0.0, ""),
                       (None, "abra cada", None, 0.0, ""), (503, "abra " * 100_000, None, 0.0, ""),
                       (504, "zuzu", None, 0.0, ""), (504, "zuzu", None, 0.0, "")]
    got = langid.predictions(spark.createDataFrame(rows, COLUMNS)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(got) == len(rows)
    assert all((by[i][0].lang_pred, by[i][0].score) == ("und", 0.0) for i in (500, 501, 502))
    assert by[None][0].lang_pred == "xx" and by[None][0].held_out
    assert by[503][0].lang_pred == "xx" and len(by[504]) == 2
    assert by[504][0].lang_pred == by[504][1].lang_pred == "yy"


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "words here", None, 0.0, "")], COLUMNS)
    assert [(r.lang_pred, r.score) for r in langid.predictions(df).collect()] == [("und", 0.0)]
    assert langid.predictions(spark.createDataFrame([], COLUMNS)).collect() == []


def test_filter_keeps_rows_and_columns(spark):
    df = spark.createDataFrame(corpus() + [(700, "...", "xx", 0.0, "k")], COLUMNS)
    kept = langid.identified(df)
    assert kept.columns == df.columns and kept.count() == 120
    clashing = df.withColumn("_lang", F.col("doc_id") + 1).withColumn("row", F.lit("r"))
    got = {tuple(r) for r in langid.identified(clashing).collect()}
    assert got == {tuple(r) for r in clashing.where("text <> '...'").collect()} and len(got) == 120


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = "Été à l'ÉCOLE " * 50
    whole = counts(text)
    grams = whole.sum()
    monkeypatch.setattr("sparkmart.llm.ngrams._PIECE", 64)
    assert abs(counts(text).sum() - grams) <= 6 * (len(text) // 64 + 1)


def test_training_is_a_multinomial_regression():
    rng = np.random.default_rng(0)
    sample = []
    for i in range(300):
        k = i % 3
        at = np.unique(rng.integers(0, 3000, 20) * 3 + k).astype(np.int32)
        sample.append((f"l{k}", at, np.ones(len(at), np.int32)))
    model = langid.train(sample, np.ones(langid.FEATURES))
    right = [int(langid.softmax(langid.vector(np.bincount(a, minlength=langid.FEATURES), model.idf)[1]
                                @ model.weights[a]).argmax()) == int(k[1]) for k, a, _ in sample]
    assert np.mean(right) > 0.98 and (model.weights == 0).mean() > 0.3

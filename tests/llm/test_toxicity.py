"""Operator 5: held-out labels, ordered grades, edge rows."""

import numpy as np

from pyspark.sql import functions as F

from sparkmart.llm import toxicity
from sparkmart.llm.queries import op5_toxicity

SF = "/root/testdata/sf0.01"
DOCS, LABELS = "doc_id long, text string, toxic int, _tox string", "doc_id long, quality int, toxic int"


def test_query_over_the_whole_table(spark):
    rows = {r.doc_id: r for r in op5_toxicity(spark, SF).collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    bad = [rows[i].toxic for i, y in labels.items() if y == 1 and i in rows]
    good = [rows[i].toxic for i, y in labels.items() if y == 0 and i in rows]
    assert np.mean(good) < 0.02 and np.mean(bad) > 0.6  # 51 toxic labels only at this size
    assert all(0 <= r.severity <= 2 and (r.p_toxic >= 0.3) == r.toxic for r in rows.values())


def corpus(rng, n):
    clean = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = list(rng.choice(clean, 60))
        if i % 4 == 0:
            text[3:3 + 1 + i % 3] = [f"vile{rng.integers(99)}" for _ in range(1 + i % 3)]
        rows.append((i, " ".join(text), 0, "c"))
        labels.append((i, 1, int(i % 4 == 0)))
    return rows, labels


def test_held_out_labels_and_edge_rows(spark):
    rows, labels = corpus(np.random.default_rng(1), 1200)
    extra = [(5000, None, 0, ""), (5001, "", 0, ""), (None, "vile7 w1", 0, ""), (5002, "vile5 " * 90_000, 0, ""),
             (5003, "w1 w2", 0, ""), (5003, "w1 w2", 0, "")]
    known = labels[:900] + [(None, 1, 1), (7, 1, None), (7, 1, 0), (8, 1, 1), (99_999, 1, 1)]
    got = toxicity.severities(spark.createDataFrame(rows + extra, DOCS),
                              spark.createDataFrame(known, LABELS)).collect()
    assert len(got) == len(rows) + len(extra)
    by = {r.doc_id: r for r in got}
    truth = {i: y for i, _, y in labels[900:]}
    assert all(by[i].toxic == bool(y) for i, y in truth.items())
    assert not by[5000].toxic and by[5000].severity == by[5001].severity
    assert by[None].toxic and by[5002].toxic and not by[5003].toxic
    assert by[5002].severity > 0.5


def test_without_two_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b", 0, "")], DOCS)
    none = spark.createDataFrame([], LABELS)
    one = spark.createDataFrame([(1, 1, 0)], LABELS)
    for labels in (none, one):
        assert [(r.grade, r.severity, r.toxic) for r in toxicity.severities(docs, labels).collect()] == [
            (0, 0.0, False)]
    assert toxicity.severities(spark.createDataFrame([], DOCS), one).collect() == []


def test_more_grades_share_weights_in_order():
    rng = np.random.default_rng(2)
    sample = []
    for i in range(1500):
        y = i % 4
        at = set(rng.integers(1000, 9000, 30).tolist()) | {10 + k for k in range(y) if rng.random() < 0.95}
        sample.append((y, np.array(sorted(at), np.int32)))
    model = toxicity.train(sample)
    assert len(model.thetas) == 3 and (np.diff(model.thetas) > 0).all()
    p = model.grades([a for _, a in sample])
    assert np.allclose(p.sum(1), 1) and (p >= 0).all()
    expected = p @ np.arange(4)
    means = [expected[k::4].mean() for k in range(4)]
    assert means == sorted(means) and means[3] - means[0] > 2


def test_filter_keeps_rows_and_columns(spark):
    rows, labels = corpus(np.random.default_rng(3), 400)
    df = spark.createDataFrame(rows, DOCS)
    kept = toxicity.not_toxic(df, spark.createDataFrame(labels, LABELS))
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(400) if i % 4]
    clashing = df.withColumn("_tox", F.col("doc_id") + 1).withColumn("row", F.lit("r"))
    got = toxicity.not_toxic(clashing, spark.createDataFrame(labels, LABELS)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, clashing.where("doc_id % 4 <> 0").collect()))

"""The pipeline: columns, whole predecessors, decisions that take effect."""

import re

from .helpers import jaccard

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in P.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF)
        assert kept.columns == docs.columns and kept.schema == docs.schema
        assert kept.exceptAll(before).isEmpty()
    rows = kept.collect()
    texts = [r.text for r in rows]
    assert len(set(texts)) == len(texts) > 0.5 * docs.count()
    assert not any(jaccard(a, b) >= 0.82 for i, a in enumerate(texts) for b in texts[:i])
    packed = P.STAGES[-1][1](spark, kept, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rows}
    assert sum(r.length for r in packed) == sum(len(re.findall(r"\S+", t)) for t in texts)


def test_run_and_registration(spark):
    import __spark_entry__ as E

    assert "pipeline" in E.queries() and P.ORACLE_SQL is None
    assert {f"op{n}_" for n in range(1, 11)} <= {re.match(r"op\d+_|", q)[0] for q in E.queries()}
    assert E.queries()["pipeline"](spark, SF).count() > 50

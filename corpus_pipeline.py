"""Corpus pipeline: documents in a known language, not toxic, one of each near-duplicate class, packed.

Every stage learns from and works on all rows that the stage before it kept.  All but the last return
the columns of ``documents``; the last returns the places of the documents in training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkmart.llm import langid, neardup, packing, toxicity
from sparkmart.llm.common import read, store


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose predicted language is not ``und`` and has probability 0.5 or more."""
    return langid.identified(docs, min_score=0.5)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose predicted severity is not toxic."""
    return toxicity.not_toxic(docs, read(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates, the one with the smallest id."""
    return neardup.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places the documents' pieces in training sequences."""
    return packing.pack_documents(docs)


STAGES = [("language", language), ("toxicity", civil), ("near-duplicates", distinct),
          ("packing", packed)]

#: The stages train models and walk graphs, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    df = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        df = store(stage(spark, df, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, df, sf_dir)

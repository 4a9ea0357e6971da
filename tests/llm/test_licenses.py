"""Operator 1 against a brute-force scan of every text."""

import pytest

from sparkmart.llm.licenses import TEMPLATES, scan_licenses
from sparkmart.llm.queries import op1_licenses

from .helpers import words

SF = "/root/testdata/sf0.01"


def expected(doc_id, text):
    w = words(text)
    base, labels, starts, score = set(), set(), [], 0.0
    for t in TEMPLATES:
        tw, key = t.text.split(), t.key.split()
        at = next(i for i in range(len(tw)) if tw[i:i + len(key)] == key)
        for p in range(-len(tw), len(w)):
            hit = [0 <= p + i < len(w) and w[p + i] == x for i, x in enumerate(tw)]
            if all(hit[at:at + len(key)]) and sum(hit) >= 0.75 * len(tw):
                labels.add(t.label)
                score = max(score, sum(hit) / len(tw))
                if t.base:
                    base.add(t.label)
                    starts.append(p)
    return (doc_id, len(w), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


def check(df, rows):
    got = [tuple(r) for r in df.collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted((expected(i, t) for i, t in rows), key=key)


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet")
            .select("doc_id", "text").collect()]
    check(op1_licenses(spark, SF), rows)


ROWS = [
    (1, "GNU General Public License"), (2, None), (3, ""), (None, "MIT-License; mit license MIT"),
    (5, "cc by cc by CC-BY cc cc by by"), (5, "cc by cc by CC-BY cc cc by by"), (6, "...!!!"),
    (7, "gnu gnu general public license license"), (8, "the MIT licenseé"), (9, "aMIT License"),
    (10, "Licensed under the Apache License, Version 2.0 and the MIT license"),
    (11, "word " * 50_000 + "apache\nlicense"), (12, "general public license gnu"),
    (13, "under the Apache License 2 0"), (14, "licensed under cc by nc 4"),
    (15, "permission is granted free of charge"),
    (16, "Redistribution and use in source and binary forms, with modification are permitted"),
    (17, "K mit LICENSE İ all rights reserved")]


def test_edge_rows(spark):
    df = spark.createDataFrame([(i, t, "x", [1]) for i, t in ROWS],
                               "doc_id long, text string, hits string, words array<int>")
    check(scan_licenses(df), ROWS)


@pytest.mark.parametrize("frequent", [[], [(90 + k, "gnu mit license public version general 3 under the")
                                           for k in range(5)]])
def test_a_rare_word_outside_the_key_phrase_is_replaced(spark, frequent):
    rows = [(1, "distributed under the MIT license"), (2, "released under the MIT license"),
            (3, "distributed under the GNU General Public License version 3"),
            (4, "permission is hereby granted free of charge to each person obtaining a copy of that software"),
            (5, "subject to all terms of the Mozilla Public License"), *frequent]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(scan_licenses(df), rows)
    got = {r.doc_id: r.labels.split(",") for r in scan_licenses(df).collect()}
    assert "mit-release" in got[1] and "gpl-3.0" in got[3] and "mit-grant" in got[4] and "mpl" in got[5]


def test_licences_in_other_words(spark):
    mit = next(t.text for t in TEMPLATES if t.label == "mit-text")
    rows = [(1, "distributed under the terms of the MIT licence"), (2, "// SPDX-License-Identifier: MIT"),
            (3, "licensed under the BSD 3-Clause license"), (4, "# SPDX-License-Identifier: GPL-3.0-only"),
            (5, f"word {mit} word"), (6, f"{mit} word " * 3), (7, "Permission to use, copy, modify, and/or "
            "distribute this software for any purpose with or without fee is hereby granted"),
            (8, "permission to deal"), (9, "mit " * 3000 + "license " * 3000), (10, "spdx license identifier")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(scan_licenses(df), rows)
    got = {r.doc_id: r.labels.split(",") for r in scan_licenses(df).collect()}
    assert [got[i] for i in (1, 2, 3, 4, 8, 10)] == [["mit"], ["mit"], ["bsd-3-clause"], ["gpl-3.0"], [""], [""]]
    assert {"mit-text", "mit-grant"} <= set(got[5]) and got[5] == got[6]


def test_no_rows(spark):
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("node", ["BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas"])
def test_native(spark, node):
    plan = op1_licenses(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert node not in plan

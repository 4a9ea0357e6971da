"""Operator 2 against prefix sums over the sorted rows."""

import zlib

import pytest

from sparkmart.llm.queries import op2_sharding
from sparkmart.llm.sharding import shard_by_bytes

SF = "/root/testdata/sf0.01"


def expected(rows, n):
    sized = sorted(((i is not None, i or 0), zlib.crc32((t or "").encode()), len((t or "").encode()) + 1)
                   for i, t in rows)
    total, at, out, slots = sum(s for _, _, s in sized), 0, [], {}
    for (known, i), crc, size in sized:
        shard = (2 * at + size) * n // (2 * total)
        out.append((i if known else None, size, crc, "bytes", shard, slots.get(shard, 0), None))
        slots[shard] = slots.get(shard, 0) + 1
        at += size
    return out


def check(df, rows, n=16):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(expected(rows, n), key=key)


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet")
            .select("doc_id", "text").collect()]
    df = op2_sharding(spark, SF)
    check(df, rows)
    sums = {}
    for r in df.collect():
        sums[r.shard] = sums.get(r.shard, 0) + r.size
    most = max(len((t or "").encode()) + 1 for _, t in rows)
    assert len(sums) == 16 and max(sums.values()) - min(sums.values()) <= 2 * most


@pytest.mark.parametrize("rows", [
    [(3, "abc"), (1, None), (2, ""), (None, "éé"), (None, "éé"), (7, "x" * 5000)],
    [(4, "same")] * 700, [(i, "t" * (i % 7)) for i in range(333)], [(1, None)]])
def test_edge_rows(spark, rows):
    df = spark.createDataFrame([(i, t, 5, "k") for i, t in rows], "doc_id long, text string, part int, shard string")
    check(shard_by_bytes(df), rows)


def test_no_rows(spark):
    assert shard_by_bytes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_native(spark):
    plan = op2_sharding(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan

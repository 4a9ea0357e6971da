"""Plans and files of the raw layer that a load of many records depends on."""

import re
import uuid

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.functions.json import payload_elements
from sparkmart.plans.queries import commit_measures
from sparkmart.session import checkpoint_root
from sparkmart.sources.raw import pack_batches
from sparkmart.sources.warehouse import Warehouse, empty_table
from tests.helpers import ts


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _raw(spark):
    recs = spark.range(6).select((F.col("id") % 2).cast("string").alias("repo_full_name"),
                                 F.struct(F.col("id").cast("string").alias("sha")).alias("rec"), "id")
    return pack_batches(recs, ["repo_full_name"], F.col("rec"), ["id"], ts(2024, 2, 1), key=["id"]
                        ).withColumn("org_or_user", F.lit("o"))


def test_records_are_ordered_without_a_lambda(spark):
    raw = _raw(spark)
    assert "lambda" not in _plan(raw)
    texts = sorted(r.t for r in raw.select(F.to_json("payload").alias("t")).collect())
    assert texts == ['[{"sha":"0"},{"sha":"2"},{"sha":"4"}]', '[{"sha":"1"},{"sha":"3"},{"sha":"5"}]']


def test_an_array_is_told_by_the_cast_alone(spark):
    assert "schema_of" not in _plan(_raw(spark).select(F.posexplode(payload_elements("payload")))).lower()


def test_raw_payloads_are_stored_whole(spark):
    wh = Warehouse(spark, f"{checkpoint_root(spark)}/wh-{uuid.uuid4().hex}")
    name = "spark.sql.variant.writeShredding.enabled"
    before = spark.conf.get(name, None)
    wh.append(S.RAW_COMMITS.name, _raw(spark))
    assert spark.conf.get(name, None) == before
    files = wh.read(S.RAW_COMMITS.name).inputFiles()
    assert files
    for f in files:
        payload = pq.read_schema(f.removeprefix("file://")).field("payload").type
        assert sorted(x.name for x in payload) == ["metadata", "value"]
    assert wh.read(S.RAW_COMMITS.name).select(F.explode(payload_elements("payload"))).count() == 6


def test_joins_with_an_empty_table_fall_away(spark):
    empty = empty_table(spark, S.STG_COMMITS)
    assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in S.STG_COMMITS.schema]
    ids = spark.range(3).select(F.col("id").cast("string").alias("sha"))
    assert "Join" not in _plan(ids.join(empty.select("sha"), "sha", "left_anti"))
    assert empty.count() == 0


def test_line_items_are_summed_up_by_number_first(spark):
    rows = [(1, 10, 2.5), (1, 10, 2.0), (1, 11, None), (1, None, 1.0), (2, None, None), (None, 3, 1.0)]
    got = commit_measures(spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_quantity double"))
    assert {r.sha: (r.additions, r.deletions, r.changed_files) for r in got.collect()} == {
        "1": (5, 4, 2), "2": (None, 1, 0), None: (1, 1, 1)}
    assert re.search(r"Aggregate \[l_orderkey#\d+L, l_partkey#\d+L\]", _plan(got))

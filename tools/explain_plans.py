"""Print the physical plans of the main operators over a scale folder (plan review aid).

    python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import datetime as dt
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from sparkmart import schemas as S  # noqa: E402
from sparkmart.operators.dedup import latest_batch, latest_per_key, top_k  # noqa: E402
from sparkmart.operators.incremental import compute_marks  # noqa: E402
from sparkmart.operators.keys import assign_keys  # noqa: E402
from sparkmart.operators.quality import dq_foreign_key, dq_watermark_not_ahead  # noqa: E402
from sparkmart.operators.upsert import upsert  # noqa: E402
from sparkmart.plans.tables import table  # noqa: E402
from sparkmart.session import get_session  # noqa: E402
from sparkmart.sources.paging import pages_of  # noqa: E402

KEEP = re.compile(r"(Exchange|BroadcastExchange|Join|WindowGroupLimit|Window |HashAggregate|"
                  r"TakeOrderedAndProject|Scan parquet|PushedFilters|ReadSchema|Union|Sort )")


def show(title, df):
    print(f"\n### {title}\n```")
    text = df._jdf.queryExecution().executedPlan().toString()
    for line in text.splitlines():
        if KEEP.search(line):
            print(re.sub(r"#\d+L?", "", line)[:160])
    print("```")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[2]", shuffle_partitions=16)
    orders, cust, ev = (table(spark, sf, n) for n in ("orders", "customer", "events"))
    tgt = orders.where(F.col("o_orderdate") < F.lit(dt.datetime(2001, 1, 1)))
    src = orders.where(F.col("o_orderdate") >= F.lit(dt.datetime(2000, 5, 1)))
    show("upsert, a source known to be tiny", upsert(tgt, src, ["o_orderkey"], ["o_orderstatus"],
                                          strategy="broadcast", assume_unique=True))
    # broadcasts off: what a source beyond AQE's threshold gets
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    show("upsert, one outer join", upsert(tgt, src, ["o_orderkey"], ["o_orderstatus"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    show("latest per key (W1)", latest_per_key(ev, ["user_id"], [F.col("ts").desc(),
                                                                 F.col("event_id").desc()]))
    show("latest batch (O1)", latest_batch(ev.withColumnRenamed("ts", "ingested_at"), ["user_id"]))
    show("top-k (O2)", top_k(cust, [F.col("c_acctbal").desc_nulls_last(), "c_custkey"], 10))
    show("paging (S4)", pages_of(ev, "user_id", [F.col("ts").desc()], [F.sum("event_id")],
                                 per_page=50, max_pages=10))
    show("surrogate keys (L6)", assign_keys(orders.select("o_orderkey"), "k", ["o_orderkey"], 0))
    show("marks below the join (I3)", compute_marks(orders, cust, fact_id_col="o_custkey",
                                                    dim_id_col="c_custkey", dim_name_col="c_name",
                                                    ts_col="o_orderdate"))
    show("FK check (Q2)", dq_foreign_key(orders, cust, "o_custkey", "c_custkey"))
    marks = (compute_marks(orders, cust, fact_id_col="o_custkey", dim_id_col="c_custkey",
                           dim_name_col="c_name", ts_col="o_orderdate")
             .withColumn("pipeline_name", F.lit(S.MARKS_PIPELINE)))
    show("mark check (Q3)", dq_watermark_not_ahead(marks, cust, orders, dim_name_col="c_name",
                                                   dim_id_col="c_custkey", fact_id_col="o_custkey",
                                                   ts_col="o_orderdate"))


if __name__ == "__main__":
    main()

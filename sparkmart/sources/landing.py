"""Landing: turn relational source tables into API-shaped record batches for the raw layer.

The reference lands pages of a REST API.  Here the source of records is a Spark table, so the same
warehouse can be driven from any input the cluster can read.  This module maps the driver's TPC-H-like
tables onto the API record shapes the loaders parse (``schemas.REPO_FIELDS`` / ``COMMIT_FIELDS``):

* ``customer`` -> repositories: ``id`` = c_custkey, ``full_name``/``name`` = c_name, ``owner.login`` = nation
  name, ``description`` = market segment, ``private`` and ``default_branch`` from the balance (``private`` is
  missing below 1,000); from the customer's orders ``created_at`` = oldest, ``pushed_at`` = newest,
  ``updated_at`` = an hour later, ``language`` = priority of the newest, counts of all (stars), finished
  (forks) and other orders (issues);
* ``orders`` -> commits of the customer's repository: ``sha`` = o_orderkey as text,
  ``commit.author.date`` = o_orderdate, ``commit.message`` = priority, ``author.login`` = status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import iso_utc
from .raw import CHUNK_SIZE, pack_batches


def repo_records(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    """``(org_or_user, repo_id, rec)``: one API repository object per customer."""
    last = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("_created"), F.max("o_orderdate").alias("_pushed"),
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("o_orderstatus") == "F").alias("_finished"),
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("_priority"))
    nat = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    c = (customer.join(nat, "c_nationkey", "left")
                 .join(last, "c_custkey", "left"))
    rec = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("full_name"),
        F.col("c_name").alias("name"),
        F.struct(F.col("n_name").alias("login")).alias("owner"),
        F.when(F.col("c_acctbal") < 0, F.lit(True)).when(F.col("c_acctbal") >= 1000, F.lit(False)).alias("private"),
        F.concat(F.lit("https://example.com/"), "c_name").alias("html_url"),
        F.col("c_mktsegment").alias("description"),
        F.col("_priority").alias("language"),
        F.when(F.col("c_acctbal") < 0, "trunk").otherwise("main").alias("default_branch"),
        iso_utc("_created").alias("created_at"),
        iso_utc(F.col("_pushed") + F.expr("INTERVAL 1 HOUR")).alias("updated_at"),
        iso_utc("_pushed").alias("pushed_at"),
        F.coalesce(F.col("_n"), F.lit(0)).cast("int").alias("stargazers_count"),
        F.coalesce(F.col("_finished"), F.lit(0)).cast("int").alias("forks_count"),
        (F.coalesce(F.col("_n"), F.lit(0)) - F.coalesce(F.col("_finished"), F.lit(0))).cast("int")
         .alias("open_issues_count"),
    )
    return c.select(F.col("n_name").alias("org_or_user"), F.col("c_custkey").alias("repo_id"),
                    rec.alias("rec"))


def commit_records(orders: DataFrame, customer: DataFrame, org: Column | str = "tpch") -> DataFrame:
    """``(org_or_user, repo_full_name, o_orderkey, rec)``: one API commit object per order."""
    names = customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    o = orders.join(names, "o_custkey", "inner")
    rec = F.struct(
        F.col("o_orderkey").cast("string").alias("sha"),
        F.struct(
            F.col("o_orderpriority").alias("message"),
            F.struct(F.col("c_name").alias("name"),
                     F.lit(None).cast("string").alias("email"),
                     iso_utc("o_orderdate").alias("date")).alias("author"),
        ).alias("commit"),
        F.struct(F.col("o_orderstatus").alias("login")).alias("author"),
    )
    org_col = F.lit(org) if isinstance(org, str) else org
    return o.select(org_col.alias("org_or_user"), F.col("c_name").alias("repo_full_name"),
                    "o_orderkey", "o_orderdate", rec.alias("rec"))


def land_repos(customer: DataFrame, nation: DataFrame, orders: DataFrame, as_of,
               chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """Raw repository batches: one per organisation (nation), chunked."""
    r = repo_records(customer, nation, orders)
    return pack_batches(r, ["org_or_user"], F.col("rec"), ["repo_id"], as_of, key=["repo_id"],
                        chunk_size=chunk_size)


def land_commits(orders: DataFrame, customer: DataFrame, as_of, *, entities: DataFrame | None = None,
                 chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """Raw commit batches: one per repository (customer), newest first inside a payload, chunked.

    ``entities`` (``org_or_user``, ``repo_full_name``) gives every listed repository a batch, ``[]``
    when it has no records.
    """
    r = commit_records(orders, customer)
    # payload order is ascending in the order key: negate time and key for newest first
    newest_first = [F.lit(0) - F.unix_micros(F.col("o_orderdate").cast("timestamp")),
                    F.lit(0) - F.col("o_orderkey")]
    return pack_batches(r, ["org_or_user", "repo_full_name"], F.col("rec"), newest_first, as_of,
                        key=["o_orderkey"], scopes=entities, chunk_size=chunk_size)

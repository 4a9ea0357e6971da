import datetime as dt
import json

from pyspark.sql import functions as F

UTC = dt.timezone.utc


def ts(*a):
    return dt.datetime(*a, tzinfo=UTC)


def raw_commits(spark, batches):
    """batches: list of (ingested_at, repo_full_name, python list payload or raw JSON text)."""
    rows = []
    for i, (ing, repo, payload) in enumerate(batches):
        text = payload if isinstance(payload, str) else json.dumps(payload)
        rows.append((ing, "github_api", "o", repo, f"b{i}", text))
    df = spark.createDataFrame(rows, "ingested_at timestamp, source string, org_or_user string, "
                                     "repo_full_name string, batch_id string, text string")
    return df.select("ingested_at", "source", "org_or_user", "repo_full_name", "batch_id",
                     F.lit(0).alias("chunk"),
                     F.parse_json("text").alias("payload"))


def raw_repos(spark, batches):
    rows = []
    for i, (ing, org, payload) in enumerate(batches):
        text = payload if isinstance(payload, str) else json.dumps(payload)
        rows.append((ing, "github_api", org, f"r{i}", text))
    df = spark.createDataFrame(rows, "ingested_at timestamp, source string, org_or_user string, "
                                     "batch_id string, text string")
    return df.select("ingested_at", "source", "org_or_user", "batch_id", F.lit(0).alias("chunk"),
                     F.parse_json("text").alias("payload"))


def commit(sha, date="2024-01-02T03:04:05Z", login="l", msg="m", name="n"):
    c = {"sha": sha, "commit": {"message": msg, "author": {"name": name, "email": "e", "date": date}},
         "author": {"login": login} if login is not None else None}
    return c


def repo(rid, full_name="o/a", pushed_at="2024-01-02T00:00:00Z", **kw):
    r = {"id": rid, "full_name": full_name, "name": full_name.split("/")[-1],
         "owner": {"login": full_name.split("/")[0]}, "private": False, "html_url": "u",
         "description": None, "language": "Java", "default_branch": "main",
         "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-02T00:00:00Z",
         "pushed_at": pushed_at, "stargazers_count": 5, "forks_count": 1, "open_issues_count": 0}
    r.update(kw)
    return r


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()

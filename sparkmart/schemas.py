"""Table definitions: column types, keys, required columns and defaults, in one place.

Spark does not enforce NOT NULL or keys on parquet, so each table carries them as data that the
constraint operators check (``operators.constraints``).  Timestamps are ``timestamp`` (zone-aware, the
session zone is pinned to UTC); the driver test tables read as ``timestamp_ntz`` and are cast at the edge.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LONG = T.LongType()
INT = T.IntegerType()
STR = T.StringType()
BOOL = T.BooleanType()
TS = T.TimestampType()
VARIANT = T.VariantType()


@dataclass(frozen=True)
class TableSpec:
    """Schema plus the constraints the reference declares on a table."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    # column -> SQL expression; "AS_OF" stands for the run's timestamp
    defaults: dict[str, str] = field(default_factory=dict)
    surrogate_key: str | None = None

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# --- fixed values: table layouts, defaults and constraints of the reference warehouse -------------
# raw layer: one row per extraction batch (per chunk of it), payload is a JSON array
RAW_REPOS = TableSpec(
    "raw_repos",
    _struct(("ingested_at", TS), ("source", STR), ("org_or_user", STR), ("batch_id", STR),
            ("chunk", INT), ("payload", VARIANT)),
    not_null=("ingested_at", "source", "org_or_user", "payload"),
    defaults={"source": "'github_api'", "ingested_at": "AS_OF"},
)
RAW_COMMITS = TableSpec(
    "raw_commits",
    _struct(("ingested_at", TS), ("source", STR), ("org_or_user", STR), ("repo_full_name", STR),
            ("batch_id", STR), ("chunk", INT), ("payload", VARIANT)),
    not_null=("ingested_at", "source", "org_or_user", "repo_full_name", "payload"),
    defaults={"source": "'github_api'", "ingested_at": "AS_OF"},
)
# staging layer: flattened, one row per natural key
STG_REPOS = TableSpec(
    "stg_repos",
    _struct(("repo_id", LONG), ("full_name", STR), ("name", STR), ("owner_login", STR),
            ("is_private", BOOL), ("html_url", STR), ("description", STR), ("language", STR),
            ("default_branch", STR), ("created_at", TS), ("updated_at", TS), ("pushed_at", TS),
            ("stargazers_count", INT), ("forks_count", INT), ("open_issues_count", INT),
            ("raw_ingested_at", TS), ("last_seen_at", TS)),
    keys=("repo_id",),
    not_null=("repo_id", "full_name", "name", "owner_login", "is_private", "raw_ingested_at",
              "last_seen_at"),
    defaults={"last_seen_at": "AS_OF"},
)
STG_COMMITS = TableSpec(
    "stg_commits",
    _struct(("sha", STR), ("repo_full_name", STR), ("repo_id", LONG), ("author_name", STR),
            ("author_email", STR), ("author_login", STR), ("commit_message", STR),
            ("committed_at", TS), ("additions", INT), ("deletions", INT), ("changed_files", INT),
            ("raw_ingested_at", TS), ("last_seen_at", TS)),
    keys=("sha",),
    not_null=("sha", "repo_full_name", "raw_ingested_at", "last_seen_at"),
    defaults={"last_seen_at": "AS_OF"},
)
# warehouse layer: SCD-1 dimension and fact with generated surrogate keys
DIM_REPOSITORY = TableSpec(
    "dim_repository",
    _struct(("repo_key", LONG), ("repo_id", LONG), ("full_name", STR), ("name", STR),
            ("owner_login", STR), ("is_private", BOOL), ("html_url", STR), ("description", STR),
            ("language", STR), ("default_branch", STR), ("created_at", TS), ("updated_at", TS),
            ("pushed_at", TS), ("stargazers_count", INT), ("forks_count", INT),
            ("open_issues_count", INT), ("effective_from", TS), ("effective_to", TS),
            ("is_current", BOOL)),
    keys=("repo_id",),
    not_null=("repo_key", "repo_id", "full_name", "name", "owner_login", "is_private",
              "effective_from", "is_current"),
    defaults={"effective_from": "AS_OF", "is_current": "true"},
    surrogate_key="repo_key",
)
FACT_COMMITS = TableSpec(
    "fact_commits",
    _struct(("commit_key", LONG), ("sha", STR), ("repo_id", LONG), ("repo_key", LONG),
            ("committed_at", TS), ("author_login", STR), ("author_name", STR),
            ("author_email", STR), ("commit_message", STR), ("additions", INT),
            ("deletions", INT), ("changed_files", INT), ("load_dts", TS)),
    keys=("sha",),
    not_null=("commit_key", "sha", "repo_id", "load_dts"),
    defaults={"load_dts": "AS_OF"},
    surrogate_key="commit_key",
)
# control tables
ETL_WATERMARK = TableSpec(
    "etl_watermark",
    _struct(("pipeline_name", STR), ("entity_name", STR), ("watermark_ts", TS), ("updated_at", TS)),
    keys=("pipeline_name", "entity_name"),
    not_null=("pipeline_name", "entity_name", "updated_at"),
    defaults={"updated_at": "AS_OF"},
)
ETL_RUN_LOG = TableSpec(
    "etl_run_log",
    _struct(("pipeline_name", STR), ("dag_id", STR), ("run_id", STR), ("logical_date", TS),
            ("start_ts", TS), ("end_ts", TS), ("status", STR), ("error_message", STR),
            ("raw_repos_batches", LONG), ("raw_commits_batches", LONG), ("stg_repos_rows", LONG),
            ("stg_commits_rows", LONG), ("dim_repository_rows", LONG), ("fact_commits_rows", LONG)),
    keys=("pipeline_name", "dag_id", "run_id"),
    not_null=("pipeline_name", "dag_id", "run_id", "start_ts", "status"),
    defaults={"start_ts": "AS_OF", "status": "'RUNNING'"},
)
# ours: the checks of each run, written before the gate raises
DQ_RESULTS = TableSpec(
    "dq_results",
    _struct(("run_id", STR), ("check_name", STR), ("ok", INT), ("violations", LONG),
            ("checked_at", TS)),
    keys=("run_id", "check_name"),
    not_null=("run_id", "check_name", "ok", "checked_at"),
    defaults={"checked_at": "AS_OF"},
)
# ours: every batch ingested up to here is staged (the folded part of the ledger below)
ETL_STAGING_MARK = TableSpec(
    "etl_staging_mark",
    _struct(("table_name", STR), ("staged_upto", TS)),
    keys=("table_name",),
    not_null=("table_name", "staged_upto"),
)
# ours: batches beyond the mark that are staged, while batches of another scope still wait
ETL_STAGED_BATCH = TableSpec(
    "etl_staged_batch",
    _struct(("table_name", STR), ("org_or_user", STR), ("batch_id", STR), ("ingested_at", TS)),
    keys=("table_name", "org_or_user", "batch_id"),
    not_null=("table_name", "org_or_user", "batch_id", "ingested_at"),
)
# ours: staged commits that the fact load has not taken yet (new ones, and those of unknown repositories)
STG_COMMITS_PENDING = TableSpec(
    "stg_commits_pending", STG_COMMITS.schema, keys=("sha",), not_null=("sha", "repo_full_name"))
# ours: the fact per repository, kept up from its change rows; fact_version is the state it reflects
FACT_BY_REPO = TableSpec(
    "fact_by_repo",
    _struct(("repo_id", LONG), ("n_commits", LONG), ("last_committed_at", TS), ("fact_version", LONG)),
    keys=("repo_id",),
    not_null=("n_commits", "fact_version"),
)
# ours: the fact per repository and month (D1), kept up in the same way
FACT_BY_MONTH = TableSpec(
    "fact_by_month",
    _struct(("repo_id", LONG), ("month_start", TS), ("n_commits", LONG), ("fact_version", LONG)),
    keys=("repo_id", "month_start"),
    not_null=("n_commits", "fact_version"),
)
# ours: counts carried from run to run; raw tables count batches, n_landed of them at landed_at
ETL_TABLE_ROWS = TableSpec(
    "etl_table_rows",
    _struct(("table_name", STR), ("version", LONG), ("n_rows", LONG), ("landed_at", TS),
            ("n_landed", LONG)),
    keys=("table_name",),
    not_null=("table_name", "version", "n_rows"),
)
# ours: one row per step of a run, input of the run outcome (R2)
TASK_STATES = TableSpec(
    "task_states",
    _struct(("dag_id", STR), ("run_id", STR), ("task_id", STR), ("state", STR)),
    keys=("dag_id", "run_id", "task_id"),
)

ALL_TABLES = (RAW_REPOS, RAW_COMMITS, STG_REPOS, STG_COMMITS, DIM_REPOSITORY, FACT_COMMITS,
              ETL_WATERMARK, ETL_RUN_LOG, ETL_STAGING_MARK, ETL_STAGED_BATCH, STG_COMMITS_PENDING,
              FACT_BY_REPO, FACT_BY_MONTH, ETL_TABLE_ROWS, DQ_RESULTS)
TABLES = {t.name: t for t in ALL_TABLES + (TASK_STATES,)}

# --- fixed values: JSON paths of the API payloads and the attribute lists the loads overwrite -----
# (output column, JSON path, type); "bool_false" = boolean defaulting to false when missing/null
REPO_FIELDS = (
    ("repo_id", "$.id", "bigint"),
    ("full_name", "$.full_name", "string"),
    ("name", "$.name", "string"),
    ("owner_login", "$.owner.login", "string"),
    ("is_private", "$.private", "bool_false"),
    ("html_url", "$.html_url", "string"),
    ("description", "$.description", "string"),
    ("language", "$.language", "string"),
    ("default_branch", "$.default_branch", "string"),
    ("created_at", "$.created_at", "timestamp"),
    ("updated_at", "$.updated_at", "timestamp"),
    ("pushed_at", "$.pushed_at", "timestamp"),
    ("stargazers_count", "$.stargazers_count", "int"),
    ("forks_count", "$.forks_count", "int"),
    ("open_issues_count", "$.open_issues_count", "int"),
)
REPO_KEY_PATH = "$.id"
COMMIT_FIELDS = (
    ("sha", "$.sha", "string"),
    ("author_name", "$.commit.author.name", "string"),
    ("author_email", "$.commit.author.email", "string"),
    ("author_login", "$.author.login", "string"),
    ("commit_message", "$.commit.message", "string"),
    ("committed_at", "$.commit.author.date", "timestamp"),
)
COMMIT_KEY_PATH = "$.sha"
# the 14 repository attributes that staging, the dimension and the alternative loader overwrite
REPO_ATTRIBUTES = (
    "full_name", "name", "owner_login", "is_private", "html_url", "description", "language",
    "default_branch", "created_at", "updated_at", "pushed_at", "stargazers_count", "forks_count",
    "open_issues_count",
)
# staging commit columns overwritten on conflict (besides the stamp)
COMMIT_STG_UPDATE = (
    "repo_full_name", "author_name", "author_email", "author_login", "commit_message",
    "committed_at", "raw_ingested_at",
)
# fact columns overwritten on conflict by the daily loader / by the alternative loader
FACT_UPDATE = ("repo_id", "committed_at", "author_login", "author_name", "author_email",
               "commit_message")
FACT_UPDATE_WITH_MEASURES = FACT_UPDATE + ("additions", "deletions", "changed_files")
# pipeline names used for marks and for the run log; default source label; default scope
MARKS_PIPELINE = "github_commits"
RUN_PIPELINE = "github_etl"
DEFAULT_SOURCE = "github_api"
DEFAULT_SCOPE = "apache"
# paging and windows: page size, page cap, look-back of the first read, quality look-back
PER_PAGE = 100
MAX_PAGES = 10
DEFAULT_LOOKBACK = "7 days"
RECENT_WINDOW = "30 minutes"
# run outcome: task ids left out of the outcome, culprit priority, status labels
RUN_LOG_TASKS = ("log_run_start", "log_run_end")
CULPRIT_PRIORITY = ("failed", "upstream_failed", "shutdown", "restarting", "removed", "none")

"""Layer loads built from the upsert: staging (from raw), SCD-1 dimension (L4), fact with key lookup
(L5), the alternative fact loader with left lookups and measures (L7).

Every function is pure: it takes the current tables and returns the next state of one table.  Column
names default to the reference warehouse and can be overridden for other entity pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..sources.payload import FieldSpec, flatten
from ..sources.raw import as_of_col
from .constraints import enforce_not_null
from .dedup import latest_batch, latest_per_key
from .upsert import upsert


def stage_latest_batch(
    target: DataFrame,
    raw: DataFrame,
    as_of,
    *,
    fields: Sequence[FieldSpec] = S.REPO_FIELDS,
    key_path: str = S.REPO_KEY_PATH,
    keys: Sequence[str] = ("repo_id",),
    scope_col: str = "org_or_user",
    scope: str | None = S.DEFAULT_SCOPE,
    update_cols: Sequence[str] = S.REPO_ATTRIBUTES + ("raw_ingested_at",),
    stamp_col: str = "last_seen_at",
    on_duplicate: str = "error",
    not_null: Sequence[str] = S.STG_REPOS.not_null,
    staged: DataFrame | None = None,
    changes_only: bool = False,
) -> DataFrame:
    """Raw repos -> staging: newest batch of ``scope`` (all scopes when None), flattened, upserted.

    A repository absent from the newest batch stays in staging.  A key twice in the batch is an error
    unless ``on_duplicate='latest'`` (then the last element of the batch wins; a key's records share a
    chunk).  ``staged`` lists batches (scope and ``batch_id``) that need no staging if they are the newest;
    ``changes_only`` gives the changed and new rows (with ``_op``) instead of the whole next state.
    """
    flt = F.col(scope_col) == F.lit(scope) if scope is not None else None
    newest = latest_batch(raw, [scope_col], "ingested_at", flt)
    if staged is not None:
        newest = newest.join(staged.select(scope_col, "batch_id"), [scope_col, "batch_id"], "left_anti")
    rows = flatten(newest, fields, keep=[("ingested_at", "raw_ingested_at"), "batch_id", "chunk"],
                   key_path=key_path, with_position=True)
    rows = enforce_not_null(rows, [c for c in not_null if c in rows.columns], "staging")
    stamp = as_of_col(as_of)
    if on_duplicate == "latest":
        rows = latest_per_key(rows, keys, [F.col("batch_id").desc(), F.col("chunk").desc(),
                                           F.col("_pos").desc()])
    elif on_duplicate != "error":
        raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
    return upsert(target, rows.drop("_pos", "batch_id", "chunk"), keys, update_cols,
                  on_update={stamp_col: stamp}, on_insert={stamp_col: stamp},
                  assume_unique=on_duplicate == "latest", changes_only=changes_only,
                  before=() if changes_only else None)


def stage_all_batches(
    target: DataFrame,
    raw: DataFrame,
    as_of,
    *,
    fields: Sequence[FieldSpec] = S.COMMIT_FIELDS,
    key_path: str = S.COMMIT_KEY_PATH,
    keys: Sequence[str] = ("sha",),
    entity_col: str = "repo_full_name",
    update_cols: Sequence[str] = S.COMMIT_STG_UPDATE,
    stamp_col: str = "last_seen_at",
    guard: bool = False,
    not_null: Sequence[str] = S.STG_COMMITS.not_null,
    changes_only: bool = False,
) -> DataFrame:
    """Raw commits -> staging: every batch re-read, latest element per key, upserted (W1 + L1).

    Ties on ``raw_ingested_at`` are broken by entity name, batch id, chunk and position.  A key's
    records of one batch share a chunk, so the last element of the batch wins and
    the result does not depend on file or partition order.  ``guard=True`` keeps a newer staging
    row against an older late batch (incremental form, T1).
    """
    rows = flatten(raw, fields, keep=[entity_col, ("ingested_at", "raw_ingested_at"), "batch_id",
                                      "chunk"],
                   key_path=key_path, with_position=True)
    rows = enforce_not_null(rows, [c for c in not_null if c in rows.columns], "staging")
    order = [F.col("raw_ingested_at").desc(), F.col(entity_col).asc(), F.col("batch_id").desc(),
             F.col("chunk").desc(), F.col("_pos").desc()]
    latest = latest_per_key(rows, keys, order).drop("_pos", "batch_id", "chunk")
    stamp = as_of_col(as_of)
    return upsert(target, latest, keys, update_cols,
                  on_update={stamp_col: stamp}, on_insert={stamp_col: stamp},
                  assume_unique=True,
                  guard_order=[("raw_ingested_at", "desc"), (entity_col, "asc")] if guard else None,
                  changes_only=changes_only, before=() if changes_only else None)


def load_dimension_scd1(
    dim: DataFrame,
    staging: DataFrame,
    as_of,
    *,
    keys: Sequence[str] = ("repo_id",),
    attributes: Sequence[str] = S.REPO_ATTRIBUTES,
    surrogate_key: str | None = "repo_key",
    effective_from: str = "effective_from",
    is_current: str = "is_current",
    assume_unique: bool = False,
    changes_only: bool = False,
) -> DataFrame:
    """L4: overwrite the attributes of known members, insert new ones with a fresh surrogate key.

    ``effective_from`` / ``is_current`` / ``effective_to`` and the surrogate key are set at insert and
    never touched afterwards (type 1: history is not kept).  A staging key that comes twice raises.
    ``changes_only`` gives new members and those with another attribute (with ``_op``).
    """
    src = staging.select(*keys, *attributes)
    on_insert: dict[str, Column] = {}
    if effective_from in dim.columns:
        on_insert[effective_from] = as_of_col(as_of)
    if is_current in dim.columns:
        on_insert[is_current] = F.lit(True)
    return upsert(dim, src, keys, attributes, on_insert=on_insert, surrogate_key=surrogate_key,
                  assume_unique=assume_unique, changes_only=changes_only, skip_equal=changes_only,
                  before=() if changes_only else None)


def fact_source(
    facts: DataFrame,
    lookup: DataFrame,
    *,
    fact_name_col: str = "repo_full_name",
    lookup_name_col: str = "full_name",
    lookup_id_col: str = "repo_id",
    columns: Sequence[str] = ("sha", "committed_at", "author_login", "author_name", "author_email",
                              "commit_message"),
) -> DataFrame:
    """Natural name -> id by an inner join; rows with an unknown name are left for a later run.

    The lookup side has one row per dimension member; AQE broadcasts it when it is small at run time.
    """
    ids = lookup.select(F.col(lookup_name_col).alias("_name"), F.col(lookup_id_col).alias("_id"))
    joined = facts.join(ids, F.col(fact_name_col) == F.col("_name"), "inner")
    return joined.select(columns[0], F.col("_id").alias(lookup_id_col), *columns[1:])


def load_fact(
    fact: DataFrame,
    staging_facts: DataFrame,
    staging_dims: DataFrame,
    as_of,
    *,
    keys: Sequence[str] = ("sha",),
    update_cols: Sequence[str] = S.FACT_UPDATE,
    stamp_col: str = "load_dts",
    surrogate_key: str | None = "commit_key",
    before: Sequence[str] | None = None,
    **lookup_kw,
) -> DataFrame:
    """Fact upsert from staging with the id lookup; ``repo_key`` is left as it is.

    Two dimension rows sharing a name fan a fact row out to two rows with one key: that raises (the
    reference's upsert aborts on it too): the upsert's check counts the source rows of each key.
    ``before`` asks for change rows alone, with ``_op`` and what these columns held before.
    """
    src = fact_source(staging_facts, staging_dims, **lookup_kw)
    stamp = as_of_col(as_of)
    return upsert(fact, src, keys, update_cols, on_update={stamp_col: stamp},
                  on_insert={stamp_col: stamp}, surrogate_key=surrogate_key,
                  changes_only=before is not None, before=before)


def load_fact_left_lookup(
    fact: DataFrame,
    staging_facts: DataFrame,
    staging_dims: DataFrame,
    dim: DataFrame,
    as_of,
    *,
    keys: Sequence[str] = ("sha",),
    fact_name_col: str = "repo_full_name",
    name_col: str = "full_name",
    id_col: str = "repo_id",
    columns: Sequence[str] = ("committed_at", "author_login", "author_name", "author_email",
                              "commit_message", "additions", "deletions", "changed_files"),
    update_cols: Sequence[str] = S.FACT_UPDATE_WITH_MEASURES,
    stamp_col: str = "load_dts",
    surrogate_key: str | None = "commit_key",
) -> DataFrame:
    """The alternative loader: left lookups staging -> staging dims -> dimension, and
    ``id = coalesce(fact.id, dim.id)``; an id still NULL breaks NOT NULL and raises."""
    names = staging_dims.select(F.col(name_col).alias("_name"), F.col(id_col).alias("_sid"))
    ids = dim.select(F.col(id_col).alias("_did"))
    j = (staging_facts.join(names, F.col(fact_name_col) == F.col("_name"), "left")
                      .join(ids, F.col("_sid") == F.col("_did"), "left"))
    src = j.select(*keys, F.coalesce(F.col(id_col), F.col("_did")).alias(id_col), *columns)
    src = enforce_not_null(src, [id_col], "fact")
    stamp = as_of_col(as_of)
    return upsert(fact, src, keys, update_cols, on_update={stamp_col: stamp},
                  on_insert={stamp_col: stamp}, surrogate_key=surrogate_key)

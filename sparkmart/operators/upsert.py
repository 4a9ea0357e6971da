"""Keyed upsert ``INSERT ... ON CONFLICT (k) DO UPDATE SET ...`` as a pure DataFrame function.

``upsert(target, source, keys, update_cols)`` returns the new state of ``target``:

* key in both: the ``update_cols`` take the source value (a NULL source value overwrites), columns not
  listed keep the target value, ``on_update`` expressions (stamps) are applied;
* key only in the source: inserted; target columns the source lacks get ``on_insert`` values or NULL;
  a surrogate key column is numbered after the target's largest key;
* key only in the target: kept unchanged.

A source with the same key twice is an error (PostgreSQL's "cannot affect row a second time").  The check is
a filter on the source, below every join: rows pass only through it, so no plan can leave it out.

Physical plan: one full outer join of target and source on the keys, each side read and shuffled once;
AQE may still turn it into a broadcast join from measured sizes where that is possible.  The keys are
unique on both sides, so no key is hot, and the duplicate check counts the source rows of a key in the
partitioning that the join needs anyway.  With a surrogate key the source is stored first (unless it
comes stored), the keys that the target lacks are numbered from their key columns alone, and the numbers
come back through the same partitioning.  ``strategy="broadcast"`` is for a caller that knows the source to
be a few rows (one run's outcome): the target is then streamed without a shuffle.

``changes_only`` returns the updated and inserted rows alone, for ``Warehouse.append_changes``;
``before`` adds how each row came about (``_op``) and what the named columns held before (``_old_<column>``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .dedup import latest_per_key
from .keys import assign_keys


def _once(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source``; fails the job that reads it when a key comes more than once."""
    rows = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    text = F.concat(F.lit("source holds keys more than once: "), F.to_json(F.struct(*keys)))
    return (source.withColumn("_n", rows)
            .where(F.when(F.col("_n") > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(True)))
            .drop("_n"))


def _prep_source(source: DataFrame, keys: Sequence[str], src_cols: Sequence[str],
                 on_update: Mapping[str, Column], on_insert: Mapping[str, Column]) -> DataFrame:
    return source.select(
        *[F.col(k) for k in keys],
        *[F.col(c).alias(f"_s_{c}") for c in src_cols],
        *[e.alias(f"_u_{c}") for c, e in on_update.items()],
        *[e.alias(f"_i_{c}") for c, e in on_insert.items()],
        F.lit(True).alias("_s_in"),
    )


def _prep_target(target: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.select(
        *[F.col(k) for k in keys],
        *[F.col(c).alias(f"_t_{c}") for c in target.columns if c not in keys],
        F.lit(True).alias("_t_in"),
    )


def _source_first(order: Sequence[tuple[str, str]]) -> Column:
    """Source row precedes or ties the target row under ``order`` (a NULL target value loses)."""
    result: Column = F.lit(True)  # tie on every column: the source wins
    for col, direction in reversed(list(order)):
        s, t = F.col(f"_s_{col}"), F.col(f"_t_{col}")
        better = s > t if direction == "desc" else s < t
        result = t.isNull() | better | (s.eqNullSafe(t) & result)
    return result


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    *,
    on_update: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
    insert: bool = True,
    on_duplicate: str = "error",
    dedup_order: Sequence[str | Column] | None = None,
    assume_unique: bool = False,
    guard_col: str | None = None,
    guard_order: Sequence[tuple[str, str]] | None = None,
    surrogate_key: str | None = None,
    strategy: str = "auto",
    stage_source: bool = False,
    changes_only: bool = False,
    skip_equal: bool = False,
    before: Sequence[str] | None = None,
) -> DataFrame:
    """New state of ``target`` after merging ``source`` on ``keys``; see the module doc.

    * ``on_update`` / ``on_insert``: column -> expression over the *source* row (``lit(as_of)`` stamps,
      defaults such as ``is_current = true``);
    * ``on_duplicate``: ``"error"`` (default) or ``"latest"`` (keep the first row per key under
      ``dedup_order``); ``assume_unique`` skips the check when the caller already deduplicated;
    * ``guard_col``: update a matched row only if ``source[guard_col] >= target[guard_col]`` (late old
      data must not beat newer rows in incremental loads); ``guard_order`` generalises it to a
      lexicographic order ``[(col, "desc"|"asc"), ...]``: the source row wins when it comes first
      under that order or ties on every column (use the same order as the dedup, so incremental
      and batch loads agree on ties);
    * ``surrogate_key``: target column numbered for inserted rows (dense, after the current maximum);
    * ``strategy``: ``"auto"`` (one outer join) or ``"broadcast"`` (the source is known to be tiny);
    * ``stage_source``: write a derived source once to the checkpoint folder (``checkpoint()``); always done
      with ``surrogate_key``, whose numbering reads the source's keys before the join does;
    * ``changes_only``: return only the rows that change (updated + inserted), in the target's
      schema, for a sink that merges or overwrites partitions in place instead of writing the whole
      next version (untouched rows are then never rewritten);
    * ``skip_equal`` (with ``changes_only``): leave out matched rows whose ``update_cols`` all stay as they are;
    * ``before`` (with ``changes_only``): add ``_op`` (``'I'`` or ``'U'``) and ``_old_<column>`` of these columns.
    """
    keys = list(keys)
    on_update = dict(on_update or {})
    on_insert = dict(on_insert or {})
    tcols = target.columns
    missing = [k for k in keys if k not in tcols or k not in source.columns]
    if missing:
        raise ValueError(f"upsert keys missing: {missing}")
    if update_cols is None:
        update_cols = [c for c in source.columns if c in tcols and c not in keys]
    update_cols = list(update_cols)
    bad = [c for c in update_cols if c not in source.columns or c not in tcols]
    if bad:
        raise ValueError(f"update columns not in both source and target: {bad}")

    if on_duplicate == "latest":
        if dedup_order is None:
            raise ValueError("on_duplicate='latest' needs dedup_order")
        source = latest_per_key(source, keys, dedup_order)
        assume_unique = True
    elif on_duplicate != "error":
        raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
    if not changes_only and (skip_equal or before is not None):
        raise ValueError("skip_equal and before need changes_only")
    if not assume_unique:
        source = _once(source, keys)
    if stage_source or surrogate_key is not None:
        source = materialize(source)
    src_cols = [c for c in source.columns if c in tcols and c not in keys]
    if guard_order is None and guard_col is not None:
        guard_order = [(guard_col, "desc")]
    guard = _source_first(guard_order) if guard_order else None
    s = _prep_source(source, keys, src_cols, on_update, on_insert)
    if surrogate_key is not None and insert:
        # the keys the target lacks, numbered from key columns alone
        missing_keys = source.select(*keys).join(target.select(*keys), keys, "left_anti")
        numbers = assign_keys(missing_keys, "_skey", keys,
                              start_after=target.select(F.col(surrogate_key).alias("_skey")))
        s = s.join(numbers, keys, "left")
    t = _prep_target(target, keys)
    types = {f.name: f.dataType for f in target.schema.fields}

    def matched_value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c == surrogate_key:
            return F.col(f"_t_{c}")
        upd = None
        if c in on_update:
            upd = F.col(f"_u_{c}")
        elif c in update_cols:
            upd = F.col(f"_s_{c}")
        if upd is None:
            return F.col(f"_t_{c}")
        cond = F.col("_s_in").isNotNull()
        if guard is not None:
            cond = cond & guard
        return F.when(cond, upd).otherwise(F.col(f"_t_{c}"))

    def inserted_value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c == surrogate_key:
            return F.col("_skey")
        if c in on_insert:
            return F.col(f"_i_{c}")
        if c in src_cols:
            return F.col(f"_s_{c}")
        return F.lit(None)

    def project(df: DataFrame, value, op: Column) -> DataFrame:
        cols = [value(c).cast(types[c]).alias(c) for c in tcols]
        if before is not None:
            cols.append(op.alias("_op"))
            cols += [F.col(c if c in keys else f"_t_{c}").cast(types[c]).alias(f"_old_{c}") for c in before]
        return df.select(*cols)

    def changed() -> Column:
        """Of a matched row: whether the source's row takes effect."""
        takes = F.lit(True) if guard is None else guard
        if skip_equal:
            differs = F.lit(False)
            for c in update_cols:
                differs = differs | ~F.col(f"_s_{c}").cast(types[c]).eqNullSafe(F.col(f"_t_{c}"))
            takes = takes & differs
        return takes

    if strategy == "broadcast":
        # untouched target rows are dropped from the output when only changes are asked for
        kept = t.join(F.broadcast(s), keys, "inner" if changes_only else "left")
        kept = project(kept.where(changed()) if changes_only else kept, matched_value, F.lit("U"))
        if not insert:
            return kept
        # keys of the target that the source touches: a key-only scan against the broadcast keys
        matched_keys = target.select(*keys).join(F.broadcast(source.select(*keys)), keys, "left_semi")
        new = s.join(F.broadcast(matched_keys), keys, "left_anti")
        if before is not None:
            new = new.select("*", *[F.lit(None).alias(f"_t_{c}") for c in before if c not in keys])
        return kept.unionByName(project(new, inserted_value, F.lit("I")))
    if strategy != "auto":
        raise ValueError(f"unknown strategy {strategy!r}")
    both = t.join(s, keys, "full_outer" if insert else "left")
    known = F.col("_t_in").isNotNull()
    if changes_only:
        both = both.where(F.col("_s_in").isNotNull() & (~known | changed()))
    if not insert:
        return project(both, matched_value, F.lit("U"))
    return project(both, lambda c: F.when(known, matched_value(c)).otherwise(inserted_value(c)),
                   F.when(known, "U").otherwise("I"))


def update_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  update_cols: Sequence[str] | None = None, **kw) -> DataFrame:
    """Keyed ``UPDATE``; source keys missing from the target are ignored (no insert)."""
    return upsert(target, source, keys, update_cols, insert=False, **kw)

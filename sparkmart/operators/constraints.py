"""Constraints Spark does not enforce on parquet: NOT NULL (C1), PK/UNIQUE (C2), defaults.

Two flavours:

* ``enforce_not_null`` is lazy: it wraps required columns in ``raise_error`` so the violation fails the
  very job that writes the table (no extra pass, nothing committed);
* ``null_counts`` / ``check_unique`` are eager reports for callers that want the offending counts or keys.
  Both return bounded results (one row / at most ``sample`` keys).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ConstraintError(ValueError):
    """A NOT NULL or UNIQUE rule of a table was broken."""


def enforce_not_null(df: DataFrame, cols: Sequence[str], table: str = "table") -> DataFrame:
    """Same rows; evaluating a NULL in one of ``cols`` raises (like a NOT NULL column)."""
    req = set(cols)
    out = []
    for c in df.columns:
        if c in req:
            out.append(F.when(F.col(c).isNull(),
                              F.raise_error(F.lit(f"NOT NULL violated: {table}.{c}")))
                       .otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def null_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """NULLs per column in one aggregate pass (partial + final, a single result row)."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    return {c: int(row[c]) for c in cols}


def check_unique(df: DataFrame, keys: Sequence[str], sample: int = 5,
                 raise_error: bool = True, table: str = "table") -> list[tuple]:
    """Keys that occur more than once (at most ``sample`` of them); raises unless told not to.

    Rows are counted by a 64-bit hash of the key (combined map-side, so a repeated key costs no more than
    another); whole keys are compared only among the rows whose hashes meet, which are none as a rule.
    """
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_h"))
    met = hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_h")
    if met.limit(1).count() == 0:
        return []
    dups = (hashed.join(met, "_h", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                  .where(F.col("_n") > 1).limit(sample).collect())
    found = [tuple(r[k] for k in keys) for r in dups]
    if found and raise_error:
        raise ConstraintError(f"UNIQUE {tuple(keys)} violated in {table}: {found}")
    return found


def default_columns(defaults: Mapping[str, str], as_of: _dt.datetime | Column | None = None
                    ) -> dict[str, Column]:
    """Table defaults as column expressions; ``AS_OF`` stands for the run timestamp."""
    from ..sources.raw import as_of_col

    out: dict[str, Column] = {}
    for col, sql in defaults.items():
        if sql == "AS_OF":
            if as_of is None:
                raise ValueError(f"default of {col} needs as_of")
            out[col] = as_of_col(as_of)
        else:
            out[col] = F.expr(sql)
    return out

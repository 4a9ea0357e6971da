"""Raw -> typed rows: explode JSON-array payloads and project typed fields.

Narrow transformations only (no shuffle): each raw row expands into its elements in the same task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json import json_field, payload_elements

FieldSpec = tuple[str, str, str]  # (output column, JSON path, kind)


def explode_payload(raw: DataFrame, keep: Sequence[str], payload: str = "payload") -> DataFrame:
    """One row per payload element: ``keep`` columns + ``_pos`` (0-based) + ``_elem`` (variant).

    A payload that is not a JSON array (object, scalar or JSON ``null``) raises; ``[]`` gives no rows.
    """
    return raw.select(*keep, F.posexplode(payload_elements(payload)).alias("_pos", "_elem"))


def flatten(
    raw: DataFrame,
    fields: Sequence[FieldSpec],
    keep: Sequence[str | tuple[str, str]] = (),
    key_path: str | None = None,
    payload: str = "payload",
    with_position: bool = False,
) -> DataFrame:
    """Strictly typed rows from raw batches.

    * ``fields``: ``(name, '$.json.path', kind)``; see ``json_field`` for the cast rules;
    * ``keep``: raw columns to carry, as names or ``(raw name, output name)`` pairs;
    * ``key_path``: elements whose key is missing or JSON null are dropped (``WHERE r->>'id' IS NOT NULL``).
    """
    keep_pairs = [(k, k) if isinstance(k, str) else k for k in keep]
    rows = explode_payload(raw, [src for src, _ in keep_pairs], payload)
    if key_path is not None:
        rows = rows.where(F.variant_get("_elem", key_path, "string").isNotNull())
    cols = [json_field("_elem", path, kind).alias(name) for name, path, kind in fields]
    cols += [F.col(src).alias(dst) for src, dst in keep_pairs]
    if with_position:
        cols.append(F.col("_pos"))
    return rows.select(*cols)

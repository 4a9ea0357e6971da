"""Column expressions for JSON payloads (Variant) and time text.

All of these are built-in Catalyst expressions, so they stay inside whole-stage codegen.  Strictness
follows the reference: a value that does not fit its type raises (ANSI cast), a missing key or JSON
``null`` is SQL NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_payload(text: str | Column) -> Column:
    """Text -> Variant; malformed JSON raises (like a ``::jsonb`` cast)."""
    return F.parse_json(_col(text))


def payload_elements(payload: str | Column, what: str = "payload") -> Column:
    """Variant payload -> ``array<variant>``, raising unless it is a JSON array.

    The cast alone raises on objects and scalars, but turns a JSON ``null`` into SQL NULL, which
    would silently explode to nothing; that case raises explicitly here.  The payload is read once,
    by the cast.
    """
    null = F.raise_error(F.lit(f"{what} is not a JSON array (null)"))
    return F.coalesce(_col(payload).cast("array<variant>"), null.cast("array<variant>"))


def payload_size(payload: str | Column) -> Column:
    """``jsonb_array_length``: element count; raises on a non-array."""
    return F.size(payload_elements(payload))


def json_field(element: str | Column, path: str, kind: str) -> Column:
    """One typed field of a JSON object.

    ``kind`` is a Spark SQL type name, or ``bool_false`` for a boolean that defaults to false.  The
    value is read as text and then cast, as ``(r->>'x')::int`` does: ``"7"`` becomes 7, while ``3.5``,
    ``"x"`` or an out-of-range number raise.  ``variant_get(..., 'int')`` would truncate 3.5 instead.
    """
    text = F.variant_get(_col(element), path, "string")
    if kind == "string":
        return text
    if kind == "bool_false":
        return F.coalesce(text.cast("boolean"), F.lit(False))
    return text.cast(kind)


def lenient_timestamp(text: str | Column) -> Column:
    """ISO-8601 text -> timestamp, NULL when unreadable (the extractor's skip-on-error parse)."""
    return _col(text).try_cast("timestamp")


def iso_utc(ts: str | Column, micros: bool = False) -> Column:
    """Timestamp -> ISO-8601 text in UTC with a ``Z`` suffix (API wire format)."""
    c = _col(ts).cast("timestamp")
    return F.date_format(c, ISO_MICROS if micros else ISO_SECONDS)

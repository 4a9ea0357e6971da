"""Scalar column expressions (JSON paths, strict casts, time text)."""

from .json import (iso_utc, json_field, lenient_timestamp, parse_payload, payload_elements,
                   payload_size)
from .frames import to_ntz

__all__ = ["iso_utc", "json_field", "lenient_timestamp", "parse_payload", "payload_elements",
           "payload_size", "to_ntz"]

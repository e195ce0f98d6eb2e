"""Column helpers: all of them are plain Spark expressions."""

from tidemark.functions.clean import (
    change_time,
    full_name,
    normalize_keys,
    parse_amount,
    parse_dates,
    to_iso_text,
)
from tidemark.functions.times import before, high, ntz, to_second

__all__ = [
    "before",
    "change_time",
    "full_name",
    "high",
    "normalize_keys",
    "ntz",
    "parse_amount",
    "parse_dates",
    "to_iso_text",
    "to_second",
]

"""Column functions and small driver-side helpers."""

from logbrook.functions.columns import (
    clean_keyword,
    contains_text,
    health_badge,
    hour_bucket,
    int_percent,
    row_total,
    severity_class,
    short_name,
)
from logbrook.functions.cursor import decode_cursor, encode_cursor
from logbrook.functions.timestamps import full_iso, parse_utc, utc_of

__all__ = [
    "clean_keyword",
    "contains_text",
    "decode_cursor",
    "encode_cursor",
    "full_iso",
    "health_badge",
    "hour_bucket",
    "int_percent",
    "parse_utc",
    "row_total",
    "severity_class",
    "short_name",
    "utc_of",
]

"""Scalar column expressions. All of them are built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from logbrook import schema as S


def hour_bucket(ts: Column) -> Column:
    """Start of the hour. ``window`` keeps TIMESTAMP_NTZ and needs no session time zone."""
    return F.window(ts, "1 hour").getField("start")


def severity_class(severity: Column) -> Column:
    """Severity for counting: WARNING and WARN are one class."""
    return F.when(severity == "WARNING", F.lit("WARN")).otherwise(severity)


def short_name(service: Column) -> Column:
    """Service name without its first "-service"."""
    return F.regexp_replace(service, r"(?s)^(.*?)-service", "$1")


def row_total() -> Column:
    """All events of a rollup row."""
    return sum((F.col(c) for c in S.COUNT_COLUMNS[1:]), F.col(S.COUNT_COLUMNS[0]))


def int_percent(part: Column, total: Column) -> Column:
    """Percentage rounded half up to an integer; 0 where there is no total."""
    exact = part / total * F.lit(100.0)
    return F.when(total > 0, F.floor(exact + F.lit(0.5))).otherwise(F.lit(0)).cast("bigint")


def health_badge(rate: Column) -> Column:
    return (
        F.when(rate > S.RED_PERCENT, "red").when(rate > S.AMBER_PERCENT, "amber").otherwise("green")
    )


def contains_text(text: Column, keyword: str | Column) -> Column:
    """Case-insensitive literal substring: no character of the keyword is a wildcard."""
    needle = F.lit(keyword) if isinstance(keyword, str) else keyword
    return F.contains(F.lower(text), F.lower(needle))


def clean_keyword(keyword: str | None) -> str | None:
    """Search argument: trimmed, and whole whatever its length; blank means no filter."""
    return (keyword or "").strip() or None

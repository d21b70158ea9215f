"""Relative and custom periods, resolved on the driver from an explicit "now"."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from logbrook import schema as S
from logbrook.operators.search import all_of

Period = tuple[dt.datetime | None, dt.datetime | None]
END_OF_DAY = dt.time(23, 59, 59)


def preset_period(preset: str, as_of: dt.datetime) -> Period:
    """The last hour, 6, 12 or 24 hours, or 7 days before ``as_of``."""
    if preset not in S.PRESET_HOURS:
        raise ValueError(f"unknown period {preset!r}; known: {', '.join(S.PRESET_HOURS)}")
    return as_of - dt.timedelta(hours=S.PRESET_HOURS[preset]), as_of


def _day(text: str, what: str) -> dt.date:
    try:
        return dt.date.fromisoformat(text)
    except ValueError:
        raise ValueError(f"{what} is no calendar date: {text!r}") from None


def custom_period(date_from: str | None, date_to: str | None, as_of: dt.datetime) -> Period:
    """From the start of one day to the end of another, the end day included.

    Without an end day the period ends now. Raises ValueError for text that is no date,
    a start in the future, and a start that is not before the end.
    """
    start = dt.datetime.combine(_day(date_from, "first day"), dt.time()) if date_from else None
    end = dt.datetime.combine(_day(date_to, "last day"), END_OF_DAY) if date_to else as_of
    if start and start > as_of:
        raise ValueError("the period would begin after now")
    if start and start >= end:
        raise ValueError("the period would end before it begins")
    return start, end


def hours_within(start: dt.datetime | None, end: dt.datetime | None) -> Column:
    """Rollup rows whose hour starts inside the inclusive range."""
    hour = F.col("hour_bucket")
    return all_of(
        [
            hour >= F.lit(start).cast("timestamp_ntz") if start else None,
            hour <= F.lit(end).cast("timestamp_ntz") if end else None,
        ]
    )

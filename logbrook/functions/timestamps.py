"""ISO 8601 text to UTC wall time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed patterns. The full form, which Spark casts; its zoned variant; and the accepted
# shorter forms, each with the text that spells it out.
_FULL = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})?)?$"
_ZONED = r"(Z|[+-]\d{2}:\d{2})$"
_SHORT_FORMS = (
    (r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])", "$1-$2-$3"),
    (r"([T ]\d{2})(?=$|Z|[+-])", "$1:00"),
    (r"([T ]\d{2})(\d{2})", "$1:$2"),
    (r"([T ]\d{2}:\d{2})(\d{2})", "$1:$2"),
    (r"([T ]\d{2}:\d{2})(?=$|Z|[+-])", "$1:00"),
    (r",(?=\d)", "."),
    (r"([T ][\d:.]+[+-]\d{2})(\d{2})$", "$1:$2"),
    (r"([T ][\d:.]+[+-]\d{2})$", "$1:00"),
)


def full_iso(text: Column) -> Column:
    """ISO 8601 text in its full form. Nearly all text has it already and is left alone."""
    trimmed = spelled = F.trim(text)
    for pattern, replacement in _SHORT_FORMS:
        spelled = F.regexp_replace(spelled, pattern, replacement)
    return F.when(trimmed.rlike(_FULL), trimmed).otherwise(spelled)


def utc_of(iso: Column) -> Column:
    """TIMESTAMP_NTZ in UTC of full ISO text, or NULL where it is no date or time.

    Text without an offset already is UTC. Text with one is converted, so the wall time
    (and the day and hour derived from it) does not depend on the sender's time zone.
    """
    instant = F.to_utc_timestamp(iso.try_cast("timestamp"), F.current_timezone())
    moment = F.when(iso.rlike(_ZONED), instant.cast("timestamp_ntz")).otherwise(
        iso.try_cast("timestamp_ntz")
    )
    return F.when(iso.rlike(_FULL), moment)


def parse_utc(text: Column) -> Column:
    return utc_of(full_iso(text))

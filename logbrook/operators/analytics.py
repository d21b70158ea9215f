"""Dashboard analytics over the hourly rollup and the service registry.

Inputs are already aggregated: one row per service and hour, or per service. Nothing in
here reads raw logs. Rankings cut to a few rows first and number those afterwards.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window as W, functions as F

from logbrook import schema as S
from logbrook.functions import health_badge, int_percent, row_total
from logbrook.operators.periods import hours_within


def _sums(columns) -> list:
    return [F.sum(c).cast("bigint").alias(c) for c in columns]


def stats(
    rollup: DataFrame,
    service: str | None = None,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rollup rows, newest hour first: all of them, or a page of ``limit`` rows."""
    rows = rollup.filter(hours_within(start, end))
    if service is not None:
        rows = rows.filter(F.col("service_name") == service)
    rows = rows.orderBy(F.desc("hour_bucket"), F.asc("service_name"))
    return rows if limit is None else rows.limit(limit)


def services(registry: DataFrame) -> DataFrame:
    """Registry, most recently seen service first."""
    return registry.orderBy(F.desc("last_seen"), F.asc("service_name"))


def service_counts(
    rollup: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None
) -> DataFrame:
    """Severity counts per service over a period."""
    return (
        rollup.filter(hours_within(start, end)).groupBy("service_name").agg(*_sums(S.COUNT_COLUMNS))
    )


def service_health(
    registry: DataFrame,
    rollup: DataFrame,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
) -> DataFrame:
    """Every known service with its counts, error rate and badge.

    ``error_rate`` relates the errors of the period to all events ever seen;
    ``window_error_rate`` relates them to the events of the period. Both are whole percent.
    """
    counts = service_counts(rollup, start, end)
    joined = registry.join(counts, "service_name", "left").fillna(0, list(S.COUNT_COLUMNS))
    rate = int_percent(F.col("error_count"), F.col("total_events"))
    return joined.withColumns(
        {
            "error_rate": rate,
            "window_error_rate": int_percent(F.col("error_count"), row_total()),
            "health": health_badge(rate),
        }
    )


def spikes(health: DataFrame, above: int = S.SPIKE_PERCENT) -> DataFrame:
    return health.filter(F.col("error_rate") > above).select(
        "service_name", "error_count", "total_events", "error_rate"
    )


def overall_totals(health: DataFrame) -> DataFrame:
    """One row: services, events, errors, error rate and badge over all services."""
    totals = health.agg(
        F.count("*").alias("n_services"),
        F.coalesce(F.sum("total_events"), F.lit(0)).cast("bigint").alias("total_events"),
        F.coalesce(F.sum("error_count"), F.lit(0)).cast("bigint").alias("total_errors"),
    )
    rate = int_percent(F.col("total_errors"), F.col("total_events"))
    return totals.withColumns({"error_rate": rate, "health": health_badge(rate)})


def most_active(registry: DataFrame) -> DataFrame:
    """The service with the most events."""
    return (
        registry.select("service_name", "total_events")
        .orderBy(F.desc("total_events"), F.asc("service_name"))
        .limit(1)
    )


def hourly_volume(
    rollup: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None
) -> DataFrame:
    """Severity counts per hour over all services."""
    return (
        rollup.filter(hours_within(start, end)).groupBy("hour_bucket").agg(*_sums(S.COUNT_COLUMNS))
    )


def peak_hour(
    rollup: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None
) -> DataFrame:
    """The hour with the most events over all services; the newest of equals."""
    hours = hourly_volume(rollup, start, end).select("hour_bucket", row_total().alias("total"))
    return hours.orderBy(F.desc("total"), F.desc("hour_bucket")).limit(1)


def peak_bucket(
    rollup: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None
) -> DataFrame:
    """The single (service, hour) with the most events."""
    rows = rollup.filter(hours_within(start, end))
    return (
        rows.select("service_name", "hour_bucket", row_total().alias("total"))
        .orderBy(F.desc("total"), F.desc("hour_bucket"), F.asc("service_name"))
        .limit(1)
    )


def top_error_services(health: DataFrame, n: int = S.TOP_SERVICES) -> DataFrame:
    """The services with the most errors: rank, and percent of the first one's errors."""
    order = [F.desc("error_count"), F.asc("service_name")]
    top = (
        health.filter(F.col("error_count") > 0)
        .select("service_name", "error_count")
        .orderBy(*order)
        .limit(n)
    )
    few = W.orderBy(*order)
    return top.select(
        F.row_number().over(few).cast("bigint").alias("rank"),
        "service_name",
        "error_count",
        (F.col("error_count") / F.max("error_count").over(W.partitionBy()) * F.lit(100.0)).alias(
            "pct_of_max"
        ),
    )


def error_trend(
    rollup: DataFrame,
    hours: int = S.TREND_HOURS,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
) -> DataFrame:
    """Errors and warnings of the newest hours, oldest of them first."""
    newest = hourly_volume(rollup, start, end).orderBy(F.desc("hour_bucket")).limit(hours)
    return newest.select(
        "hour_bucket", F.col("error_count").alias("errors"), F.col("warn_count").alias("warns")
    ).orderBy("hour_bucket")


def severity_split(
    rollup: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None
) -> DataFrame:
    """Events per severity class with their whole percent; classes without events are left out."""
    totals = rollup.filter(hours_within(start, end)).agg(
        *[F.sum(c).cast("bigint").alias(s) for c, s in zip(S.COUNT_COLUMNS, S.SEVERITY_CLASSES)]
    )
    parts = totals.unpivot([], list(S.SEVERITY_CLASSES), "severity", "value").filter("value > 0")
    # At most four rows: one per severity class.
    total = F.sum("value").over(W.partitionBy())
    return parts.withColumn("pct", int_percent(F.col("value"), total))


def severity_mix(health: DataFrame) -> DataFrame:
    """Share of every severity class within each service, without empty classes."""
    named = health.select(
        "service_name",
        *[F.col(c).alias(s) for c, s in zip(S.COUNT_COLUMNS, S.SEVERITY_CLASSES)],
    )
    parts = named.unpivot(["service_name"], list(S.SEVERITY_CLASSES), "severity", "value")
    total = F.sum("value").over(W.partitionBy("service_name"))
    return parts.filter("value > 0").withColumn("share", F.col("value") / total)

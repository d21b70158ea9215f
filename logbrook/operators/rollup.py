"""Hourly severity counts and the service registry.

Both are additive: partial results of any two sets of rows can be folded into the result
for all rows. That is what lets micro-batches append partials and readers sum them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from logbrook import schema as S
from logbrook.functions import hour_bucket, row_total, severity_class

_CLASS_OF_COUNT = dict(zip(S.COUNT_COLUMNS, S.SEVERITY_CLASSES))


def _severity_counts() -> list[Column]:
    kind = severity_class(F.col("severity"))
    return [F.count_if(kind == cls).alias(name) for name, cls in _CLASS_OF_COUNT.items()]


def _summed_counts() -> list[Column]:
    return [F.sum(c).cast("bigint").alias(c) for c in S.COUNT_COLUMNS]


def _last_host(ts: str) -> Column:
    """Host of the newest row; the greater name wins between equal times."""
    return F.max(F.struct(ts, "host")).getField("host")


def hourly_rollup(logs: DataFrame) -> DataFrame:
    """Counts per service, hour and severity class.

    ``updated_at`` is the newest event of the hour. Hash aggregation combines on the map
    side, so a service with most of the rows still shuffles one row per task and hour.
    """
    return logs.groupBy("service_name", hour_bucket(F.col("timestamp")).alias("hour_bucket")).agg(
        *_severity_counts(), F.max("timestamp").alias("updated_at")
    )


def hourly_partials(logs: DataFrame) -> DataFrame:
    """What one batch adds to the stored counts; serves the rollup and the registry.

    The newest host is found in two steps. Grouping by host first keeps every buffer
    fixed-width, so the pass over raw rows is a hash aggregation; taking the host with the
    newest time straight from raw rows would sort them all.
    """
    by_host = logs.groupBy(
        "service_name", hour_bucket(F.col("timestamp")).alias("hour_bucket"), "host"
    ).agg(
        *_severity_counts(),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
    )
    return by_host.groupBy("service_name", "hour_bucket").agg(
        *_summed_counts(),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        _last_host("last_seen").alias("last_host"),
    )


def fold_partials(partials: DataFrame) -> DataFrame:
    """Several partial rows per service and hour to one."""
    newest = F.max(F.struct("last_seen", "last_host")).getField("last_host")
    return partials.groupBy("service_name", "hour_bucket").agg(
        *_summed_counts(),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        newest.alias("last_host"),
    )


def rollup_of(partials: DataFrame) -> DataFrame:
    """Rollup rows from stored partials."""
    return partials.groupBy("service_name", "hour_bucket").agg(
        *_summed_counts(), F.max("last_seen").alias("updated_at")
    )


def merge_rollups(*rollups: DataFrame) -> DataFrame:
    """Add rollups up, row by row of the same service and hour."""
    return (
        reduce(DataFrame.unionByName, rollups)
        .groupBy("service_name", "hour_bucket")
        .agg(*_summed_counts(), F.max("updated_at").alias("updated_at"))
    )


def with_total(rollup: DataFrame) -> DataFrame:
    return rollup.withColumn("total", row_total())


def normalize_rollup(rollup: DataFrame) -> DataFrame:
    """Severity-named counts from either spelling of the count columns, missing = 0."""

    def count_of(name: str, cls: str) -> Column:
        spellings = [F.col(c) for c in (name, cls) if c in rollup.columns]
        return F.coalesce(*spellings, F.lit(0)).cast("bigint").alias(cls)

    keys = [c for c in ("service_name", "hour_bucket") if c in rollup.columns]
    return rollup.select(*keys, *[count_of(n, c) for n, c in _CLASS_OF_COUNT.items()])


def service_registry(logs: DataFrame) -> DataFrame:
    """First and last event, last known host and event count of every service."""
    by_host = logs.groupBy("service_name", "host").agg(
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
        F.count("*").alias("total_events"),
    )
    return by_host.groupBy("service_name").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        _last_host("last_seen").alias("host"),
        F.sum("total_events").cast("bigint").alias("total_events"),
    )


def registry_of(partials: DataFrame) -> DataFrame:
    """Registry from stored partials: the same rows as ``service_registry`` over the logs."""
    newest = F.max(F.struct("last_seen", "last_host")).getField("last_host")
    return partials.groupBy("service_name").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        newest.alias("host"),
        F.sum(row_total()).cast("bigint").alias("total_events"),
    )


def with_seed(registry: DataFrame, seed: DataFrame) -> DataFrame:
    """Add the seed services that never sent an event; present services stay untouched."""
    absent = seed.join(registry.select("service_name"), "service_name", "left_anti")
    return registry.unionByName(absent.select(*registry.columns))


def known_services(registry: DataFrame) -> DataFrame:
    return registry.select("service_name")

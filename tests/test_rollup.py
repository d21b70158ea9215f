import datetime as dt

import pytest
from pyspark.sql import functions as F

from logbrook import schema as S
from logbrook.operators import analytics, rollup

T0 = dt.datetime(2026, 3, 17, 10)


@pytest.fixture(scope="module")
def logs(spark):
    rows = []
    for i in range(40):
        service = "auth" if i % 3 else "pay"
        rows.append((service, T0 + dt.timedelta(minutes=17 * i), S.SEVERITIES[i % 5], f"h{i % 4}"))
    # Two hosts at the newest time: the greater name is the last host.
    rows.append(("pay", T0 + dt.timedelta(days=1), "INFO", "a"))
    rows.append(("pay", T0 + dt.timedelta(days=1), "INFO", "z"))
    return spark.createDataFrame(
        rows, "service_name string, timestamp timestamp_ntz, severity string, host string"
    ).cache()


def rows_of(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def test_counts_fold_warning_into_warn(logs):
    totals = rollup.hourly_rollup(logs).agg(*[F.sum(c).alias(c) for c in S.COUNT_COLUMNS]).first()
    assert totals.asDict() == {"error_count": 8, "warn_count": 16, "info_count": 10, "debug_count": 8}


def test_merge_of_any_split_equals_the_whole(logs):
    cut = F.col("timestamp") < T0 + dt.timedelta(hours=3, minutes=30)
    parts = [rollup.hourly_rollup(logs.filter(c)) for c in (cut, ~cut)]
    assert rows_of(rollup.merge_rollups(*parts)) == rows_of(rollup.hourly_rollup(logs))


def test_partials_give_the_same_rollup_and_registry(logs):
    cut = F.col("host") < "h2"
    parts = rollup.hourly_partials(logs.filter(cut)).unionByName(
        rollup.hourly_partials(logs.filter(~cut))
    )
    for partials in (parts, rollup.fold_partials(parts)):
        assert rows_of(rollup.rollup_of(partials)) == rows_of(rollup.hourly_rollup(logs))
        assert rows_of(rollup.registry_of(partials)) == rows_of(rollup.service_registry(logs))


def test_registry(logs):
    got = {r["service_name"]: r for r in rollup.service_registry(logs).collect()}
    assert got["pay"]["host"] == "z"
    assert got["pay"]["first_seen"] == T0
    assert got["pay"]["last_seen"] == T0 + dt.timedelta(days=1)
    assert got["auth"]["total_events"] + got["pay"]["total_events"] == 42


def seed_of(spark, *names):
    return spark.createDataFrame(
        [(n, T0, T0, S.SEED_HOST, 0) for n in names],
        "service_name string, first_seen timestamp_ntz, last_seen timestamp_ntz, host string, total_events long",
    )


def test_seed_only_adds_absent_services(spark, logs):
    registry = rollup.service_registry(logs)
    seeded = {r["service_name"]: r for r in rollup.with_seed(registry, seed_of(spark, "pay", "idle")).collect()}
    assert set(seeded) == {"auth", "pay", "idle"}
    assert seeded["pay"]["host"] == "z"
    assert seeded["idle"]["total_events"] == 0


def test_health_keeps_services_without_counts(spark, logs):
    registry = rollup.with_seed(rollup.service_registry(logs), seed_of(spark, "idle"))
    health = analytics.service_health(registry, rollup.hourly_rollup(logs))
    got = {r["service_name"]: r for r in health.collect()}
    idle = got["idle"]
    assert (idle["error_count"], idle["error_rate"], idle["health"]) == (0, 0, "green")
    assert got["pay"]["window_error_rate"] == got["pay"]["error_rate"]
    mix = analytics.severity_mix(health).groupBy("service_name").agg(F.sum("share").alias("s"))
    assert {r["service_name"]: round(r["s"], 9) for r in mix.collect()} == {"auth": 1.0, "pay": 1.0}


def test_totals_of_nothing(spark, logs):
    none = logs.filter("false")
    health = analytics.service_health(rollup.service_registry(none), rollup.hourly_rollup(none))
    assert analytics.overall_totals(health).first().asDict() == {
        "n_services": 0, "total_events": 0, "total_errors": 0, "error_rate": 0, "health": "green",
    }
    assert analytics.severity_split(rollup.hourly_rollup(none)).count() == 0
    assert analytics.top_error_services(health).count() == 0
    assert analytics.peak_hour(rollup.hourly_rollup(none)).count() == 0


def test_stats_bounds_are_inclusive_and_limited(logs):
    table = rollup.hourly_rollup(logs)
    hour = dt.datetime(2026, 3, 17, 12)
    assert {r["hour_bucket"] for r in analytics.stats(table, start=hour, end=hour).collect()} == {hour}
    # A start inside an hour leaves that hour out: buckets are compared by their start.
    late = analytics.stats(table, start=hour + dt.timedelta(minutes=1), end=hour)
    assert late.count() == 0
    newest = analytics.stats(table, limit=3).collect()
    assert [r["hour_bucket"] for r in newest] == sorted((r["hour_bucket"] for r in newest), reverse=True)
    assert analytics.stats(table, limit=None).count() == table.count()


def test_trend_is_the_newest_hours_in_order(logs):
    trend = [r["hour_bucket"] for r in analytics.error_trend(rollup.hourly_rollup(logs), 4).collect()]
    hours = sorted({r["hour_bucket"] for r in rollup.hourly_rollup(logs).collect()})
    assert trend == hours[-4:]


def test_top_services_rank_and_share(spark):
    rows = [(f"s{i}", T0, 10 - i if i < 7 else 0) for i in range(9)]
    health = spark.createDataFrame(rows, "service_name string, t timestamp_ntz, error_count long")
    got = [tuple(r) for r in analytics.top_error_services(health).orderBy("rank").collect()]
    assert got == [(i + 1, f"s{i}", 10 - i, (10 - i) / 10 * 100.0) for i in range(5)]


def test_normalize_accepts_both_spellings(spark):
    df = spark.createDataFrame([(1, None, 3)], "error_count long, WARN long, INFO long")
    assert rollup.normalize_rollup(df).first().asDict() == {"ERROR": 1, "WARN": 0, "INFO": 3, "DEBUG": 0}


def test_raw_rows_are_hash_aggregated(logs):
    for df in (rollup.hourly_rollup(logs), rollup.hourly_partials(logs), rollup.service_registry(logs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        # The deepest aggregation is the one over raw rows.
        deepest = [line for line in plan.splitlines() if "Aggregate(" in line][-1]
        assert "HashAggregate" in deepest and "partial_" in deepest

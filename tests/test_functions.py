import datetime as dt

import pytest
from pyspark.sql import functions as F

from logbrook import functions as fn
from logbrook.operators import periods


def values(spark, column, *inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_iso_timestamps(spark, zone):
    ten = dt.datetime(2026, 3, 17, 10)
    cases = {
        "2026-03-17T10:00:00Z": ten,
        "2026-03-17T10:00:00": ten,
        "2026-03-17 10:00:00.25": ten.replace(microsecond=250000),
        "2026-03-17T10:00:00,25Z": ten.replace(microsecond=250000),
        "2026-03-17T10:00:00+05:30": dt.datetime(2026, 3, 17, 4, 30),
        "2026-03-17T01:00:00+05:30": dt.datetime(2026, 3, 16, 19, 30),
        "2026-03-17T10:00:00-03": dt.datetime(2026, 3, 17, 13),
        "2026-03-17T10:00": ten,
        "2026-03-17T10Z": ten,
        "2026-03-17": dt.datetime(2026, 3, 17),
        "20260317T100000": ten,
        "20260317T1000+0530": dt.datetime(2026, 3, 17, 4, 30),
        "20260317": dt.datetime(2026, 3, 17),
        " 2026-03-17T10:00:00Z ": ten,
        "junk": None,
        "": None,
        "2026": None,
        "2026-3-17": None,
        "2026-13-17": None,
        "2026-03-17T25:00:00": None,
        "2026-03-17Z": None,
        "1773741600": None,
        "2026-03-17T10:00:00 Europe/Paris": None,
    }
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(spark, fn.parse_utc, *cases)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert dict(zip(cases, got)) == cases


def test_short_name_drops_the_first_suffix_only(spark):
    names = ("auth-service", "a-service-service", "api-gateway", "-service")
    assert values(spark, fn.short_name, *names) == ["auth", "a-service", "api-gateway", ""]


def test_keyword_is_literal_and_case_insensitive(spark):
    texts = ("Payment FAILED 100%", "payment ok", "a.b", "aXb", None)

    def hits(q):
        return values(spark, lambda c: fn.contains_text(c, q), *texts)

    assert hits("failed 100%") == [True, False, False, False, None]
    assert hits("a.b") == [False, False, True, False, None]
    assert hits("%") == [True, False, False, False, None]


def test_clean_keyword():
    assert fn.clean_keyword("  Fail  ") == "Fail"
    assert fn.clean_keyword("   ") is None
    assert fn.clean_keyword(None) is None
    assert fn.clean_keyword("x" * 300) == "x" * 300


def test_percent_rounds_half_up_and_guards_zero(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (0, 5), (3, 0), (5, 200)], "p long, t long")
    got = [r[0] for r in df.select(fn.int_percent(F.col("p"), F.col("t"))).collect()]
    assert got == [13, 33, 0, 0, 3]


def test_badge_thresholds(spark):
    rates = (0, 3, 4, 10, 11)
    got = values(spark, fn.health_badge, *rates, kind="int")
    assert got == ["green", "green", "amber", "amber", "red"]


def test_cursor_round_trip():
    ts = dt.datetime(2026, 3, 17, 10, 0, 0, 250)
    assert fn.decode_cursor(fn.encode_cursor(ts, "abc")) == (ts, "abc")
    offset = fn.encode_cursor("2026-03-17T10:00:00+05:30", "abc")
    assert fn.decode_cursor(offset) == (dt.datetime(2026, 3, 17, 4, 30), "abc")


@pytest.mark.parametrize("token", ["", "%%%", "e30=", "bm90IGpzb24="])
def test_bad_cursor(token):
    with pytest.raises(ValueError):
        fn.decode_cursor(token)


NOW = dt.datetime(2026, 3, 17, 12)


def test_presets():
    assert periods.preset_period("6h", NOW) == (dt.datetime(2026, 3, 17, 6), NOW)
    assert periods.preset_period("7d", NOW) == (dt.datetime(2026, 3, 10, 12), NOW)
    with pytest.raises(ValueError):
        periods.preset_period("2h", NOW)


def test_custom_period():
    end = dt.datetime(2026, 3, 16, 23, 59, 59)
    assert periods.custom_period("2026-03-16", "2026-03-16", NOW) == (dt.datetime(2026, 3, 16), end)
    assert periods.custom_period("2026-03-16", None, NOW) == (dt.datetime(2026, 3, 16), NOW)
    assert periods.custom_period(None, "2026-03-16", NOW) == (None, end)


@pytest.mark.parametrize(
    "first, last, message",
    [
        ("x", None, "first day is no calendar date"),
        ("2026-03-16", "x", "last day is no calendar date"),
        ("2026-03-18", None, "after now"),
        ("2026-03-16", "2026-03-15", "before it begins"),
    ],
)
def test_custom_period_errors(first, last, message):
    with pytest.raises(ValueError, match=message):
        periods.custom_period(first, last, NOW)

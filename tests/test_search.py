import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from logbrook import schema as S
from logbrook.operators import saved, search

T0 = dt.datetime(2026, 3, 17, 10)


def make_logs(spark, rows):
    """Rows are (service, timestamp, id, severity, message, host)."""
    df = spark.createDataFrame(
        rows, "service_name string, timestamp timestamp_ntz, log_uuid string, severity string, "
        "message string, host string",
    )
    return df.withColumn("log_date", F.to_date("timestamp"))


@pytest.fixture(scope="module")
def logs(spark):
    rows = []
    for i in range(60):
        # Three rows share each timestamp, so the id decides between them.
        ts = T0 + dt.timedelta(hours=i // 3)
        severity = S.SEVERITIES[i % 5]
        rows.append(("auth", ts, f"id-{i * 7 % 60:02d}", severity, f"Event {i} at 50%", f"h{i % 2}"))
    rows.append(("other", T0, "id-99", "ERROR", "event", "h0"))
    return make_logs(spark, rows).cache()


def ids(df):
    return [r["log_uuid"] for r in df.collect()]


def ordered(logs, keep=lambda r: True):
    rows = [r for r in logs.collect() if r["service_name"] == "auth" and keep(r)]
    rows.sort(key=lambda r: r["log_uuid"])
    rows.sort(key=lambda r: r["timestamp"], reverse=True)
    return [r["log_uuid"] for r in rows]


def test_pages_are_disjoint_and_complete(logs):
    token, pages = None, []
    while True:
        page = search.search_page(logs, "auth", limit=7, page_token=token)
        pages += ids(page.results)
        token = page.next_cursor
        if token is None:
            break
    assert pages == ordered(logs)


def test_page_keeps_the_filters(logs):
    first = search.search_page(logs, "auth", limit=5, severity="ERROR")
    second = search.search_page(logs, "auth", 5, severity="ERROR", page_token=first.next_cursor)
    errors = ordered(logs, lambda r: r["severity"] == "ERROR")
    assert ids(first.results) + ids(second.results) == errors[:10]


def test_recent_days_are_tried_first(logs):
    def tried(**filters):
        return search._starts_to_try(filters)

    end = dt.datetime(2026, 3, 20)
    assert tried(end=end) == [dt.datetime(2026, 3, 19), dt.datetime(2026, 2, 18), None]
    assert tried(as_of=end) == tried(end=end)
    assert tried() == [None]
    assert tried(start=T0, end=end) == [T0]
    assert tried(end=end, granularity="date") == [None]
    # Nothing in the last days, some rows in the last days, all rows: always the same page.
    for end in (dt.datetime(2027, 1, 1), T0 + dt.timedelta(days=40), T0 + dt.timedelta(hours=30)):
        for limit in (3, 20, 59, 60):
            page = search.search_page(logs, "auth", limit, end=end)
            assert ids(page.results) == ordered(logs)[:limit]
            assert (page.next_cursor is None) == (limit == 60)


def test_last_page_has_no_token(logs):
    assert search.search_page(logs, "auth", limit=60).next_cursor is None
    assert search.search_page(logs, "auth", limit=59).next_cursor is not None
    empty = search.search_page(logs, "nobody")
    assert (empty.results.count(), empty.next_cursor) == (0, None)


def test_keyword_reaches_old_rows(logs):
    # The only match is the oldest row; a limit before the filter would lose it.
    assert ids(search.search(logs, "auth", limit=1, q="EVENT 0 at")) == ["id-00"]
    assert ids(search.search(logs, "auth", limit=500, q="50%")) == ordered(logs)
    assert ids(search.search(logs, "auth", limit=500, q="   ")) == ordered(logs)
    assert ids(search.search(logs, "auth", q="5_%")) == []


def test_severity_sets(logs):
    def found(**filters):
        return ids(search.search(logs, "auth", limit=500, **filters))

    assert found(severity="warn") == ordered(logs, lambda r: r["severity"] == "WARN")
    assert found(severity=["warn", "error"]) == ordered(
        logs, lambda r: r["severity"] in ("WARN", "ERROR")
    )
    assert found(severity=[]) == ordered(logs)
    assert found(severity="WARN", fold_warning=True) == ordered(
        logs, lambda r: r["severity"].startswith("WARN")
    )


@pytest.mark.parametrize(
    "start, end, days",
    [
        (dt.datetime(2026, 3, 17, 23), dt.datetime(2026, 3, 18, 1), {17, 18}),
        (dt.datetime(2026, 3, 17, 23), None, {17}),
        (None, dt.datetime(2026, 3, 18, 1), {18}),
        (None, None, {18}),
        (dt.datetime(2026, 3, 18), dt.datetime(2026, 3, 17), set()),
    ],
)
def test_whole_days(logs, start, end, days):
    found = search.search(
        logs, "auth", limit=500, start=start, end=end, granularity="date",
        as_of=dt.datetime(2026, 3, 18, 5),
    )
    assert ids(found) == ordered(logs, lambda r: r["timestamp"].day in days)


def test_exact_time_accepts_offsets(logs):
    zone = dt.timezone(dt.timedelta(hours=5, minutes=30))
    start = dt.datetime(2026, 3, 17, 16, 30, tzinfo=zone)  # 11:00 UTC
    found = search.search(logs, "auth", limit=500, start=start, end=T0 + dt.timedelta(hours=2))
    assert ids(found) == ordered(logs, lambda r: r["timestamp"].hour in (11, 12) and r["timestamp"].day == 17)


@pytest.mark.parametrize("limit", [0, -1, 501])
def test_limit_is_checked(logs, limit):
    with pytest.raises(ValueError):
        search.search(logs, "auth", limit=limit)


def test_bad_arguments(logs):
    with pytest.raises(ValueError):
        search.search(logs, "auth", granularity="hour")
    with pytest.raises(ValueError):
        search.search(logs, "auth", granularity="date")


def test_host_search_spans_services(logs):
    found = search.search_host(logs, "h0", limit=500)
    assert {r["service_name"] for r in found.collect()} == {"auth", "other"}


def test_result_columns_and_empty_metadata(logs):
    row = search.search(logs, "auth", limit=1).first()
    assert tuple(row.asDict()) == S.LOG_COLUMNS
    assert row["metadata"] == {}


def test_newest_per_day(logs):
    got = search.per_day_newest(logs.repartition(16), 4).orderBy("log_date", "rank").collect()
    for service, day in {(r["service_name"], r["log_date"]) for r in got}:
        mine = [r["log_uuid"] for r in got if (r["service_name"], r["log_date"]) == (service, day)]
        if service == "auth":
            assert mine == ordered(logs, lambda r: r["log_date"] == day)[:4]
        else:
            assert mine == ["id-99"]


def test_dedup(logs):
    assert search.dedup(logs.unionByName(logs).unionByName(logs)).count() == 61


def test_saved_queries(spark, logs):
    rows = [
        (1, "errors", '{"service":"auth","severity":"error","limit":3}', "cli", T0),
        (2, "word", '{"service":"auth","q":" EVENT 1 "}', "cli", T0),
        (3, "range", '{"service":"auth","start":"2026-03-18T00:00:00","limit":500}', "cli", T0),
        (4, "no service", '{"q":"event"}', "cli", T0),
        (5, "nothing", '{"service":"nobody"}', "cli", T0),
        (6, "broken", "not json", "cli", T0),
    ]
    stored = spark.createDataFrame(rows, S.SAVED_QUERIES_SCHEMA)
    got = {}
    for r in saved.run_saved_queries(logs, stored).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["log_uuid"])
    assert got == {
        1: ordered(logs, lambda r: r["severity"] == "ERROR")[:3],
        2: ordered(logs, lambda r: "event 1" in r["message"].lower())[:50],
        3: ordered(logs, lambda r: r["timestamp"] >= dt.datetime(2026, 3, 18)),
    }


def test_saved_queries_that_cannot_be_run_are_named(spark, logs):
    texts = {
        "fine": '{"service":"auth","limit":2}',
        "not_json": "service=auth",
        "no_service": '{"q":"x"}',
        "bad_severity": '{"service":"auth","severity":"loud"}',
        "bad_start": '{"service":"auth","start":"yesterday"}',
        "bad_end": '{"service":"auth","end":"soon"}',
        "bad_limit": '{"service":"auth","limit":501}',
    }
    rows = [(i, name, text, "cli", T0) for i, (name, text) in enumerate(texts.items())]
    stored = spark.createDataFrame(rows, S.SAVED_QUERIES_SCHEMA)
    rejected = saved.rejected_saved(stored).collect()
    assert {(r["query_name"], r["reason"]) for r in rejected} == {(n, n) for n in texts if n != "fine"}
    found = saved.run_saved_queries(logs, stored).collect()
    assert [r["query_name"] for r in found] == ["fine", "fine"]


def test_a_long_keyword_is_not_shortened(spark, logs):
    long = "event 1" + "x" * 300
    assert search.matching(logs, q=long).isEmpty()
    stored = spark.createDataFrame([(1, "q", json.dumps({"service": "auth", "q": long}), "cli", T0)], S.SAVED_QUERIES_SCHEMA)
    assert saved.run_saved_queries(logs, stored).isEmpty()


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_search_is_a_top_k_and_prunes_days(spark, logs, tmp_path):
    from logbrook.sources import tables as t

    path = str(tmp_path / "logs")
    t.write_logs(logs.withColumn("metadata", F.create_map().cast("map<string,string>")), path)
    found = search.search(
        t.read_logs(spark, path), "auth", severity="INFO", start=T0, end=T0 + dt.timedelta(hours=1)
    )
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = plan_of(found)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "TakeOrderedAndProject" in plan
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "log_date" in partition_filters
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(severity,INFO)" in pushed and "timestamp" in pushed and "EqualTo(service_name,auth)" in pushed


def test_group_ranking_cuts_before_the_shuffle(logs):
    assert plan_of(search.per_day_newest(logs, 4)).count("WindowGroupLimit") >= 2

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from logbrook.operators import ingest

GOOD = {
    "timestamp": "2026-03-17T10:00:00Z",
    "service": "auth-service",
    "severity": "info",
    "message": "ok",
}


def event(**changes):
    return json.dumps({k: v for k, v in {**GOOD, **changes}.items() if v is not ...})


def reasons(spark, lines, step=ingest.ingest_lines):
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    found = {r["i"]: r["reason"] for r in step(df).select("i", "reason").collect()}
    return {line: found.get(i, "absent") for i, line in enumerate(lines)}


def test_parse_edge_cases(spark):
    good = event()
    cases = {
        good: None,
        f"  {good}  ": None,
        good + "\r": None,
        "": "absent",
        "   ": "absent",
        "NOT_JSON": "not_json",
        '{"a":1': "not_json",
        good + " x": "not_json",
        good + "," + good: "not_json",
        good.replace('"', "'"): "not_json",
        "[1]": "missing_key",
        "123": "missing_key",
        "null": "missing_key",
        f"[{good}]": "missing_key",
        '{"a":1}': "missing_key",
        event(message=...): "missing_key",
        # A null value is a present key: the line is passed on and judged later.
        event(message=None): None,
    }
    assert reasons(spark, cases, ingest.parse_lines) == cases


def test_repeated_key_keeps_the_last_value(spark):
    line = event()[:-1] + ', "service": "second"}'
    df = spark.createDataFrame([(line,)], "line string")
    row = ingest.ingest_lines(df).first()
    assert (row["reason"], row["service_name"]) == (None, "second")


def test_field_rules(spark):
    cases = {
        event(severity="Warning"): None,
        event(severity="fatal"): "bad_severity",
        event(severity=None): "bad_severity",
        event(severity=3): "bad_severity",
        event(service=""): "bad_service",
        event(service="s" * 100): None,
        event(service="s" * 101): "bad_service",
        event(service="é" * 100): None,
        event(service=5): "bad_service",
        event(message=""): "bad_message",
        event(message="m" * 10_000): None,
        event(message="m" * 10_001): "bad_message",
        event(message=None): "bad_message",
        event(host="h" * 255): None,
        event(host="h" * 256): "bad_host",
        event(host=7): "bad_host",
        event(host=None): "bad_host",
        event(metadata={"a": "b"}): None,
        event(metadata={}): None,
        event(metadata=None): None,
        event(metadata={"a": 1}): "bad_metadata",
        event(metadata={"a": None}): "bad_metadata",
        event(metadata=[1]): "bad_metadata",
        event(metadata="x"): "bad_metadata",
        event(timestamp="junk"): "bad_timestamp",
        event(timestamp=None): "bad_timestamp",
        event(timestamp=1773741600): "bad_timestamp",
        event(extra={"deep": [1, 2]}): None,
    }
    assert reasons(spark, cases) == cases


def test_enriched_row(spark):
    line = event(timestamp="2026-03-17T01:00:00+05:30", severity="warning", metadata={"k": "v"})
    df = spark.createDataFrame([("f.log", 7, line), ("f.log", 90, event())], "file string, off long, line string")
    first, second = ingest.accepted(ingest.ingest_lines(df)).orderBy("timestamp").collect()
    assert first["timestamp"] == dt.datetime(2026, 3, 16, 19, 30)
    assert first["log_date"] == dt.date(2026, 3, 16)
    assert first["severity"] == "WARNING"
    assert first["metadata"] == {"k": "v"}
    assert (second["host"], second["metadata"]) == ("unknown", {})
    assert first["log_uuid"] != second["log_uuid"]
    again = ingest.accepted(ingest.ingest_lines(df)).orderBy("timestamp").collect()
    assert [r["log_uuid"] for r in again] == [first["log_uuid"], second["log_uuid"]]


def test_absent_timestamp_becomes_as_of(spark):
    now = dt.datetime(2026, 3, 17, 12)
    df = spark.createDataFrame([("s", "INFO", "m")], "service string, severity string, message string")
    row = ingest.validate(ingest.normalize_ts(df, now)).first()
    assert (row["timestamp"], row["reason"]) == (now, None)
    row = ingest.validate(ingest.normalize_ts(df)).first()
    assert row["reason"] == "bad_timestamp"


def test_rows_in_equal_rows_out(spark):
    lines = [event(), "NOT_JSON", event(severity="x"), event(message=...), event()]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    events = ingest.ingest_lines(df)
    assert ingest.accepted(events).count() + ingest.rejected(events).count() == len(lines)
    counts = {(r["status"], r["reason"]): r["n_rows"] for r in ingest.accounting(events).collect()}
    assert counts == {
        ("accepted", ""): 2,
        ("rejected", "not_json"): 1,
        ("rejected", "bad_severity"): 1,
        ("rejected", "missing_key"): 1,
    }


def test_batches_of_consecutive_lines(spark):
    rows = [(f, off * 37) for f, n in (("hot", 950), ("cold", 120)) for off in range(n)]
    df = spark.createDataFrame(rows, "file string, off long").repartition(5)
    numbered = ingest.number_batches(df, size=100, chunk_bytes=1000)
    expected = sorted((f, off, off // 37 // 100) for f, off in rows)
    assert sorted(tuple(r) for r in numbered.select("file", "off", "batch_no").collect()) == expected


def test_gate_fails_whole_batches(spark):
    rows = [(1, None), (1, None), (2, None), (2, "bad_host"), (3, "bad_host")]
    df = spark.createDataFrame(rows, "batch int, reason string")
    got = ingest.batch_gate(df, "batch").groupBy("batch").agg(F.collect_set("batch_ok").alias("ok"))
    assert {r["batch"]: r["ok"] for r in got.collect()} == {1: [True], 2: [False], 3: [False]}


def test_request_bodies(spark):
    good, later = event(), event(timestamp="2026-03-17T11:00:00Z")
    bodies = {
        good: [None],
        f"[{good}]": [None],
        f" [{good}, {later}] ": [None, None],
        f"[{good},{event(severity='loud')}]": [None, "bad_severity"],
        "[]": ["empty_request"],
        "": ["empty_request"],
        None: ["empty_request"],
        "junk": ["not_json"],
        f"[{good}] x": ["not_json"],
        f"[{good}": ["not_json"],
        "[1]": ["missing_key"],
        f"[[{good}]]": ["missing_key"],
        event(message=...): ["missing_key"],
    }
    df = spark.createDataFrame(list(enumerate(bodies)), "request int, body string")
    rows = ingest.ingest_requests(df, dt.datetime(2026, 4, 1)).collect()
    for number, (body, reasons_) in enumerate(bodies.items()):
        mine = sorted((r for r in rows if r["request"] == number), key=lambda r: r["off"] or 0)
        assert [r["reason"] for r in mine] == reasons_, body
        assert {r["batch_ok"] for r in mine} == {reasons_ == [None] * len(reasons_)}, body


def test_requests_may_leave_out_the_timestamp(spark):
    as_of = dt.datetime(2026, 4, 1)
    bodies = [event(timestamp=...), event(timestamp=None), event(timestamp="soon"), event(timestamp=5), event()]
    df = spark.createDataFrame([(0, f"[{','.join(bodies)}]")], "request int, body string")
    rows = sorted(ingest.ingest_requests(df, as_of).collect(), key=lambda r: r["off"])
    assert [r["reason"] for r in rows] == [None, None, "bad_timestamp", "bad_timestamp", None]
    assert [r["timestamp"] for r in rows if r["reason"] is None] == [as_of, as_of, dt.datetime(2026, 3, 17, 10)]
    assert len({r["log_uuid"] for r in rows}) == 5


def test_text_behind_the_object_is_refused(spark):
    good = event()
    for tail in ("]", "] junk", '] {"x":1', '],"1"', "]]", "}", ",1"):
        assert reasons(spark, [good + tail], ingest.parse_lines) == {good + tail: "not_json"}


def test_gate_and_numbering_with_null_keys(spark):
    rows = [(None, None), (None, "bad"), (1, None), (2, "bad"), (2, None)]
    events = spark.createDataFrame(rows, "batch int, reason string")
    got = {(r["batch"], r["reason"]): r["batch_ok"] for r in ingest.batch_gate(events, "batch").collect()}
    assert got == {(None, None): False, (None, "bad"): False, (1, None): True, (2, "bad"): False, (2, None): False}
    with pytest.raises(ValueError, match="file and off"):
        ingest.number_batches(spark.createDataFrame([("x",)], "line string"))
    lines = spark.createDataFrame([("f", None, "x")], "file string, off long, line string")
    with pytest.raises(Exception, match="without an offset"):
        ingest.number_batches(lines).collect()
    nameless = spark.createDataFrame([(None, 100 * i, "x") for i in range(150)], "file string, off long, line string")
    assert ingest.number_batches(nameless).groupBy("batch_no").count().count() == 2


def test_bodies_of_white_space_alone_are_empty_requests(spark):
    bodies = ["\n", "\t\t", " \r\n \n", "\x0b\x0c", " "]
    df = spark.createDataFrame(list(enumerate(bodies)), "request int, body string")
    rows = ingest.ingest_requests(df, dt.datetime(2026, 4, 1)).collect()
    assert sorted((r["request"], r["reason"]) for r in rows) == [(k, "empty_request") for k in range(len(bodies))]

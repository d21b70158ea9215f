import datetime as dt
import json
import glob
import os

import pytest
from logbrook.operators import ingest, rollup, search
from logbrook.sources import tables as t
from logbrook.sources.lines import read_lines
from logbrook.streaming import jobs

T0 = dt.datetime(2026, 3, 17, 10)


def wire(i, minutes, **changes):
    ts = (T0 + dt.timedelta(minutes=minutes)).isoformat() + "Z"
    severity = ("DEBUG", "INFO", "warn", "WARNING", "ERROR")[i % 5]
    return json.dumps(
        {"timestamp": ts, "service": f"s{i % 2}", "severity": severity, "message": f"m{i}", **changes}
    )


def append(path, *lines, end="\n"):
    with open(path, "a") as f:
        f.write("\n".join(lines) + end)


def rows_of(df):
    return sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())


@pytest.fixture
def env(spark, tmp_path):
    class Env:
        folder = tmp_path / "in"
        tables = t.LogTables(str(tmp_path / "tables"))
        checkpoint = str(tmp_path / "checkpoint")

        def run(self, **options):
            query = jobs.ingest_folder(
                spark, str(self.folder), self.tables, self.checkpoint, "run-1", once=True, **options
            )
            query.awaitTermination()
            return query.lastProgress

        def logs(self):
            return t.read_logs(spark, self.tables.logs)

        def rollup(self):
            return t.read_rollup(spark, self.tables)

    Env.folder.mkdir()
    return Env()


def test_stream_equals_batch_with_late_events(spark, env):
    log = env.folder / "a.log"
    append(log, *[wire(i, i) for i in range(50)], "NOT_JSON")
    env.run()
    # Two days late, and lines after a restart; the last one is not finished yet.
    append(log, *[wire(i, i - 2880) for i in range(20)], wire(1, 0, severity="bad"))
    append(log, wire(7, 7)[:20], end="")
    env.run()
    append(log, wire(7, 7)[20:])
    progress = env.run()
    assert progress["observedMetrics"]["ingest"].asDict() == {"n_rows": 1, "accepted": 1, "rejected": 0}

    whole = ingest.ingest_lines(read_lines(spark, str(env.folder), offsets=True))
    good = ingest.accepted(whole)
    assert good.count() == 71
    assert rows_of(env.logs().select("log_uuid", "timestamp", "service_name", "severity")) == rows_of(
        good.select("log_uuid", "timestamp", "service_name", "severity")
    )
    assert rows_of(env.rollup()) == rows_of(rollup.hourly_rollup(good))
    registry = t.read_registry(spark, env.tables)
    assert rows_of(registry) == rows_of(rollup.service_registry(good))
    rejects = t.read_rejects(spark, env.tables).select("file", "off", "line", "reason")
    assert rows_of(rejects) == rows_of(ingest.rejected(whole))


def test_crash_before_the_commit_repeats_the_batch_once(spark, env):
    log = env.folder / "a.log"
    append(log, *[wire(i, i) for i in range(30)])
    env.run()
    append(log, *[wire(i, i + 60) for i in range(30)])
    env.run()
    before = rows_of(env.logs()), rows_of(env.rollup())
    # As after a crash: both batches are planned, the second was never committed.
    commits = os.path.join(env.checkpoint, "commits")
    newest = max(f for f in os.listdir(commits) if f.isdigit())
    os.remove(os.path.join(commits, newest))
    crc = os.path.join(commits, f".{newest}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    env.run()
    assert (rows_of(env.logs()), rows_of(env.rollup())) == before
    append(log, wire(1, 200))
    env.run()
    assert env.logs().count() == 61


def test_crash_between_the_writes(spark, env, monkeypatch):
    append(env.folder / "a.log", *[wire(i, i) for i in range(30)])

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(t, "stage", fail)
        with pytest.raises(Exception, match="lost"):
            env.run()
    # The log rows were written, but a reader sees a batch whole or not at all.
    assert glob.glob(os.path.join(env.tables.logs, "**", "*.parquet"), recursive=True)
    assert env.logs().count() == 0 and env.rollup().count() == 0
    env.run()
    assert env.logs().count() == 30
    assert rows_of(env.rollup()) == rows_of(rollup.hourly_rollup(env.logs()))


def test_a_large_day_is_cut_into_several_files(spark, env):
    """In a stream, too, no task sorts more of a day than the size at which rebalancing cuts."""
    for part in range(6):
        append(env.folder / f"{part}.log", *[wire(part * 300 + i, i % 60) for i in range(300)])
    # A stream works in a copy of the session as it is when the stream begins.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8kb")
    try:
        env.run()
        t.write_logs(env.logs().drop("ingest_id"), env.tables.path("again"), "r/0")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    for table in ("logs", "again"):
        found = glob.glob(f"{env.tables.path(table)}/*/*/log_date=2026-03-17/*.parquet")
        assert len(found) > 2
        assert t.read_logs(spark, env.tables.path(table)).count() == 1800


def test_capped_ingest(spark, env):
    append(env.folder / "a.log", *[wire(i, i) for i in range(200)])
    query = jobs.ingest_folder(
        spark, str(env.folder), env.tables, env.checkpoint, "run-1", max_bytes=8000, interval="0 seconds"
    )
    query.processAllAvailable()
    query.stop()
    assert env.logs().count() == 200
    assert env.logs().select("ingest_id").distinct().count() >= 2
    assert rows_of(env.rollup()) == rows_of(rollup.hourly_rollup(env.logs()))


def test_catch_up_after_a_crash_and_under_a_cap(spark, env, monkeypatch):
    log = env.folder / "a.log"
    append(log, *[wire(i, i) for i in range(40)])

    def start():
        return jobs.ingest_folder(
            spark, str(env.folder), env.tables, env.checkpoint, "run-1", once=True, max_bytes=4000
        )

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(t, "stage", fail)
        with pytest.raises(Exception, match="lost"):
            start().awaitTermination()
    append(log, *[wire(i, i) for i in range(40, 60)])
    assert jobs.catch_up(start) >= 2
    assert env.logs().count() == 60
    assert rows_of(env.rollup()) == rows_of(rollup.hourly_rollup(env.logs()))
    assert jobs.catch_up(start) == 0


@pytest.fixture
def log_stream(spark, tmp_path):
    """A stream of log rows, fed one Parquet file at a time."""
    path = str(tmp_path / "log_files")
    os.makedirs(path)
    schema = "service_name string, log_date date, timestamp timestamp_ntz, log_uuid string, severity string, message string, host string"

    def feed(rows):
        df = spark.createDataFrame(
            [(s, ts.date(), ts, i, sev, "m", "h") for s, ts, i, sev in rows], schema
        )
        df.coalesce(1).write.mode("append").parquet(path)

    feed.stream = spark.readStream.schema(schema).parquet(path)
    return feed


def run_to_end(stream, path, checkpoint, mode="append"):
    query = (
        stream.writeStream.format("parquet").outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )
    query.awaitTermination()


def test_live_page_is_the_newest_rows(spark, tmp_path, log_stream):
    page, checkpoint = str(tmp_path / "page"), str(tmp_path / "checkpoint")
    assert jobs.read_live_page(spark, page) is None
    fed = []
    for batch in range(4):
        # The third batch is older than all rows before it.
        day = -3 if batch == 2 else batch
        rows = [
            ("a" if i % 3 else "b", T0 + dt.timedelta(days=day, minutes=i), f"{batch}-{i:02d}", "INFO")
            for i in range(12)
        ]
        log_stream(rows)
        fed += [r for r in rows if r[0] == "a"]
        jobs.live_page(
            log_stream.stream, page, checkpoint, limit=10, once=True, service="a"
        ).awaitTermination()
        expected = [r[2] for r in sorted(fed, key=lambda r: r[1], reverse=True)[:10]]
        assert [r["log_uuid"] for r in jobs.read_live_page(spark, page).collect()] == expected


def test_live_page_limit_is_checked(log_stream, tmp_path):
    with pytest.raises(ValueError):
        jobs.live_page(log_stream.stream, str(tmp_path / "p"), str(tmp_path / "c"), limit=501)


def test_windowed_counts_drop_what_is_too_late(spark, tmp_path, log_stream):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    counts = jobs.windowed_counts(log_stream.stream, "1 hour")

    def at(hours):
        return T0 + dt.timedelta(hours=hours)

    log_stream([("a", at(0), "1", "ERROR"), ("a", at(0.5), "2", "WARNING"), ("a", at(3), "3", "INFO")])
    run_to_end(counts, out, checkpoint)
    log_stream([("a", at(0.2), "4", "ERROR"), ("a", at(9), "5", "INFO")])  # the first is too late
    run_to_end(counts, out, checkpoint)
    got = spark.read.schema(counts.schema).parquet(out)
    rows = {r["hour_bucket"]: (r["error_count"], r["warn_count"], r["info_count"]) for r in got.collect()}
    assert rows == {at(0): (1, 1, 0), at(3): (0, 0, 1)}


def test_deduplicated_stream(spark, tmp_path, log_stream):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    unique = jobs.deduplicated(log_stream.stream, "1 hour")
    log_stream([("a", T0, "1", "INFO"), ("a", T0, "1", "INFO"), ("a", T0, "2", "INFO")])
    run_to_end(unique, out, checkpoint)
    log_stream([("a", T0, "2", "INFO"), ("a", T0, "3", "INFO")])
    run_to_end(unique, out, checkpoint)
    stored = spark.read.schema(unique.schema).parquet(out)
    assert sorted(r["log_uuid"] for r in stored.collect()) == ["1", "2", "3"]
    assert stored.count() == search.dedup(stored).count()

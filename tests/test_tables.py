import csv
import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from logbrook.operators import rollup
from logbrook.plans.events_view import log_view
from logbrook.sources import commits as c, tables as t
from logbrook.streaming import sink

T0 = dt.datetime(2026, 3, 17, 10)


@pytest.fixture
def tables(tmp_path):
    return t.LogTables(str(tmp_path / "tables"))


def wire(i, **changes):
    import json

    return json.dumps(
        {"timestamp": f"2026-03-{17 + i % 2}T10:{i % 60:02d}:00Z", "service": f"s{i % 3}",
         "severity": "ERROR" if i % 4 == 0 else "INFO", "message": f"m{i}", **changes}
    )


def lines_df(spark, lines):
    return spark.createDataFrame(
        [("f.log", 100 * i, line) for i, line in enumerate(lines)], "file string, off long, line string"
    )


def lost(*args, **kwargs):
    raise RuntimeError("lost")


def rows_of(df):
    return sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())


def test_nothing_written_yet(spark, tables):
    assert t.read_logs(spark, tables.logs).count() == 0
    assert t.read_rollup(spark, tables).count() == 0
    assert t.read_registry(spark, tables).count() == 0
    assert t.read_rejects(spark, tables).count() == 0
    assert t.fold_rollup(spark, tables) is None


def test_numeric_service_stays_text(spark, tables):
    sink.load_lines(lines_df(spark, [wire(0, service="007")]), tables, "r")
    assert t.read_logs(spark, tables.logs).first()["service_name"] == "007"


def test_loading_again_adds_nothing(spark, tables):
    lines = lines_df(spark, [wire(i) for i in range(40)] + ["junk"])
    sink.load_lines(lines, tables, "r")
    logs, hours = rows_of(t.read_logs(spark, tables.logs)), rows_of(t.read_rollup(spark, tables))
    sink.load_lines(lines, tables, "r")
    assert rows_of(t.read_logs(spark, tables.logs)) == logs and len(logs) == 40
    assert rows_of(t.read_rollup(spark, tables)) == hours
    assert t.read_rejects(spark, tables).count() == 1


def test_interrupted_batch_is_completed(spark, tables):
    from logbrook.operators import ingest

    lines = lines_df(spark, [wire(i) for i in range(40)])
    events = ingest.ingest_lines(lines)
    # A first try that wrote only some of the log rows and nothing else.
    t.write_logs(ingest.accepted(events).filter("severity = 'ERROR'"), tables.logs, "r/5")
    sink.store_batch(events, tables, "r", 5)
    assert t.read_logs(spark, tables.logs).count() == 40
    assert rows_of(t.read_rollup(spark, tables)) == rows_of(
        rollup.hourly_rollup(ingest.accepted(events))
    )


def test_interrupted_load_of_equal_lines_is_completed(spark, tables):
    from logbrook.operators import ingest

    lines = lines_df(spark, [wire(i) for i in (0, 1, 1, 1, 2)])
    events = ingest.ingest_lines(lines)
    first = ingest.accepted(events).filter("message = 'm1'").limit(1)
    t.write_logs(first, tables.logs, "r/0")
    for _ in range(2):
        sink.load_lines(lines, tables, "r")
        got = t.read_logs(spark, tables.logs).groupBy("message").count().collect()
        assert {r["message"]: r["count"] for r in got} == {"m0": 1, "m1": 3, "m2": 1}


def test_staged_load_equals_cached_batch(spark, tmp_path):
    from logbrook.operators import ingest

    lines = lines_df(spark, [wire(i) for i in range(30)] + ["junk"])
    a, b = (t.LogTables(str(tmp_path / n)) for n in "ab")
    sink.store_batch(ingest.ingest_lines(lines), a, "r", 0)
    sink.load_lines(lines, b, "r", staging=str(tmp_path / "staging"))
    assert rows_of(t.read_logs(spark, a.logs)) == rows_of(t.read_logs(spark, b.logs))
    assert rows_of(t.read_rejects(spark, a)) == rows_of(t.read_rejects(spark, b))


def test_folds(spark, tables, sf_dir):
    logs = log_view(spark, sf_dir)
    parts = [logs.filter(F.dayofmonth("timestamp") % 4 == i) for i in range(4)]
    expected = rows_of(rollup.hourly_rollup(logs))
    registry = rows_of(rollup.service_registry(logs))
    for i in (0, 1):
        t.write_rollup(parts[i], tables.hourly, "a", i)
    assert t.fold_rollup(spark, tables) == 1
    assert t.fold_rollup(spark, tables) == 1  # nothing new to fold
    t.write_rollup(parts[1], tables.hourly, "a", 1)  # repeated after it was folded
    t.write_rollup(parts[2], tables.hourly, "a", 2)
    t.write_rollup(parts[3], tables.hourly, "b", 0)  # another run starts at batch 0
    assert rows_of(t.read_rollup(spark, tables)) == expected
    assert t.fold_rollup(spark, tables) == 2
    assert rows_of(t.read_rollup(spark, tables)) == expected
    assert rows_of(t.read_registry(spark, tables)) == registry


def test_unfinished_fold_is_not_read(spark, tables, sf_dir, monkeypatch):
    logs = log_view(spark, sf_dir)
    t.write_rollup(logs, tables.hourly, "a", 0)
    before = rows_of(t.read_rollup(spark, tables))
    with monkeypatch.context() as m:
        # The sums are written, the commit is not.
        m.setattr(c, "commit", lost)
        with pytest.raises(RuntimeError, match="lost"):
            t.fold_rollup(spark, tables)
    assert files_below(tables.path("folds"))
    assert rows_of(t.read_rollup(spark, tables)) == before
    assert t.fold_rollup(spark, tables) == 1
    assert rows_of(t.read_rollup(spark, tables)) == before


def test_replay(spark, tables):
    lines = [wire(0), wire(1) + " cut", "junk", wire(2, severity="bad")]
    sink.load_lines(lines_df(spark, lines), tables, "load")
    assert t.read_rejects(spark, tables).count() == 3

    def repair(df):
        return df.withColumn("line", F.regexp_replace("line", " cut$", ""))

    for _ in range(2):  # the second time changes nothing
        sink.replay_rejects(spark, tables, "one", repair)
        assert t.read_logs(spark, tables.logs).count() == 2
        assert t.read_rollup(spark, tables).agg(F.sum("error_count") + F.sum("info_count")).first()[0] == 2
        assert sorted(r["reason"] for r in t.read_rejects(spark, tables).collect()) == [
            "bad_severity",
            "not_json",
        ]
    sink.replay_rejects(spark, tables, "two")  # without the repair nothing more passes
    assert t.read_logs(spark, tables.logs).count() == 2
    assert t.read_rejects(spark, tables).count() == 2


def files_below(path):
    return glob.glob(os.path.join(path, "**", "*.parquet"), recursive=True)


def ingest_of(spark, lines):
    from logbrook.operators import ingest

    return ingest.ingest_lines(lines_df(spark, lines))


def test_compaction_keeps_rows_and_covers_the_batches(spark, tables):
    for batch in range(6):
        lines = lines_df(spark, [wire(100 * batch + i) for i in range(60)])
        sink.load_lines(lines, tables, f"r{batch}")
    day, other = dt.date(2026, 3, 17), dt.date(2026, 3, 18)
    logs = t.read_logs(spark, tables.logs).drop("ingest_id")
    before = rows_of(logs)
    assert t.compact_day(spark, tables.logs, day) == 180
    after = t.read_logs(spark, tables.logs)
    assert rows_of(after.drop("ingest_id")) == before
    used = {(r["log_date"], r["ingest_id"]) for r in after.select("log_date", "ingest_id").distinct().collect()}
    assert sum(d == day for d, _ in used) == 1 and sum(d == other for d, _ in used) == 6
    assert t.compact_day(spark, tables.logs, dt.date(2026, 3, 19)) == 0  # a day without rows


def test_rows_that_arrive_during_a_compaction_stay(spark, tables):
    day = dt.date(2026, 3, 17)
    sink.load_lines(lines_df(spark, [wire(i) for i in range(60)]), tables, "r0")
    generation = t.begin_compaction(spark, tables.logs, day)
    sink.load_lines(lines_df(spark, [wire(100 + i) for i in range(10)]), tables, "r1")
    assert t.read_logs(spark, tables.logs).count() == 70
    assert t.finish_compaction(spark, tables.logs, generation) == 30
    assert t.read_logs(spark, tables.logs).count() == 70
    assert rows_of(t.read_rollup(spark, tables)) == rows_of(rollup.hourly_rollup(t.read_logs(spark, tables.logs)))


def test_unfinished_compaction_is_not_read(spark, tables, monkeypatch):
    sink.load_lines(lines_df(spark, [wire(i) for i in range(20)]), tables, "r0")
    with monkeypatch.context() as m:
        m.setattr(c, "commit", lost)
        with pytest.raises(RuntimeError, match="lost"):
            t.compact_day(spark, tables.logs, dt.date(2026, 3, 17))
    with monkeypatch.context() as m:
        # A copy of other than the covered rows is refused.
        m.setattr(t, "_write_days", lambda rows, folder: rows.limit(3).write.partitionBy("log_date").parquet(folder))
        with pytest.raises(RuntimeError, match="incomplete"):
            t.compact_day(spark, tables.logs, dt.date(2026, 3, 17))
    assert t.read_logs(spark, tables.logs).count() == 20


def test_retry_without_rows_replaces_the_first_try(spark, tables):
    events = ingest_of(spark, ["junk", wire(1)])
    sink.store_batch(events, tables, "r:1", 0)
    assert (t.read_logs(spark, tables.logs).count(), t.read_rejects(spark, tables).count()) == (1, 1)
    sink.store_batch(events.limit(0), tables, "r:1", 0)
    assert (t.read_logs(spark, tables.logs).count(), t.read_rejects(spark, tables).count()) == (0, 0)
    assert t.read_rollup(spark, tables).count() == 0


def test_equal_rejects_of_a_later_load_are_pending(spark, tables):
    sink.load_lines(lines_df(spark, ["junk", wire(1) + " trailing"]), tables, "a")

    def cut(rejects):
        return rejects.withColumn("line", F.regexp_replace("line", " trailing$", ""))

    sink.replay_rejects(spark, tables, "first", cut)
    assert t.read_rejects(spark, tables).count() == 1
    sink.load_lines(lines_df(spark, ["junk", wire(1) + " trailing"]), tables, "b")
    assert t.read_rejects(spark, tables).count() == 3
    sink.replay_rejects(spark, tables, "second", cut)
    assert (t.read_rejects(spark, tables).count(), t.read_logs(spark, tables.logs).count()) == (2, 2)


def test_lines_without_offsets_are_not_stored(spark, tables):
    with pytest.raises(ValueError, match="file and off"):
        sink.load_lines(spark.createDataFrame([(wire(1),)], "line string"), tables, "r")


def test_hot_service_is_split_over_files(spark, tables):
    logs = spark.range(0, 60_000, 1, 8).select(
        F.lit("hot").alias("service_name"),
        F.lit(T0).cast("timestamp_ntz").alias("timestamp"),
        F.lit(T0.date()).alias("log_date"),
        F.md5(F.col("id").cast("string")).alias("log_uuid"),
        F.lit("INFO").alias("severity"),
        F.sha2(F.col("id").cast("string"), 512).alias("message"),
        F.lit("h").alias("host"),
        F.create_map().cast("map<string,string>").alias("metadata"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1MB")
    try:
        t.write_logs(logs, tables.logs)
    finally:
        spark.conf.unset(key)
    assert len(files_below(tables.logs)) > 1
    assert t.read_logs(spark, tables.logs).count() == 60_000


def test_saved_queries_are_kept(spark, tables):
    from logbrook import schema as S

    assert t.read_saved_queries(spark, tables).count() == 0
    rows = [(1, "a", "{}", "cli", T0), (2, "b", "{}", "cli", T0)]
    for row in rows:
        t.save_queries(spark.createDataFrame([row], S.SAVED_QUERIES_SCHEMA), tables)
    assert sorted(tuple(r) for r in t.read_saved_queries(spark, tables).collect()) == rows


def test_host_layout(spark, tables, sf_dir):
    logs = log_view(spark, sf_dir)
    no_host = logs.limit(3).withColumn("host", F.lit(None).cast("string"))
    t.write_logs_by_host(logs.unionByName(no_host), tables.by_host)
    stored = t.read_logs_by_host(spark, tables.by_host)
    assert stored.count() == logs.count()
    assert stored.filter("host = 'host-3'").count() == logs.filter("host = 'host-3'").count()


def test_csv(spark, tmp_path):
    rows = [
        ("s", T0, "INFO", 'He said "no", twice', "h"),
        ("s", T0, "INFO", " padded ", None),
        ("s", T0, "INFO", "two\nlines", "h"),
        ("s", T0, "INFO", "back\\slash", "h"),
    ]
    df = spark.createDataFrame(
        rows, "service_name string, timestamp timestamp_ntz, severity string, message string, host string"
    )
    out = str(tmp_path / "csv")
    t.export_csv(df.coalesce(1), out)
    (part,) = glob.glob(out + "/*.csv")
    with open(part, newline="") as f:
        read = list(csv.reader(f))
    assert read[0] == ["timestamp", "service", "severity", "message", "host"]
    assert sorted(r[3] for r in read[1:]) == sorted(r[3] for r in rows)
    assert {r[4] for r in read[1:] if r[3] == " padded "} == {""}
    assert read[1][0] == "2026-03-17T10:00:00.000000"
    assert 'He said ""no"", twice' in open(part).read()


def test_host_layout_is_kept_with_the_batch(spark, tables):
    for _ in range(2):
        sink.load_lines(lines_df(spark, [wire(i, host=f"h{i % 2}") for i in range(20)]), tables, "r", by_host=True)
    assert rows_of(t.read_logs_by_host(spark, tables.by_host)) == rows_of(t.read_logs(spark, tables.logs).drop("ingest_id"))

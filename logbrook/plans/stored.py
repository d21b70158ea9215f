"""Registered queries that write tables or run a stream, and read the result back.

Each run writes below a new folder of the cluster's shared storage (``work_dir``).
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from logbrook import schema as S
from logbrook.operators import analytics, ingest, saved, search
from logbrook.plans import events_view as view
from logbrook.plans.batch import (
    _DAMAGED,
    _LOGS,
    _NEWEST,
    _ROW,
    register,
    shown,
    with_logs,
    with_registry,
    with_rollup,
)
from logbrook.session import work_dir
from logbrook.sources import files, retention, tables as t
from logbrook.sources.lines import read_lines
from logbrook.streaming import jobs
from logbrook.streaming.sink import load_lines, replay_rejects


def _stored_logs(spark: SparkSession, sf_dir: str, label: str) -> t.LogTables:
    tables = t.LogTables(work_dir(spark, label))
    t.write_logs(view.log_view(spark, sf_dir), tables.logs, "load/0")
    return tables


def _day_files(spark: SparkSession, sf_dir: str, label: str) -> t.LogTables:
    """Tables with several batches of a few days each, one of the days compacted into files by time."""
    tables = t.LogTables(work_dir(spark, label))
    logs = view.log_view(spark, sf_dir)
    for part in range(3):
        t.write_logs(logs.filter(F.dayofmonth("timestamp") % 3 == part), tables.logs, f"load-{part}/0")
    t.compact_day(spark, tables.logs, dt.date(2024, 1, 30), partitions=8)
    return tables


def _streamed(spark: SparkSession, sf_dir: str, label: str) -> t.LogTables:
    """Tables after a stream of the events, as log lines, was stored."""
    base = work_dir(spark, label)
    tables = t.LogTables(f"{base}/tables")
    numbered = view.lines_of(view.event_stream(spark, sf_dir))
    lines = numbered.select(F.lit("events").alias("file"), F.col("event_id").alias("off"), "line")
    jobs.ingest_stream(lines, tables, f"{base}/checkpoint", "run-1", once=True).awaitTermination()
    return tables


def _tailed(spark: SparkSession, sf_dir: str, label: str) -> t.LogTables:
    """Tables after log files written from the events were followed to their end."""
    base = work_dir(spark, label)
    tables = t.LogTables(f"{base}/tables")
    lines = view.lines_of(view.table(spark, sf_dir, "events"))
    lines.select("line").write.text(f"{base}/files")
    query = jobs.ingest_folder(
        spark, f"{base}/files", tables, f"{base}/checkpoint", "run-1", pattern="part-*", once=True
    )
    query.awaitTermination()
    return tables


_STORED_ROW = 'service_name, log_date, "timestamp", severity, message, host'


@register("tail_ingest", with_logs(f"SELECT {_STORED_ROW} FROM logs"))
def _tail_ingest(spark, sf_dir):
    logs = t.read_logs(spark, _tailed(spark, sf_dir, "tail-ingest").logs)
    return logs.select("service_name", "log_date", "timestamp", "severity", "message", "host")


@register("tail_rollup", with_rollup("SELECT * FROM rollup"))
def _tail_rollup(spark, sf_dir):
    return t.read_rollup(spark, _tailed(spark, sf_dir, "tail-rollup"))


@register(
    "read_lines_once",
    with_logs("SELECT severity, count(*) AS n_rows FROM logs GROUP BY severity"),
)
def _read_lines_once(spark, sf_dir):
    base = work_dir(spark, "read-lines")
    tables = t.LogTables(f"{base}/tables")
    view.lines_of(view.table(spark, sf_dir, "events")).select("line").write.text(f"{base}/files")
    lines = read_lines(spark, f"{base}/files", pattern="part-*")
    load_lines(lines, tables, "load")
    logs = t.read_logs(spark, tables.logs)
    return logs.groupBy("severity").agg(F.count("*").alias("n_rows"))


@register("stream_rollup", with_rollup("SELECT * FROM rollup"))
def _stream_rollup(spark, sf_dir):
    return t.read_rollup(spark, _streamed(spark, sf_dir, "stream-rollup"))


@register("stream_registry", with_registry("SELECT * FROM registry"))
def _stream_registry(spark, sf_dir):
    tables = _streamed(spark, sf_dir, "stream-registry")
    return analytics.services(t.read_registry(spark, tables))


@register(
    "stream_windowed",
    with_rollup("SELECT service_name, hour_bucket, error_count, warn_count, info_count, debug_count FROM rollup"),
)
def _stream_windowed(spark, sf_dir):
    base = work_dir(spark, "stream-windowed")
    counts = jobs.windowed_counts(view.logs_of(view.event_stream(spark, sf_dir)), "1 hour")
    jobs.keep_windowed(counts, f"{base}/hours", f"{base}/checkpoint", once=True).awaitTermination()
    return jobs.read_windowed(spark, f"{base}/hours")


@register(
    "live_tail",
    with_logs(
        f"""SELECT {_ROW} FROM logs WHERE service_name = 'auth-service'
        AND severity IN ('ERROR', 'WARN', 'WARNING') {_NEWEST} LIMIT 50"""
    ),
)
def _live_tail(spark, sf_dir):
    base = work_dir(spark, "live-tail")
    logs = view.logs_of(view.event_stream(spark, sf_dir))
    jobs.live_page(
        logs, f"{base}/page", f"{base}/checkpoint", once=True,
        service="auth-service", severity=["ERROR", "WARN"], fold_warning=True,
    ).awaitTermination()
    return shown(jobs.read_live_page(spark, f"{base}/page"))


@register(
    "stored_search",
    with_logs(
        f"""SELECT {_ROW} FROM logs WHERE service_name = 'auth-service' AND severity = 'INFO'
        AND "timestamp" BETWEEN TIMESTAMP '2024-01-10 06:30:00' AND TIMESTAMP '2024-01-14 18:15:00'
        {_NEWEST} LIMIT 100"""
    ),
)
def _stored_search(spark, sf_dir):
    logs = t.read_logs(spark, _stored_logs(spark, sf_dir, "stored-search").logs)
    return shown(
        search.search(
            logs,
            "auth-service",
            limit=100,
            severity="INFO",
            start=dt.datetime(2024, 1, 10, 6, 30),
            end=dt.datetime(2024, 1, 14, 18, 15),
        )
    )


@register(
    "stored_host_search",
    with_logs(f"SELECT {_ROW} FROM logs WHERE host = 'host-5' {_NEWEST} LIMIT 100"),
)
def _stored_host_search(spark, sf_dir):
    tables = t.LogTables(work_dir(spark, "stored-host"))
    t.write_logs_by_host(view.log_view(spark, sf_dir), tables.by_host)
    return shown(search.search_host(t.read_logs_by_host(spark, tables.by_host), "host-5", 100))


@register("stored_rollup", with_rollup("SELECT * FROM rollup"))
def _stored_rollup(spark, sf_dir):
    """Two batches are stored and folded; a third is stored and the second is repeated."""
    tables = t.LogTables(work_dir(spark, "stored-rollup"))
    logs = view.log_view(spark, sf_dir)
    thirds = [logs.filter(F.dayofmonth("timestamp") % 3 == i) for i in range(3)]
    t.write_rollup(thirds[0], tables.hourly, "run-1", 0)
    t.write_rollup(thirds[1], tables.hourly, "run-1", 1)
    t.fold_rollup(spark, tables)
    t.write_rollup(thirds[2], tables.hourly, "run-1", 2)
    t.write_rollup(thirds[1], tables.hourly, "run-1", 1)
    return t.read_rollup(spark, tables)


@register("two_writers", with_logs('SELECT log_uuid, service_name, log_date, "timestamp" FROM logs'))
def _two_writers(spark, sf_dir):
    """Four batches are written at the same time, one of them twice."""
    tables = t.LogTables(work_dir(spark, "two-writers"))
    logs = view.log_view(spark, sf_dir)

    def write(number: int) -> None:
        t.write_logs(logs.filter(F.col("event_id") % 4 == number), tables.logs, f"writer-{number}/0")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
    write(2)
    return t.read_logs(spark, tables.logs).select("log_uuid", "service_name", "log_date", "timestamp")


@register(
    "compact_while_writing", with_logs('SELECT log_uuid, service_name, log_date, "timestamp" FROM logs')
)
def _compact_while_writing(spark, sf_dir):
    """Half of the rows arrive while two days are compacted; one day is compacted twice."""
    tables = t.LogTables(work_dir(spark, "compact-writing"))
    logs = view.log_view(spark, sf_dir)
    first, late = (logs.filter(F.col("event_id") % 2 == n) for n in range(2))
    t.write_logs(first, tables.logs, "first/0")
    begun = [t.begin_compaction(spark, tables.logs, dt.date(2024, 1, day)) for day in (10, 11)]
    t.write_logs(late, tables.logs, "late/0")
    for generation in begun:
        t.finish_compaction(spark, tables.logs, generation)
    t.compact_day(spark, tables.logs, dt.date(2024, 1, 11))
    t.begin_compaction(spark, tables.logs, dt.date(2024, 1, 12))  # never finished
    return t.read_logs(spark, tables.logs).select("log_uuid", "service_name", "log_date", "timestamp")


def _all_pages(spark: SparkSession, path: str, service: str, size: int) -> DataFrame:
    """Every page up to the last, each written to a folder of its own in shared storage."""
    base = work_dir(spark, "pages")
    pages = files.page_stored(spark, path, service, size, every=True).results
    pages.select("page", "log_uuid", "timestamp").write.partitionBy("page").parquet(base)
    stored = spark.read.schema("log_uuid string, timestamp timestamp_ntz, page bigint").parquet(base)
    return stored.select("log_uuid", "timestamp")


@register(
    "pages_equal_lines",
    with_logs(
        """SELECT md5(concat('f', chr(1), CAST(event_id AS VARCHAR), chr(1), 'equal')) AS log_uuid,
        CAST(log_date AS TIMESTAMP) AS "timestamp" FROM logs WHERE service_name = 'auth-service'"""
    ),
)
def _pages_equal_lines(spark, sf_dir):
    """All pages of rows that differ in their offset only, a day's worth at one time."""
    lines = view.log_view(spark, sf_dir).select(
        F.lit("f").alias("file"), F.col("event_id").alias("off"), F.lit("equal").alias("line"),
        F.col("service_name").alias("service"), "severity", F.lit("same").alias("message"), "host",
        F.lit(None).cast("map<string,string>").alias("metadata"),
        F.col("log_date").cast("timestamp_ntz").alias("timestamp"),
    )
    tables = t.LogTables(work_dir(spark, "pages-equal"))
    t.write_logs(ingest.enrich(lines), tables.logs, "load/0")
    return _all_pages(spark, tables.logs, "auth-service", S.SEARCH_MAX_LIMIT)


@register(
    "stored_keyword",
    with_logs(
        f"""SELECT {_ROW} FROM logs WHERE service_name = 'payment-service' AND message LIKE '%user_id=13%'
        {_NEWEST} LIMIT 500"""
    ),
)
def _stored_keyword(spark, sf_dir):
    """Only files whose trigrams may hold the keyword are opened."""
    tables = _day_files(spark, sf_dir, "stored-keyword")
    return shown(files.search_stored(spark, tables.logs, "payment-service", 500, q="USER_ID=13"))


@register(
    "stored_newest",
    with_logs(f"SELECT {_ROW} FROM logs WHERE service_name = 'auth-service' {_NEWEST} LIMIT 50"),
)
def _stored_newest(spark, sf_dir):
    """Without a start in time: files are opened newest first until no other can hold a row of the page."""
    tables = _day_files(spark, sf_dir, "stored-newest")
    return shown(files.page_stored(spark, tables.logs, "auth-service", 50).results)


@register(
    "stored_severity",
    with_logs(
        f"""SELECT {_ROW} FROM logs WHERE service_name = 'report-service' AND severity IN ('WARN', 'WARNING')
        AND "timestamp" <= TIMESTAMP '2024-01-20 12:00:00' {_NEWEST} LIMIT 200"""
    ),
)
def _stored_severity(spark, sf_dir):
    """Files without a row of the wanted severities are not opened."""
    tables = _day_files(spark, sf_dir, "stored-severity")
    found = files.search_stored(
        spark, tables.logs, "report-service", 200, severity="warn", fold_warning=True, end=dt.datetime(2024, 1, 20, 12)
    )
    return shown(found)


@register("retry_after_compaction", with_logs('SELECT log_uuid, service_name, log_date, "timestamp" FROM logs'))
def _retry_after_compaction(spark, sf_dir):
    """A batch that stored some rows only is compacted twice, then stored whole; others arrive late."""
    tables = t.LogTables(work_dir(spark, "retry-compaction"))
    logs = view.log_view(spark, sf_dir)
    first, late = (logs.filter(F.col("event_id") % 2 == n) for n in range(2))
    t.write_logs(first.filter("event_id % 4 = 0"), tables.logs, "first/0")
    t.compact_day(spark, tables.logs, dt.date(2024, 1, 10))
    t.compact_day(spark, tables.logs, dt.date(2024, 1, 10))
    t.write_logs(late, tables.logs, "late/0")
    t.write_logs(first, tables.logs, "first/0")
    t.compact_day(spark, tables.logs, dt.date(2024, 1, 11))
    return t.read_logs(spark, tables.logs).select("log_uuid", "service_name", "log_date", "timestamp")


@register("retry_after_fold", with_rollup("SELECT * FROM rollup"))
def _retry_after_fold(spark, sf_dir):
    """Batches 0 and 2 are folded, batch 2 with some rows only; then batch 1 arrives and batch 2 again."""
    tables = t.LogTables(work_dir(spark, "retry-fold"))
    logs = view.log_view(spark, sf_dir)
    parts = [logs.filter(F.dayofmonth("timestamp") % 3 == i) for i in range(3)]
    t.write_rollup(parts[0], tables.hourly, "run-1", 0)
    t.write_rollup(parts[2].filter("event_id % 2 = 0"), tables.hourly, "run-1", 2)
    t.fold_rollup(spark, tables)
    t.write_rollup(parts[1], tables.hourly, "run-1", 1)
    t.fold_rollup(spark, tables)
    t.write_rollup(parts[2], tables.hourly, "run-1", 2)
    return t.read_rollup(spark, tables)


@register(
    "retained",
    with_logs(
        """SELECT 'rows' AS kind, severity AS name, count(*) AS n FROM logs GROUP BY severity
        UNION ALL SELECT 'counted', service_name, count(*) FROM logs GROUP BY service_name"""
    ),
)
def _retained(spark, sf_dir):
    """Loads, a repeated load, a compaction and folds; then everything that readers cannot reach is removed."""
    tables = t.LogTables(work_dir(spark, "retained"))
    lines = view.lines_of(view.table(spark, sf_dir, "events"))
    lines = lines.select(F.lit("events").alias("file"), F.col("event_id").alias("off"), "line")
    for run in ("a", "b", "a"):
        load_lines(lines.filter((F.col("off") % 2 == 0) == (run == "a")), tables, run)
        t.fold_rollup(spark, tables)
    t.compact_day(spark, tables.logs, dt.date(2024, 1, 10))
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(days=30)
    retention.vacuum(spark, tables, later)
    rows = t.read_logs(spark, tables.logs).groupBy(F.lit("rows").alias("kind"), F.col("severity").alias("name"))
    hours = t.read_rollup(spark, tables).groupBy(F.lit("counted").alias("kind"), F.col("service_name").alias("name"))
    total = sum(F.col(name) for name in S.COUNT_COLUMNS)
    return rows.agg(F.count("*").alias("n")).unionByName(hours.agg(F.sum(total).alias("n")))


@register("compact_day", with_logs('SELECT log_uuid, service_name, log_date, "timestamp" FROM logs'))
def _compact_day(spark, sf_dir):
    tables = _stored_logs(spark, sf_dir, "compact-day")
    t.compact_day(spark, tables.logs, dt.date(2024, 1, 15))
    logs = t.read_logs(spark, tables.logs)
    return logs.select("log_uuid", "service_name", "log_date", "timestamp")


@register(
    "stored_saved_queries",
    with_logs(
        f"""SELECT query_name, {_ROW} FROM (SELECT 'gateway warnings' AS query_name, * FROM logs
          WHERE service_name = 'api-gateway' AND severity = 'WARN' {_NEWEST} LIMIT 20)
        UNION ALL SELECT query_name, {_ROW} FROM (SELECT 'reports' AS query_name, * FROM logs
          WHERE service_name = 'report-service' {_NEWEST} LIMIT 50)"""
    ),
)
def _stored_saved_queries(spark, sf_dir):
    tables = t.LogTables(work_dir(spark, "saved-queries"))
    for row in (
        (1, "gateway warnings", '{"service":"api-gateway","severity":"warn","limit":20}', "cli"),
        (2, "reports", '{"service":"report-service"}', "cli"),
    ):
        new = spark.createDataFrame([(*row, dt.datetime(2024, 1, 31))], S.SAVED_QUERIES_SCHEMA)
        t.save_queries(new, tables)
    logs = view.log_view(spark, sf_dir)
    found = saved.run_saved_queries(logs, t.read_saved_queries(spark, tables))
    return found.select("query_name", *S.LOG_COLUMNS[:-1])


@register(
    "csv_export",
    with_logs('SELECT "timestamp", service_name AS service, severity, message, host FROM logs'),
)
def _csv_export(spark, sf_dir):
    path = work_dir(spark, "csv-export")
    t.export_csv(view.log_view(spark, sf_dir), path)
    fields = "timestamp timestamp_ntz, service string, severity string, message string, host string"
    reader = spark.read.schema(fields).option("header", True).option("escape", '"')
    return reader.option("multiLine", True).csv(path)


@register(
    "quarantine_replay",
    f"""WITH {_LOGS},\n{_DAMAGED}
    SELECT CASE WHEN event_id % 8 = 1 OR reason IS NULL THEN 'stored' ELSE reason END AS state,
      count(*) AS n_rows FROM parsed GROUP BY state""",
)
def _quarantine_replay(spark, sf_dir):
    """Broken lines are set aside; those with trailing text pass once it is cut off."""
    tables = t.LogTables(work_dir(spark, "quarantine"))
    load_lines(view.damaged_lines(spark, sf_dir), tables, "load")

    def cut_trailing_text(rejects: DataFrame) -> DataFrame:
        return rejects.withColumn("line", F.regexp_replace("line", " trailing$", ""))

    replay_rejects(spark, tables, "first", cut_trailing_text)
    stored = t.read_logs(spark, tables.logs).select(F.lit("stored").alias("state"))
    pending = t.read_rejects(spark, tables).select(F.col("reason").alias("state"))
    return stored.unionByName(pending).groupBy("state").agg(F.count("*").alias("n_rows"))

"""Streaming queries: ingest, windowed counts, live page."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from logbrook import schema as S
from logbrook.functions import severity_class
from logbrook.operators import ingest, search
from logbrook.session import read_table
from logbrook.sources.lines import follow_lines
from logbrook.sources.tables import LogTables
from logbrook.streaming.sink import BatchSink, need_offsets

FLUSH_INTERVAL = "5 seconds"


def _trigger(once: bool, interval: str) -> dict:
    return {"availableNow": True} if once else {"processingTime": interval}


def ingest_stream(
    lines: DataFrame,
    tables: LogTables,
    checkpoint: str,
    run_id: str,
    once: bool = False,
    interval: str = FLUSH_INTERVAL,
    as_of: dt.datetime | None = None,
    by_host: bool = False,
) -> StreamingQuery:
    """Start storing a stream of lines (``file, off, line``) into the tables.

    ``once`` takes what is there and ends; otherwise a batch is flushed every
    ``interval``. Events of any age are accepted: they add to the counts of their hour.
    A new checkpoint needs a new ``run_id``. The progress of the query reports how many
    rows were accepted and rejected, as the observed metrics ``ingest``.
    """
    events = ingest.ingest_lines(need_offsets(lines), as_of).observe(
        "ingest",
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("reason").isNull()).alias("accepted"),
        F.count("reason").alias("rejected"),
    )
    return (
        events.writeStream.foreachBatch(BatchSink(tables, run_id, by_host))
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(once, interval))
        .start()
    )


def ingest_folder(
    spark: SparkSession,
    folder: str,
    tables: LogTables,
    checkpoint: str,
    run_id: str,
    pattern: str = "*.log",
    max_bytes: int | None = None,
    **options,
) -> StreamingQuery:
    """Follow the log files of a folder and store their lines."""
    source = {}
    if max_bytes:
        # Kept beside the checkpoint, not in it: that folder belongs to Spark.
        registry = f"{checkpoint.rstrip('/')}-offsets/registry.json"
        source = {"maxBytesPerTrigger": max_bytes, "registry": registry}
    lines = follow_lines(spark, folder, pattern, **source)
    return ingest_stream(lines, tables, checkpoint, run_id, **options)


def catch_up(start: Callable[[], StreamingQuery]) -> int:
    """Run a ``once`` query again and again until it finds nothing new; returns its runs.

    With a Python source such a run is a single micro-batch: after a crash it only repeats
    the interrupted one, and a byte cap is the cap of the run. ``start`` starts one run.
    """
    runs = 0
    while True:
        query = start()
        query.awaitTermination()
        if not any(progress["numInputRows"] for progress in query.recentProgress):
            return runs
        runs += 1


def windowed_counts(logs: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Hourly severity counts as a stateful stream, for callers that want no tables.

    State is one row per service and open hour. Events later than ``lateness`` are
    dropped; the stored partials of ``ingest_stream`` are the way that takes any age.
    """
    kind = severity_class(F.col("severity"))
    counts = [
        F.count_if(kind == cls).alias(name) for name, cls in zip(S.COUNT_COLUMNS, S.SEVERITY_CLASSES)
    ]
    hour = F.col("hour.start").cast("timestamp_ntz").alias("hour_bucket")
    return (
        _watermarked(logs, lateness)
        .groupBy("service_name", F.window("event_time", "1 hour").alias("hour"))
        .agg(*counts)
        .select("service_name", hour, *S.COUNT_COLUMNS)
    )


def keep_windowed(counts: DataFrame, path: str, checkpoint: str, once: bool = False, interval: str = FLUSH_INTERVAL) -> StreamingQuery:
    """Store ``windowed_counts`` as they change, open hours included.

    Every micro-batch writes the hours it changed, with their counts so far, into its own folder;
    ``read_windowed`` takes the newest counts of each hour.
    """

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(once, interval))
        .start()
    )


def read_windowed(spark: SparkSession, path: str) -> DataFrame:
    """Counts of every hour that ``keep_windowed`` has seen."""
    fields = [f for f in S.HOURLY_SCHEMA if f.name in ("service_name", "hour_bucket", *S.COUNT_COLUMNS)]
    rows = spark.read.schema(T.StructType([*fields, T.StructField("batch_id", T.LongType())])).parquet(path)
    newest = F.max(F.struct("batch_id", *S.COUNT_COLUMNS)).alias("newest")
    return rows.groupBy("service_name", "hour_bucket").agg(newest).select("service_name", "hour_bucket", *[f"newest.{c}" for c in S.COUNT_COLUMNS])


def deduplicated(logs: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Stream without repeated ids; an id is remembered for ``lateness`` of event time."""
    unique = _watermarked(logs, lateness).dropDuplicatesWithinWatermark(["log_uuid"])
    return unique.drop("event_time")


def _watermarked(logs: DataFrame, lateness: str) -> DataFrame:
    """A watermark needs a TIMESTAMP. With the session in UTC it is the same wall time."""
    return logs.withColumn("event_time", F.col("timestamp").cast("timestamp")).withWatermark(
        "event_time", lateness
    )


def live_page(
    logs: DataFrame,
    path: str,
    checkpoint: str,
    limit: int = S.SEARCH_DEFAULT_LIMIT,
    once: bool = False,
    interval: str = "10 seconds",
    **filters,
) -> StreamingQuery:
    """Keep the newest rows that fit the filters of ``search.matching`` up to date.

    A batch only has to be merged with the page before it: at most ``limit`` rows. Pages
    take turns in two folders, so the page before is untouched while a batch writes its
    own, and a repeated batch gives the same page.
    """
    limit = search.check_limit(limit)

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = search.result_columns(search.matching(batch, **filters))
        page = _newest_page(batch.sparkSession, path, before=batch_id)
        if page is not None:
            rows = rows.unionByName(page)
        newest = rows.orderBy(*search.newest_first()).limit(limit)
        stamped = newest.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        stamped.coalesce(1).write.mode("overwrite").parquet(f"{path}/slot={batch_id % 2}")

    return (
        logs.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(once, interval))
        .start()
    )


_PAGE_SCHEMA = T.StructType(
    [
        *[f for f in S.LOGS_SCHEMA if f.name != "ingest_id"],
        T.StructField("batch_id", T.LongType()),
        T.StructField("slot", T.IntegerType()),
    ]
)


def _newest_page(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    pages = read_table(spark, path, _PAGE_SCHEMA)
    if pages is None:
        return None
    if before is not None:
        # The slot this batch will write is not read, whatever is in it.
        pages = pages.filter((F.col("slot") != before % 2) & (F.col("batch_id") < before))
    newest = pages.agg(F.max("batch_id")).first()[0]
    if newest is None:
        return None
    return pages.filter(F.col("batch_id") == newest).select(*S.LOG_COLUMNS)


def read_live_page(spark: SparkSession, path: str) -> DataFrame | None:
    """The current page, newest row first; None before the first batch with rows."""
    page = _newest_page(spark, path)
    return None if page is None else page.orderBy(*search.newest_first())

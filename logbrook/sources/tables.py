"""The stored tables: raw logs, hourly partials, rejects, and the host layout.

All are plain Parquet folders below one root. Every attempt to store a batch has folders of its own,
``ingest_id= / attempt=``, and is read once a commit names it (see ``commits``).

=================  ====================================  ===================================
folder             layout below the attempt              holds
=================  ====================================  ===================================
``logs``           ``log_date=``, by service and time    rows; compactions are batches, too
``logs-files``     plain                                 manifest of the files of ``logs``
``hourly``         plain                                 additive counts of a batch
``folds``          plain                                 hourly counts of many batches summed up
``rejects``        plain                                 lines set aside
``resolved``       plain                                 rejects that passed in a replay
``by_host``        ``log_date=``, by host and time       rows again
``commits``        ``commit_id=``                        what is visible
``saved_queries``  plain, appended                       saved searches
=================  ====================================  ===================================
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from logbrook import schema as S
from logbrook.operators import rollup
from logbrook.operators.search import newest_first
from logbrook.session import read_table
from logbrook.sources import commits as c, files


@dataclass(frozen=True)
class LogTables:
    """Paths of the tables below one root folder."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def logs(self) -> str:
        return self.path("logs")

    @property
    def hourly(self) -> str:
        return self.path("hourly")

    @property
    def rejects(self) -> str:
        return self.path("rejects")

    @property
    def by_host(self) -> str:
        return self.path("by_host")


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


# --- batches --------------------------------------------------------------------------


def stage(rows: DataFrame, path: str, batch: str) -> list[c.Entry]:
    """Write the rows of a batch's attempt; readers see them when the returned entries are committed."""
    attempt = c.new_attempt()
    rows.write.parquet(c.folder(path, batch, attempt))
    return [c.Entry(c.ADD, c.place(path)[1], batch, attempt)]


def _commit(spark: SparkSession, path: str, entries: list[c.Entry]) -> None:
    c.commit(spark, c.place(path)[0], entries)


def _live(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """All visible rows of a table without days, with their batch as ``ingest_id``; None where there is no batch."""
    live = c.snapshot(spark, path).live
    if not live:
        return None
    folders = [c.folder(path, e.batch, e.attempt) for e in live]
    return c.read_folders(spark, path, folders, T.StructType([*schema, T.StructField("ingest_id", T.StringType())]))


def batch_name(run_id: str, batch_id: int) -> str:
    """Batch ids are unique within a checkpoint only, so a job with a new checkpoint needs a new ``run_id``."""
    return f"{run_id}/{batch_id}"


# --- raw logs -----------------------------------------------------------------------


def stage_logs(
    logs: DataFrame, path: str, batch: str, partitions: int | None = None, grams: bool = True
) -> list[c.Entry]:
    """Write the log rows of a batch's attempt and their manifest; returns what to commit.

    A file holds rows of one day, by service and newest first. Rebalancing brings the rows of a day
    together and, at run time, cuts a day that is too large into several tasks and files. ``grams``: whether
    the manifest has the trigrams of the messages.
    """
    attempt = c.new_attempt()
    number = [] if partitions is None else [partitions]
    rows = logs.select(*S.LOG_COLUMNS).hint("rebalance", *number, "log_date")
    _write_days(rows, c.folder(path, batch, attempt))
    return files.describe(logs.sparkSession, path, batch, attempt, grams)


def _write_days(rows: DataFrame, folder: str) -> None:
    order = ["log_date", "service_name", *newest_first()]
    rows.sortWithinPartitions(*order).write.partitionBy("log_date").parquet(folder)


def write_logs(
    logs: DataFrame, path: str, ingest_id: str | None = None, partitions: int | None = None, grams: bool = True
) -> None:
    """Store the rows of one batch, named by ``ingest_id`` (a new name if not given).

    Writing the same batch again replaces it, also after a compaction. Writers of different batches have
    nothing in common, not even a folder for temporary files.
    """
    batch = ingest_id or uuid.uuid4().hex
    _commit(logs.sparkSession, path, stage_logs(logs, path, batch, partitions, grams))


def read_logs(
    spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """The log table, optionally some days of it only.

    The commit log is resolved first, and the scan is given the live folders: covered and replaced
    batches, and days outside the bounds, are not listed. Further filters on ``log_date`` prune folders,
    those on service, severity and time skip row groups.
    """
    return _visible(spark, path, first, last).select(S.LOGS_SCHEMA.fieldNames())


def _visible(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    seen = c.snapshot(spark, path, first, last)
    folders = [c.folder(path, e.batch, e.attempt, e.day) for e in seen.live if e.n_rows]
    return files.stored_rows(spark, path, folders, seen)


# --- tables with one folder per batch -----------------------------------------------


def write_batch(rows: DataFrame, path: str, run_id: str, batch_id: int) -> None:
    """Write the rows of one batch. Writing the same batch again replaces them, even by none."""
    _commit(rows.sparkSession, path, stage(rows, path, batch_name(run_id, batch_id)))


def write_rollup(logs: DataFrame, path: str, run_id: str, batch_id: int) -> None:
    """Store what one batch adds to the hourly counts."""
    write_batch(rollup.hourly_partials(logs), path, run_id, batch_id)


@dataclass(frozen=True)
class _Counts:
    """The newest fold that holds (its batch and attempt, or None) and the batches since."""

    fold: tuple[str, str] | None
    rest: list[tuple[str, str]]


def _counts(spark: SparkSession, tables: LogTables) -> _Counts:
    """Resolve folds: one holds as long as no batch in it was stored again."""
    log = c.entries(spark, tables.root)
    if log is None:
        return _Counts(None, [])
    hourly = c.by_batch(log.filter(F.col("table") == "hourly"))
    covers = hourly.select("latest", F.explode("covers").alias("c")).groupBy(F.col("c.by").alias("attempt"))
    holds = covers.agg(F.bool_and(F.col("c.attempt") == F.col("latest")).alias("holds")).filter("holds")
    folds = c.by_batch(log.filter(F.col("table") == "folds")).select("batch", F.col("latest").alias("attempt"))
    newest = folds.join(holds, "attempt", "left_semi").orderBy(F.col("batch").cast("long").desc()).first()
    by = newest["attempt"] if newest else ""
    rest = hourly.filter(~F.exists("covers", lambda x: x["by"] == by)).select("batch", "latest")
    rest = rest.filter(F.col("latest").isNotNull()).orderBy("latest")
    return _Counts((newest["batch"], by) if newest else None, [(r["batch"], r["latest"]) for r in rest.collect()])


def _partials_of(spark: SparkSession, tables: LogTables, counts: _Counts) -> DataFrame:
    fold = [c.folder(tables.path("folds"), *counts.fold)] if counts.fold else []
    summed = c.read_folders(spark, tables.path("folds"), fold, S.HOURLY_SCHEMA)
    rest = [c.folder(tables.hourly, *batch) for batch in counts.rest]
    return summed.unionByName(c.read_folders(spark, tables.hourly, rest, S.HOURLY_SCHEMA))


def read_partials(spark: SparkSession, tables: LogTables) -> DataFrame:
    """Hourly partials; several rows may belong to one service and hour. Folded batches are not read."""
    return _partials_of(spark, tables, _counts(spark, tables))


def read_rollup(spark: SparkSession, tables: LogTables) -> DataFrame:
    """Hourly counts per service, summed over all batches."""
    return rollup.rollup_of(read_partials(spark, tables))


def read_registry(spark: SparkSession, tables: LogTables) -> DataFrame:
    """Service registry, folded from the same partials."""
    return rollup.registry_of(read_partials(spark, tables))


def fold_rollup(spark: SparkSession, tables: LogTables) -> int | None:
    """Sum the last fold and the batches since into a new fold; returns its number.

    The commit names every batch in the fold, with its attempt. So a batch that arrives late is added to it,
    and when one is stored again the fold no longer holds: readers go back to an older one and
    the batches since, until the next fold. Nothing is deleted, and an interrupted fold is never seen.
    """
    counts = _counts(spark, tables)
    log = c.entries(spark, tables.root)
    if log is None:
        return None
    last = log.filter(F.col("table") == "folds").agg(F.max(F.col("batch").cast("long"))).first()[0]
    if not counts.rest:
        return last
    number = (last or 0) + 1
    summed = rollup.fold_partials(_partials_of(spark, tables, counts)).repartitionByRange("hour_bucket")
    entries = stage(summed, tables.path("folds"), str(number))
    covered = list(counts.rest)
    if counts.fold:
        before = log.filter((F.col("table") == "hourly") & (F.col("by") == counts.fold[1])).select("batch", "attempt")
        covered += [(r["batch"], r["attempt"]) for r in before.distinct().collect()]
    entries += [c.Entry(c.COVER, "hourly", batch, attempt, by=entries[0].attempt) for batch, attempt in covered]
    c.commit(spark, tables.root, entries)
    return number


# --- rejects ------------------------------------------------------------------------


def write_rejects(rejects: DataFrame, path: str, run_id: str, batch_id: int) -> None:
    write_batch(rejects, path, run_id, batch_id)


def stage_resolved(reject_ids: DataFrame, tables: LogTables, replay_id: str) -> list[c.Entry]:
    """Take rejects off the pending ones, once committed."""
    return stage(reject_ids.select("reject_id"), tables.path("resolved"), replay_id)


def _reject_id() -> Column:
    """One arrival of a line: the same broken line in a later batch is a reject of its own."""
    parts = ("ingest_id", "file", "off", "line")
    return F.md5(F.concat_ws("\u0001", *(F.coalesce(F.col(p).cast("string"), F.lit("\u0000")) for p in parts)))


def read_rejects(
    spark: SparkSession, tables: LogTables, except_replay: str | None = None
) -> DataFrame:
    """Rejects that no replay has resolved; ``except_replay`` is a replay not to count."""
    id_field = T.StructField("reject_id", T.StringType())
    stored = _live(spark, tables.rejects, S.REJECTS_SCHEMA)
    if stored is None:
        return _empty(spark, T.StructType([*S.REJECTS_SCHEMA, id_field]))
    pending = stored.select(*S.REJECTS_SCHEMA.fieldNames(), _reject_id().alias("reject_id"))
    passed = _live(spark, tables.path("resolved"), T.StructType([id_field]))
    if passed is None:
        return pending
    if except_replay is not None:
        passed = passed.filter(F.col("ingest_id") != except_replay)
    return pending.join(passed, "reject_id", "left_anti")


# --- saved searches -----------------------------------------------------------------


def save_queries(queries: DataFrame, tables: LogTables) -> None:
    """Add saved searches; ``query_text`` holds their parameters as JSON."""
    columns = S.SAVED_QUERIES_SCHEMA.fieldNames()
    queries.select(columns).write.mode("append").parquet(tables.path("saved_queries"))


def read_saved_queries(spark: SparkSession, tables: LogTables) -> DataFrame:
    stored = read_table(spark, tables.path("saved_queries"), S.SAVED_QUERIES_SCHEMA)
    return _empty(spark, S.SAVED_QUERIES_SCHEMA) if stored is None else stored


# --- compaction -----------------------------------------------------------------------


COMPACTED = "compacted-"
_COVERED = T.StructType(
    [
        T.StructField("ingest_id", T.StringType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("log_date", T.DateType()),
        T.StructField("n_rows", T.LongType()),
    ]
)


def _begun(path: str, generation: str) -> str:
    return f"{path.rstrip('/')}-begun/generation={generation}"


def begin_compaction(spark: SparkSession, path: str, day: dt.date) -> str:
    """Fix the folders that a compaction of one day will cover; returns its generation."""
    generation = f"{COMPACTED}{day}-{uuid.uuid4().hex[:12]}"
    live = [e for e in c.snapshot(spark, path, day, day).live if e.day == day and e.n_rows]
    rows = [(e.batch, e.attempt, e.day, e.n_rows) for e in live]
    spark.createDataFrame(rows, _COVERED).coalesce(1).write.parquet(_begun(path, generation))
    return generation


def finish_compaction(spark: SparkSession, path: str, generation: str, partitions: int | None = None) -> int:
    """Write the covered rows into few files, by service and time, and switch to them; returns their number.

    Readers switch with the commit, which is the last step and names the covered folders. Nothing is
    deleted: batches that arrive meanwhile, or are stored again, are not named and stay readable, and an
    interrupted compaction leaves the table as it was. Rows keep the batch and attempt they came from, so
    those of a batch that is stored again later can be told. Range partitioning splits a hot service by
    time, which gives files narrow ranges to choose by. ``partitions`` sets the number of ranges.
    """
    listed = spark.read.schema(_COVERED).parquet(_begun(path, generation)).collect()
    if not listed:
        return 0
    days = [r["log_date"] for r in listed]
    seen = c.snapshot(spark, path, min(days), max(days))
    folders = [c.folder(path, r["ingest_id"], r["attempt"], r["log_date"]) for r in listed]
    origin = F.coalesce("origin", files.origin_of(F.col("ingest_id"), F.col("attempt"))).alias("origin")
    rows = files.stored_rows(spark, path, folders, seen).select(*S.LOG_COLUMNS, origin)
    number = [] if partitions is None else [partitions]
    attempt = c.new_attempt()
    sorted_rows = rows.repartitionByRange(*number, "log_date", "service_name", F.desc("timestamp"))
    _write_days(sorted_rows, c.folder(path, generation, attempt))
    entries = files.describe(spark, path, generation, attempt)
    copied = sum(e.n_rows for e in entries)
    if not seen.replaced and copied != sum(r["n_rows"] for r in listed):
        raise RuntimeError(f"the copy {generation} is incomplete; the table was not touched")
    table = c.place(path)[1]
    covers = {(r["ingest_id"], r["attempt"], r["log_date"]) for r in listed}
    covers |= _origins(spark, path, {r["attempt"] for r in listed}, set(seen.replaced))
    entries += [c.Entry(c.COVER, table, batch, a, day, by=attempt) for batch, a, day in sorted(covers)]
    _commit(spark, path, entries)
    return copied


def _origins(spark: SparkSession, path: str, attempts: set[str], replaced: set[tuple[str, str]]) -> set[tuple]:
    """Folders whose rows lie in compactions that are compacted again."""
    root, table = c.place(path)
    covers = c.entries(spark, root, table).filter(F.col("by").isin(sorted(attempts)))
    found = {(r["batch"], r["attempt"], r["day"]) for r in covers.select("batch", "attempt", "day").collect()}
    return {line for line in found if line[:2] not in replaced}


def compact_day(spark: SparkSession, path: str, day: dt.date, **options) -> int:
    """Rewrite one day of the log table; returns its rows. Others may write the day meanwhile."""
    return finish_compaction(spark, path, begin_compaction(spark, path, day), **options)


# --- other layouts ------------------------------------------------------------------


def stage_logs_by_host(logs: DataFrame, path: str, batch: str, partitions: int | None = None) -> list[c.Entry]:
    """Write a batch's rows once more for searches by host over all services; returns what to commit.

    Rows are range-partitioned by day, host and time: a host's rows lie in few files, and
    a hot host is split by time. Rows without a key column are left out.
    """
    keys = ["host", "service_name", "log_date", "timestamp", "log_uuid"]
    order = ["log_date", "host", *newest_first()]
    number = [] if partitions is None else [partitions]
    attempt = c.new_attempt()
    (
        logs.dropna(subset=keys)
        .select(*S.LOG_COLUMNS)
        .repartitionByRange(*number, "log_date", "host", F.desc("timestamp"))
        .sortWithinPartitions(*order)
        .write.partitionBy("log_date")
        .parquet(c.folder(path, batch, attempt))
    )
    return [c.Entry(c.ADD, c.place(path)[1], batch, attempt)]


def write_logs_by_host(
    logs: DataFrame, path: str, ingest_id: str | None = None, partitions: int | None = None
) -> None:
    """Store the host layout of one batch; writing it again replaces it."""
    _commit(logs.sparkSession, path, stage_logs_by_host(logs, path, ingest_id or uuid.uuid4().hex, partitions))


def read_logs_by_host(spark: SparkSession, path: str) -> DataFrame:
    stored = _live(spark, path, T.StructType([f for f in S.LOGS_SCHEMA if f.name != "ingest_id"]))
    return (_empty(spark, S.LOGS_SCHEMA) if stored is None else stored).drop("ingest_id")


def export_csv(logs: DataFrame, path: str) -> None:
    """CSV of ``timestamp, service, severity, message, host`` with a header per file.

    Quotes inside a field are doubled, text is written untrimmed, a NULL host is empty.
    """
    rows = logs.select(
        "timestamp", F.col("service_name").alias("service"), "severity", "message",
        F.coalesce("host", F.lit("")).alias("host"),
    )
    (
        rows.write.option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .csv(path)
    )

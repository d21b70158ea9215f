"""Removing folders that no reader can reach any more."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from logbrook.sources import commits as c, files, tables as t

GRACE = dt.timedelta(days=7)
_TABLES = ("logs", "hourly", "folds", "rejects", "resolved", "by_host")


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it wants it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _remove(spark: SparkSession, path: str) -> bool:
    system, where = _file_system(spark, path)
    return bool(system.exists(where)) and bool(system.delete(where, True))


def _named(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a pattern."""
    system, where = _file_system(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(where) or ()]


def _cutoff(as_of: dt.datetime, grace: dt.timedelta) -> str:
    """Commits and attempts with a lesser name are older than the grace period."""
    since = as_of - grace - dt.datetime(1970, 1, 1)
    return f"{(since // dt.timedelta(microseconds=1)) * 1000:020d}"


def _lines(spark: SparkSession, tables: t.LogTables) -> DataFrame | None:
    """Entries of the log with ``gone``: the commit since which new readers do not use what was added."""
    log = c.entries(spark, tables.root)
    if log is None:
        return None
    fold = t._counts(spark, tables).fold
    batches = c.by_batch(log)
    last = F.array_max("adds.at")
    one = F.struct(F.col("add.attempt").alias("attempt"), F.col("add.day").alias("day"))
    same = F.filter("covers", lambda x: (x["attempt"] == one["attempt"]) & x["day"].eqNullSafe(one["day"]))
    covered = F.when(F.col("table") != "hourly", F.array_min(F.transform(same, lambda x: x["at"])))
    replaced = F.when(F.col("add.attempt") != F.col("latest"), last)
    adds = batches.withColumn("add", F.explode("adds")).select("table", "batch", "add", F.least(replaced, covered).alias("gone"))
    if fold is not None:
        holds = log.filter((F.col("table") == "folds") & (F.col("attempt") == fold[1])).agg(F.min("at")).first()[0]
        older = (F.col("table") == "folds") & (F.col("batch").cast("long") < int(fold[0]))
        adds = adds.withColumn("gone", F.when(older, F.lit(holds)).otherwise(F.col("gone")))
    return adds


def vacuum(spark: SparkSession, tables: t.LogTables, as_of: dt.datetime, grace: dt.timedelta = GRACE) -> int:
    """Remove what no reader that began within ``grace`` before ``as_of`` (UTC) can use; returns the folders removed.

    These are attempts that were replaced, days that a compaction covers, folds before the newest that
    holds, and attempts that were never committed, each only when that is longer ago than ``grace``. Readers hold
    a list of folders from their start, so one begun before goes on for the grace period. Commits older than
    that are summed up into one, written before they are removed; an interrupted run is completed by the
    next. Partials of folded batches stay: a fold is made anew from them if one is stored again.
    """
    cutoff = _cutoff(as_of, grace)
    adds = _lines(spark, tables)
    if adds is None:
        return 0
    old = adds.withColumn("old", F.coalesce(F.col("gone") < cutoff, F.lit(False)))
    whole = old.groupBy(F.col("add.attempt").alias("whole")).agg(F.bool_and("old").alias("all_old")).filter("all_old")
    doomed = old.filter("old").join(whole, F.col("add.attempt") == F.col("whole"), "left")
    gone = [(r["table"], r["batch"], r["attempt"], r["day"], r["all_old"]) for r in doomed.select("table", "batch", "add.attempt", "add.day", "all_old").collect()]
    _sum_up(spark, tables, [line[:4] for line in gone], cutoff)
    removed = 0
    for table, batch, attempt, day, all_old in gone:
        path = tables.path(table)
        removed += _remove(spark, c.folder(path, batch, attempt, day))
        if all_old:
            for base in [path, files.manifest_path(path)] if table == "logs" else [path]:
                _remove(spark, c.folder(base, batch, attempt))
    return removed + _remove_unknown(spark, tables, cutoff)


def _sum_up(spark: SparkSession, tables: t.LogTables, gone: list[tuple], cutoff: str) -> None:
    """Replace old commits by one that lists what still counts of them."""
    old = [p for p in _named(spark, f"{tables.root}/commits/commit_id=*") if p.rpartition("=")[2] < cutoff]
    if not old:
        return
    log = spark.read.schema(c.ENTRY).parquet(*old).distinct()
    dead = spark.createDataFrame(gone, "table string, batch string, attempt string, day date")
    same = [F.col(f"log.{n}").eqNullSafe(F.col(f"dead.{n}")) for n in ("table", "batch", "attempt", "day")]
    kept = log.alias("log").join(dead.alias("dead"), [(F.col("log.action") == c.ADD), *same], "left_anti")
    holders = dead.select(F.col("attempt").alias("by")).distinct()
    kept = kept.join(holders, "by", "left_anti").select(*c.ENTRY.fieldNames())
    at = c.new_attempt()
    kept.coalesce(1).write.parquet(f"{tables.root}/commits/commit_id={at}")
    for path in old:
        _remove(spark, path)


def _remove_unknown(spark: SparkSession, tables: t.LogTables, cutoff: str) -> int:
    """Remove old attempts that no commit names."""
    found = []
    for table in _TABLES:
        for base in (table, f"{table}-files") if table == "logs" else (table,):
            for path in _named(spark, f"{tables.path(base)}/ingest_id=*/attempt=*"):
                attempt = path.rpartition("=")[2]
                if attempt < cutoff:
                    found.append((attempt, path))
    if not found:
        return 0
    listed = spark.createDataFrame(found, "attempt string, path string")
    log = c.entries(spark, tables.root)
    known = log.filter(F.col("action") == c.ADD).select("attempt").distinct()
    unknown = listed.join(known, "attempt", "left_anti").collect()
    return sum(_remove(spark, row["path"]) for row in unknown)

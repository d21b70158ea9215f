"""The commit log: which attempts of which batches readers see.

Every try to store a batch is an attempt with folders of its own; nothing is overwritten. A commit is one
small file that lists the folders that become visible, of all tables of the batch at once, so a reader sees
a batch whole or not at all. Its entries either add an attempt (of a table, a batch and, for tables cut
by day, a day) or say that a folder is covered by another attempt (a compaction's or a fold's).

* Of several committed attempts of a batch the latest counts.
* Covered folders are named one by one, with their attempt: a batch that comes late, or again, after a
  compaction or a fold is not covered by it.

Latest is by the clock of the driver that wrote the attempt. A batch is retried by one driver after
another; their clocks may differ by no more than the time between the tries.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from logbrook.session import read_table

ADD, COVER = "add", "cover"
ENTRY = T.StructType(
    [
        T.StructField("at", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("batch", T.StringType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("n_rows", T.LongType()),
        # Of a cover: the attempt that holds the rows instead.
        T.StructField("by", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Entry:
    """One line of a commit."""

    action: str
    table: str
    batch: str
    attempt: str
    day: dt.date | None = None
    n_rows: int | None = None
    by: str | None = None


@dataclass(frozen=True)
class Snapshot:
    """What a reader of one table sees: live folders, and replaced origins whose rows lie in live compactions."""

    live: tuple[Entry, ...]
    replaced: tuple[tuple[str, str], ...]


def new_attempt() -> str:
    """A name that sorts by time."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def age_of(attempt: str, as_of: dt.datetime) -> dt.timedelta:
    """How long before ``as_of`` (UTC) an attempt or commit was named."""
    named = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=int(attempt.split("-")[0]) // 1000)
    return as_of - named


def folder_name(value: str) -> str:
    """A partition value as Spark reads it back from a folder name."""
    return quote(value, safe=" !$&'()+,-.;<>@_`|~") or "__HIVE_DEFAULT_PARTITION__"


def folder(path: str, batch: str, attempt: str, day: dt.date | None = None) -> str:
    """Folder of an attempt, or of a day of it."""
    whole = f"{path.rstrip('/')}/ingest_id={folder_name(batch)}/attempt={attempt}"
    return whole if day is None else f"{whole}/log_date={day}"


def place(path: str) -> tuple[str, str]:
    """Root and name of a table, from its path."""
    root, _, table = path.rstrip("/").rpartition("/")
    return root, table


def commit(spark: SparkSession, root: str, entries: Iterable[Entry], at: str | None = None) -> str:
    """Make the entries visible, all at once; returns the commit's name."""
    at = at or new_attempt()
    rows = [(at, e.action, e.table, e.batch, e.attempt, e.day, e.n_rows, e.by) for e in entries]
    spark.createDataFrame(rows, ENTRY).coalesce(1).write.parquet(f"{root}/commits/commit_id={at}")
    return at


def entries(spark: SparkSession, root: str, table: str | None = None) -> DataFrame | None:
    """All entries; a commit that was summed up into a later one may list an entry twice."""
    log = read_table(spark, f"{root}/commits", ENTRY)
    if log is None:
        return None
    return (log if table is None else log.filter(F.col("table") == table)).select(*ENTRY.fieldNames()).distinct()


def by_batch(log: DataFrame) -> DataFrame:
    """(table, batch, latest, adds, covers): what the log says of every batch, in one aggregation.

    A batch has few attempts, and each names its days once.
    """
    one = F.struct("at", "attempt", "day", "n_rows", "by")
    grouped = log.groupBy("table", "batch").agg(
        F.collect_list(F.when(F.col("action") == ADD, one)).alias("adds"),
        F.collect_list(F.when(F.col("action") == COVER, one)).alias("covers"),
    )
    latest = F.array_max(F.transform("adds", lambda a: F.struct(a["at"], a["attempt"].alias("attempt"))))["attempt"]
    return grouped.withColumn("latest", latest)


def uncovered(add: Column) -> Column:
    """Whether an add of the latest attempt is not covered, inside the rows of ``by_batch``."""
    same = F.exists("covers", lambda c: (c["attempt"] == add["attempt"]) & c["day"].eqNullSafe(add["day"]))
    return (add["attempt"] == F.col("latest")) & ~same


def snapshot(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> Snapshot:
    """The state of one table, optionally of some days only.

    The driver gets one line for each live folder, which it has to list for a scan anyway; superseded
    and covered ones are dropped before.
    """
    root, table = place(path)
    log = entries(spark, root, table)
    if log is None:
        return Snapshot((), ())
    batches = by_batch(log)
    lines = batches.select(
        "table",
        "batch",
        F.explode(
            F.concat(
                F.transform(F.filter("adds", uncovered), lambda a: F.struct(F.lit(ADD).alias("action"), a.alias("e"))),
                F.transform(
                    F.filter("covers", lambda c: c["attempt"] != F.col("latest")),
                    lambda c: F.struct(F.lit(COVER).alias("action"), c.alias("e")),
                ),
            )
        ).alias("line"),
    ).select("table", "batch", "line.action", "line.e.*")
    if first is not None:
        lines = lines.filter(F.col("day").isNull() | (F.col("day") >= F.lit(first)))
    if last is not None:
        lines = lines.filter(F.col("day").isNull() | (F.col("day") <= F.lit(last)))
    found = lines.collect()
    live = tuple(
        Entry(ADD, table, r["batch"], r["attempt"], r["day"], r["n_rows"])
        for r in sorted(found, key=lambda r: (r["attempt"], str(r["day"])))
        if r["action"] == ADD
    )
    holders = {e.attempt for e in live}
    replaced = {(r["batch"], r["attempt"]) for r in found if r["action"] == COVER and r["by"] in holders}
    return Snapshot(live, tuple(sorted(replaced)))


def read_folders(spark: SparkSession, path: str, folders: list[str], schema: T.StructType) -> DataFrame:
    """Parquet folders or files of one table, with partition columns read from their names; no rows without folders."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(schema.fieldNames())

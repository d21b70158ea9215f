"""Storing one batch of checked rows, and replaying rejects."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from logbrook.operators import ingest, rollup
from logbrook.session import work_dir
from logbrook.sources import tables as t
from logbrook.sources.commits import commit


@contextmanager
def _kept(events: DataFrame, staging: str | None) -> Iterator[DataFrame]:
    """The rows, held for several uses: in a written table, or in the executors."""
    if staging:
        events.write.mode("overwrite").parquet(staging)
        yield events.sparkSession.read.schema(events.schema).parquet(staging)
        return
    held = events.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def need_offsets(lines: DataFrame) -> DataFrame:
    """Refuse lines that cannot be told apart: ids of stored rows come from file and offset."""
    if not {"file", "off"} <= set(lines.columns):
        raise ValueError("stored lines need the columns file and off")
    return lines


def store_batch(
    events: DataFrame,
    tables: t.LogTables,
    run_id: str,
    batch_id: int,
    staging: str | None = None,
    by_host: bool = False,
) -> None:
    """Write a batch of ``ingest_lines`` rows: logs, hourly partials, and rejects.

    The checked batch is kept for the writes, so its lines are parsed once. A
    micro-batch is kept in the executors; a lost executor's share is recomputed from the
    source's byte ranges. A bulk load names a ``staging`` folder instead.

    All tables become visible with one commit, so a reader sees the batch whole or not at all. A
    batch written again replaces it; so a repeated or interrupted batch counts once, and other
    writers are never touched. ``by_host`` also keeps the layout for searches by host.
    """
    batch = t.batch_name(run_id, batch_id)
    with _kept(events, staging) as checked:
        logs = ingest.accepted(checked)
        entries = t.stage_logs(logs, tables.logs, batch)
        if by_host:
            entries += t.stage_logs_by_host(logs, tables.by_host, batch)
        entries += t.stage(rollup.hourly_partials(logs), tables.hourly, batch)
        entries += t.stage(ingest.rejected(checked), tables.rejects, batch)
    commit(events.sparkSession, tables.root, entries)


class BatchSink:
    """``foreachBatch`` function of one run of a stream of ``ingest_lines`` rows."""

    def __init__(self, tables: t.LogTables, run_id: str, by_host: bool = False):
        self.tables, self.run_id, self.by_host = tables, run_id, by_host

    def __call__(self, events: DataFrame, batch_id: int) -> None:
        store_batch(events, self.tables, self.run_id, batch_id, by_host=self.by_host)


def load_lines(
    lines: DataFrame,
    tables: t.LogTables,
    run_id: str,
    as_of: dt.datetime | None = None,
    staging: str | None = None,
    by_host: bool = False,
) -> None:
    """Store a batch DataFrame of lines (``file, off, line``).

    The same lines under the same ``run_id`` are stored once, so an interrupted load is
    completed by running it again; other lines need another ``run_id``. The checked rows
    are held in a written table, by default below the cluster's checkpoint folder, because
    a load can be larger than the executors' disks. It can be removed afterwards.
    """
    events = ingest.ingest_lines(need_offsets(lines), as_of)
    staging = staging or work_dir(lines.sparkSession, "load")
    store_batch(events, tables, run_id, 0, staging=staging, by_host=by_host)


def replay_rejects(
    spark: SparkSession,
    tables: t.LogTables,
    replay_id: str,
    repair: Callable[[DataFrame], DataFrame] | None = None,
    as_of: dt.datetime | None = None,
) -> None:
    """Check the rejects again; store those that pass and keep the others.

    ``repair`` may change the ``line`` before the check. Rows are stored and taken off the rejects with
    one commit. A replay may be run again under its ``replay_id``: it looks at the rejects as if it
    had not run, and replaces what it wrote. Rejects that came later need a replay with an id of its own.
    """
    pending = t.read_rejects(spark, tables, except_replay=replay_id)
    lines = repair(pending) if repair else pending
    events = ingest.ingest_lines(lines.drop("reason"), as_of)
    with _kept(events.filter(F.col("reason").isNull()), None) as passed:
        logs = ingest.accepted(passed)
        batch = t.batch_name(f"replay-{replay_id}", 0)
        entries = t.stage_logs(logs, tables.logs, batch)
        entries += t.stage(rollup.hourly_partials(logs), tables.hourly, batch)
        entries += t.stage_resolved(passed, tables, replay_id)
    commit(spark, tables.root, entries)

"""Helpers that several training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from logbrook.session import written


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8(column: pa.Array) -> Iterator[bytes]:
    """The values of a string column as UTF-8 bytes, null as empty, one at a time."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most so many rows for the jobs that run inside: less memory for rows that are long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_size(text: Column | str) -> Column:
    """UTF-8 bytes of a text, null as none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def word_count(text: Column | str) -> Column:
    """Number of runs of anything but ASCII white space; null as none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have: ``name``, with underscores behind it if need be."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Rows up to which a table of one thin row for each source, shard or the like is broadcast.
BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df``, broadcast if it has few rows; it must be cheap to count, and its rows thin."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def fields(df: DataFrame, **added: T.DataType) -> T.StructType:
    """The schema of ``df`` followed by new nullable fields."""
    return T.StructType([*df.schema.fields, *(T.StructField(name, kind) for name, kind in added.items())])


def running(df: DataFrame, order: Sequence[str], add: str, label: str, into: str = "before") -> DataFrame:
    """Rows with ``into``: the sum of the long column ``add`` over all rows that come earlier in one global order.

    Spark range-partitions by the sampled order columns and sorts each range; a task adds up its
    own range, and the sums of the ranges (one number for each partition) are added on top.
    The ranges are written to shared storage first, because a second sampling could cut
    differently. Rows equal in all order columns take any order among themselves; a unique tie
    column lets even such rows be cut into several ranges.
    """
    tie, part = "__tie", "__part"
    keys = [*order, tie]
    schema = fields(df, **{tie: T.LongType(), part: T.LongType(), into: T.LongType()})
    sorted_rows = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = 0, TaskContext.get().partitionId()
        for batch in batches:
            sums = np.cumsum(batch.column(add).to_numpy(zero_copy_only=False), dtype=np.int64)
            if len(sums):
                before = np.concatenate(([0], sums[:-1])) + total
                total += int(sums[-1])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.full(len(sums), number, np.int64)), pa.array(before)],
                    names=schema.names,
                )

    local = written(sorted_rows.mapInArrow(add_up, schema), label)
    sums = local.groupBy(part).agg(F.max(F.col(into) + F.col(add)).alias("total")).orderBy(part).collect()
    offsets, total = [], 0
    for row in sums:
        offsets.append((row[part], total))
        total += row["total"]
    table = df.sparkSession.createDataFrame(offsets, f"{part} long, __offset long")
    return (
        local.join(F.broadcast(table), part)
        .withColumn(into, F.col(into) + F.col("__offset"))
        .drop(tie, part, "__offset")
    )


def rank_in(df: DataFrame, keys: Sequence[str], order: Sequence[str], top: int) -> DataFrame:
    """The first ``top`` rows of each key."""
    rank = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= top)

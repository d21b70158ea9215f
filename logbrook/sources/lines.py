"""Readers for lines of log files: once, or as a stream."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from logbrook.sources import tail


def _absolute(path: str) -> str:
    """Executors have other working folders than the driver."""
    return path if ":" in path.split("/")[0] else os.path.abspath(path)


def read_lines(
    spark: SparkSession, path: str, pattern: str = "*.log", offsets: bool = True
) -> DataFrame:
    """All current lines of the files, as ``file, off, line``.

    Lines carry their byte offset, and so get the same ids as lines that were followed by
    ``follow_lines``; large files are split. Without ``offsets`` it is Spark's text scan with no
    Python on the way and a NULL ``off``: enough to count or search lines, but not to store them.
    """
    if offsets:
        tail.register(spark)
        reader = spark.read.format("logtail").option("pattern", pattern)
        return reader.option("parallelism", spark.sparkContext.defaultParallelism).load(
            _absolute(path)
        )
    text = spark.read.option("pathGlobFilter", pattern).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.lit(None).cast("bigint").alias("off"),
        F.col("value").alias("line"),
    )


def follow_lines(spark: SparkSession, path: str, pattern: str = "*.log", **options) -> DataFrame:
    """Lines appended to the files, as a stream. ``options`` are those of ``logtail``."""
    tail.register(spark)
    reader = spark.readStream.format("logtail").option("pattern", pattern)
    reader = reader.option("parallelism", spark.sparkContext.defaultParallelism)
    return reader.options(**options).load(_absolute(path))

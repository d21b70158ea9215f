"""``logtail``: a data source that follows growing JSON Lines files by byte offset.

Spark's own file stream reads every file once and never looks at it again, so it cannot
follow a log that is still written. This source keeps one byte offset per file in the
query's checkpoint, hands out whole lines only, and starts over when a file shrank.

The driver only plans: it lists the folder and looks for the last newline of files that
grew. Executors read the byte ranges; a large range is cut into splits, so one hot file
is read by many tasks. The folder must be reachable by all executors.

Options
  path                folder to watch (required)
  pattern             file name pattern, default ``*.log``
  splitBytes          largest share of one read task, default 64 MiB
  parallelism         read tasks to aim for while shares are smaller than that
  maxBytesPerTrigger  cap of one micro-batch; the rest follows in the next ones
  registry            JSON file that repeats the planned offsets. Spark does not tell a
                      Python source its committed offset when it plans the first
                      micro-batch of a run; the cap holds for that one only with a
                      registry, given from the first run of a checkpoint on

The ``availableNow`` trigger plans once, so there the cap is the cap of the whole run.

A rotated file is noticed by its smaller size. One that already outgrew the old offset
when it is next looked at cannot be told from a file that was appended to.
"""

from __future__ import annotations

import fnmatch
import json
import posixpath
import sys
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

# Executors may not have this package installed: ship the classes themselves.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIB = 1024 * 1024
BLOCK = 4 * MIB
LEAST_SPLIT = MIB
PROBE = 64 * 1024
PLAN_THREADS = 16

SCHEMA = "file string, off bigint, line string"
_ARROW = pa.schema([("file", pa.string()), ("off", pa.int64()), ("line", pa.string())])


class ByteRange(InputPartition):
    """Lines of one file whose first byte lies in ``[low, high)``.

    ``origin`` is where the whole range began: a line certainly starts there.
    ``limit`` is where the readable part of the file ends.
    """

    def __init__(self, file: str, low: int, high: int, origin: int, limit: int):
        self.file, self.low, self.high = file, low, high
        self.origin, self.limit = origin, limit


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return pafs.LocalFileSystem(), path


class Folder:
    """The watched files of one folder."""

    def __init__(self, options: dict):
        if "path" not in options:
            raise ValueError("logtail needs the option 'path'")
        self.filesystem, self.root = _filesystem(options["path"])
        self.pattern = options.get("pattern", "*.log")
        self.split_bytes = int(options.get("splitBytes", 64 * MIB))
        self.parallelism = int(options.get("parallelism", 1))
        if self.split_bytes <= 0 or self.parallelism <= 0:
            raise ValueError("splitBytes and parallelism must be positive")

    def sizes(self) -> dict[str, int]:
        found = self.filesystem.get_file_info(pafs.FileSelector(self.root, allow_not_found=True))
        return {
            info.path: info.size
            for info in found
            if info.is_file and fnmatch.fnmatchcase(posixpath.basename(info.path), self.pattern)
        }

    def whole_lines_end(self, file: str, low: int, high: int) -> int:
        """Position after the last newline in ``[low, high)``; ``low`` if there is none."""
        with self.filesystem.open_input_file(file) as f:
            while high > low:
                start = max(low, high - PROBE)
                f.seek(start)
                at = f.read(high - start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                high = start
        return low

    def next_line_end(self, file: str, low: int, high: int) -> int:
        """Position after the first newline in ``[low, high)``; -1 if there is none."""
        with self.filesystem.open_input_file(file) as f:
            f.seek(low)
            while low < high:
                data = f.read(min(PROBE, high - low))
                if not data:
                    break
                at = data.find(b"\n")
                if at >= 0:
                    return low + at + 1
                low += len(data)
        return -1

    def splits(self, ranges: list[tuple[str, int, int]]) -> list[ByteRange]:
        """Cut (file, low, high) ranges into read tasks of about equal size."""
        total = sum(high - low for _, low, high in ranges)
        step = min(self.split_bytes, max(LEAST_SPLIT, -(-total // self.parallelism)))
        return [
            ByteRange(file, at, min(at + step, high), low, high)
            for file, low, high in ranges
            for at in range(low, high, step)
        ]

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        """Whole lines of a split, block by block."""
        with self.filesystem.open_input_file(part.file) as f:
            at = part.low
            if at > part.origin:
                # The line this split begins in belongs to the split before.
                at = self.next_line_end(part.file, at - 1, part.limit)
                if at < 0:
                    return
            f.seek(at)
            waiting: list[bytes] = []
            read_to = at
            while at < part.high:
                data = f.read(min(BLOCK, part.limit - read_to)) if read_to < part.limit else b""
                read_to += len(data)
                cut = data.rfind(b"\n") + 1
                if data and not cut:
                    waiting.append(data)
                    continue
                block = b"".join([*waiting, data[:cut]])
                waiting = [data[cut:]]
                if block:
                    yield _whole_lines(part, block, at)
                    at += len(block)
                if not data:
                    return


def _whole_lines(part: ByteRange, block: bytes, at: int) -> pa.RecordBatch:
    """The lines of a block that begins at byte ``at`` with a line, as far as they begin in the split.

    Newlines are found and cut out over the whole block at once; only a block with broken UTF-8 is
    decoded line by line.
    """
    data = np.frombuffer(block, np.uint8)
    ends = np.flatnonzero(data == 10)
    if not len(ends) or ends[-1] != len(data) - 1:
        ends = np.append(ends, len(data))
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = int(np.searchsorted(starts, part.high - at))
    starts, ends = starts[:count], ends[:count]
    returns = (ends > starts) & (data[np.maximum(ends - 1, 0)] == 13)
    try:
        block.decode()
    except UnicodeDecodeError:
        stops = ends - returns
        texts = pa.array([block[i:j].decode("utf-8", "replace") for i, j in zip(starts.tolist(), stops.tolist())], pa.string())
    else:
        kept = np.ones(int(ends[-1]) if count else 0, bool)
        kept[ends[:-1]] = False
        kept[ends[returns] - 1] = False
        places = np.concatenate(([0], np.cumsum(ends - starts - returns))).astype(np.int32)
        texts = pa.StringArray.from_buffers(count, pa.py_buffer(places.tobytes()), pa.py_buffer(data[: len(kept)][kept].tobytes()))
    files = pa.DictionaryArray.from_arrays(np.zeros(count, np.int32), [part.file]).cast(pa.string())
    return pa.RecordBatch.from_arrays([files, pa.array(starts + at), texts], schema=_ARROW)


class OnceReader(DataSourceReader):
    """All current lines, a last line without newline included."""

    def __init__(self, folder: Folder):
        self.folder = folder

    def partitions(self) -> list[ByteRange]:
        sizes = self.folder.sizes()
        return self.folder.splits([(file, 0, sizes[file]) for file in sorted(sizes)])

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        return self.folder.read(partition)


class TailReader(DataSourceStreamReader):
    """Lines completed since the last micro-batch. An offset is ``{file: byte}``."""

    def __init__(self, folder: Folder, max_bytes: int | None, registry: str | None):
        self.folder, self.max_bytes, self.registry = folder, max_bytes, registry
        self.planned: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        self.planned = {}
        return {}

    def latestOffset(self) -> dict:
        if self.planned is None:
            self.planned = self._recall()
        known = self.planned or {}
        sizes = self.folder.sizes()
        grown = sorted(f for f, size in sizes.items() if size != known.get(f, 0))
        cap = None
        if self.max_bytes and self.planned is not None and grown:
            cap = max(1, self.max_bytes // len(grown))
        with ThreadPoolExecutor(PLAN_THREADS) as pool:
            ends = pool.map(lambda f: self._end(f, known.get(f, 0), sizes[f], cap), grown)
            # A file that is gone for now keeps its offset.
            return {**known, **dict(zip(grown, ends))}

    def _end(self, file: str, start: int, size: int, cap: int | None) -> int:
        start = 0 if size < start else start
        top = size if cap is None else min(size, start + cap)
        end = self.folder.whole_lines_end(file, start, top)
        if end == start and top < size:
            # A line longer than the cap is taken whole.
            end = max(end, self.folder.next_line_end(file, top, size))
        return end

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        self.planned = {**start, **end}
        self._remember()
        lows = {file: start.get(file, 0) for file in end}
        # An end before the start means that the file was replaced by a smaller one.
        return self.folder.splits(
            [(f, 0 if high < lows[f] else lows[f], high) for f, high in sorted(end.items())]
        )

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        return self.folder.read(partition)

    def _recall(self) -> dict[str, int] | None:
        if not self.registry:
            return None
        filesystem, path = _filesystem(self.registry)
        if filesystem.get_file_info(path).type == pafs.FileType.NotFound:
            return {}
        with filesystem.open_input_file(path) as f:
            return json.loads(f.readall())

    def _remember(self) -> None:
        if self.registry:
            filesystem, path = _filesystem(self.registry)
            filesystem.create_dir(posixpath.dirname(path), recursive=True)
            with filesystem.open_output_stream(path + ".next") as f:
                f.write(json.dumps(self.planned).encode())
            filesystem.move(path + ".next", path)


class LogTail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "logtail"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> OnceReader:
        return OnceReader(Folder(self.options))

    def streamReader(self, schema) -> TailReader:
        cap = self.options.get("maxBytesPerTrigger")
        return TailReader(
            Folder(self.options), int(cap) if cap else None, self.options.get("registry")
        )


def register(spark: SparkSession) -> None:
    """Make ``format("logtail")`` known to the session."""
    spark.dataSource.register(LogTail)

"""Exact removal of repeated byte strings with a distributed sparse suffix array.

A string of LENGTH bytes that occurs twice has the same anchor in both places: the position inside it
whose next LEAD bytes hash lowest. So the suffixes that start at anchors are enough. They are
range-partitioned by their leading bytes with sampled splitters, every bucket sorts its suffixes by
multikey quicksort, and neighbours are compared to the right and, because strings start up to
LENGTH - LEAD bytes before their anchor, to the left. Suffixes at the ends of a bucket may have equals
in other buckets, so these are compared across the boundaries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from logbrook.llm.common import documents, fields, fresh, utf8
from logbrook.session import written

LENGTH = 200
LEAD = 64
#: Bytes of the leading key that buckets are cut by.
KEY = 24
_REACH = LENGTH - LEAD
_WINDOW = LENGTH - LEAD + 1
_PIECE = 1 << 20
_SLICE = 1 << 16
_PLACE_BITS = np.uint64(24)
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15
_CHUNK_RECORDS = 40_000
_SEEN_BYTES = 48 << 20
#: The filter of repeated leads has 16 bits for each, up to this many; a fuller one only lets more through.
_FILTER_BITS = 1 << 29
_SEGMENT_BITS = 1 << 20

_RECORDS = "lead binary, hash long, salt long, row long, start long, stop long, anchor int, context binary"
_FOUND = "row long, start long, stop long, part int, digests binary, rows binary, starts binary"


# ---- anchors --------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random numbers for the bytes, and powers of the hash's base and of its inverse over a slice: one megabyte."""
    size = _SLICE + LEAD
    values = np.random.default_rng(1).integers(0, 1 << 64, 256, dtype=np.uint64)
    up = np.cumprod(np.full(size, _BASE, np.uint64))
    down = np.cumprod(np.full(size, pow(_BASE, -1, 1 << 64), np.uint64))
    return values, up, down


def lead_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the LEAD bytes from each position, slice by slice."""
    values, up, down = _powers()
    hashes = np.empty(max(len(data) - LEAD + 1, 0), np.uint64)
    for begin in range(0, len(hashes), _SLICE):
        part = data[begin : begin + _SLICE + LEAD - 1]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values[part] * up[: len(part)], dtype=np.uint64)))
        hashes[begin : begin + _SLICE] = (sums[LEAD:] - sums[:-LEAD]) * down[: len(part) - LEAD + 1]
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(29))


def sliding_minimum(values: np.ndarray, window: int) -> np.ndarray:
    """Minimum of every run of ``window`` values."""
    size = len(values) - window + 1
    padded = np.full(-(-len(values) // window) * window, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:size], ahead[window - 1 : window - 1 + size])


class Buffer:
    """Pieces of texts side by side; pieces of a long text overlap by LENGTH - 1 bytes."""

    def __init__(self):
        self.parts, self.rows, self.offsets, self.tags, self.size = [], [], [], [], 0

    def add(self, row: int, offset: int, part: bytes, tag: int) -> None:
        self.parts.append(part)
        self.rows.append(row)
        self.offsets.append(offset)
        self.tags.append(tag)
        self.size += len(part)

    def anchors(self) -> dict[str, np.ndarray]:
        """For each anchor: the strings' first and last start and the anchor itself (all in ``data``), its piece and hash."""
        data = np.frombuffer(b"".join(self.parts), np.uint8)
        lengths = np.array([len(p) for p in self.parts])
        begins = np.cumsum(lengths) - lengths
        hashes = lead_hashes(data)
        ranked = (hashes >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
        lowest = (sliding_minimum(ranked, _WINDOW) & _PLACE).astype(np.int64)
        steps = np.zeros(len(lowest) + 1, np.int8)
        steps[begins] += 1
        steps[begins + lengths - LENGTH + 1] -= 1
        inside = np.flatnonzero(np.cumsum(steps[:-1], dtype=np.int8))
        lowest = lowest[inside]
        heads = np.flatnonzero(np.concatenate(([True], lowest[1:] != lowest[:-1])))
        first, last = inside[heads], inside[np.append(heads[1:], len(inside)) - 1]
        at = lowest[heads]
        return {"data": data, "first": first, "last": last, "at": at, "piece": np.searchsorted(begins, first, "right") - 1, "begins": begins, "hash": hashes[at]}


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[Buffer]:
    """All texts of LENGTH bytes or more, in buffers; a copy of a text met before in the task is left out."""
    from xxhash import xxh3_128_intdigest

    met: set[int] = set()
    buffer = Buffer()
    for batch in batches:
        for row, text in zip(batch.column("__row").to_pylist(), utf8(batch.column("__text"))):
            if len(text) < LENGTH:
                continue
            tag = xxh3_128_intdigest(text)
            if tag in met:
                continue
            met.add(tag)
            for offset in range(0, max(len(text) - LENGTH + 1, 1), _PIECE - LENGTH + 1):
                buffer.add(row, offset, text[offset : offset + _PIECE], tag & ((1 << 64) - 1))
                if buffer.size >= _PIECE:
                    yield buffer
                    buffer = Buffer()
    if buffer.size:
        yield buffer


def _leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, place) of every anchor; equal texts give equal places."""
    for buffer in _buffers(batches):
        found = buffer.anchors()
        piece = found["piece"]
        inside = found["at"] - found["begins"][piece] + np.array(buffer.offsets)[piece]
        place = (np.array(buffer.tags, np.uint64)[piece] + inside.astype(np.uint64)) * np.uint64(0xD1342543DE82EF95)
        place ^= place >> np.uint64(31)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found["hash"].view(np.int64)), pa.array(place.view(np.int64))], names=["hash", "place"]
        )


def repeated_leads(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Bitmap over the low bits of the hashes of all leads found in two places, and its number of bits.

    Its size is bounded by _FILTER_BITS (64 MB), whatever the input. Strings it lets through in vain
    cost time only: the buckets compare all bytes.
    """
    places = texts.mapInArrow(_leads, "hash long, place long")
    twice = places.groupBy("hash").agg(F.min("place").alias("a"), F.max("place").alias("b")).filter("a <> b").select("hash")
    twice = written(twice, "suffix-leads")
    bits = min(max(1 << (16 * twice.count()).bit_length(), _SEGMENT_BITS), _FILTER_BITS)
    places = twice.select(F.col("hash").bitwiseAND(F.lit(bits - 1)).alias("bit")).distinct()

    def segment(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        plane = np.zeros(_SEGMENT_BITS, np.uint8)
        plane[rows["bit"].to_numpy() % _SEGMENT_BITS] = 1
        return pd.DataFrame({"segment": [key[0]], "plane": [np.packbits(plane, bitorder="little").tobytes()]})

    grouped = places.groupBy(F.expr(f"cast(bit div {_SEGMENT_BITS} as int)").alias("segment"))
    bitmap = np.zeros(bits // 8, np.uint8)
    for row in grouped.applyInPandas(segment, "segment int, plane binary").collect():
        at = row["segment"] * (_SEGMENT_BITS // 8)
        bitmap[at : at + _SEGMENT_BITS // 8] = np.frombuffer(row["plane"], np.uint8)
    return bitmap, bits


# ---- records: anchored suffixes with the bytes to both sides --------------------------------


def _records(batches: Iterator[pa.RecordBatch], bitmap: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Anchored suffixes whose lead may be repeated; equal ones of a task are found here and sent once.

    A row without context says that its bytes from start to stop are repeated.
    """
    from xxhash import xxh64_intdigest

    seen: dict[bytes, list] = {}
    held = 0
    for buffer in _buffers(batches):
        found = buffer.anchors()
        low = found["hash"] & np.uint64(bits - 1)
        maybe = np.flatnonzero((bitmap[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1)
        data = found["data"].tobytes()
        rows: list[tuple] = []
        piece = found["piece"][maybe]
        columns = (found["first"][maybe], found["last"][maybe], found["at"][maybe], found["hash"][maybe].view(np.int64), piece, found["begins"][piece])
        for first, last, at, hash_, number, begin in zip(*(c.tolist() for c in columns)):
            context = data[first : last + LENGTH]
            row, start = buffer.rows[number], first - begin + buffer.offsets[number]
            stop = start + len(context)
            before = seen.get(context)
            if before is None:
                seen[context] = [row, start, stop]
                held += len(context)
                salt = xxh64_intdigest(f"{row}:{start}") >> 1
                rows.append((data[at : at + KEY], hash_, salt, row, start, stop, at - first, context))
                continue
            rows.append((None, None, None, row, start, stop, None, None))
            if before:
                rows.append((None, None, None, *before, None, None))
                before.clear()
        if held > _SEEN_BYTES:
            seen, held = {}, 0
        yield _batch(rows, _RECORDS)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(part.split() for part in schema.split(", ")))
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names=list(names))


# ---- buckets --------------------------------------------------------------------------------


def multikey_order(groups: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Order of strings by (group, bytes), given as rows of big-endian 8-byte characters.

    Multikey quicksort with a character of 8 bytes, all groups of one depth at once: strings that
    still tie are partitioned by their next character; a string alone in its group is done.
    """
    order = np.argsort(groups, kind="stable")
    ranks = np.cumsum(np.concatenate(([0], np.diff(groups[order]) != 0)))
    open_ = np.arange(len(order))
    for depth in range(words.shape[1]):
        tied = np.concatenate(([False], ranks[1:] == ranks[:-1])) if len(ranks) else np.zeros(0, bool)
        tied |= np.append(tied[1:], False)
        open_, ranks = open_[tied], ranks[tied]
        if not len(open_):
            break
        character = words[order[open_], depth]
        partition = np.lexsort((character, ranks))
        order[open_] = order[open_[partition]]
        character, ranks = character[partition], ranks[partition]
        ranks = np.cumsum(np.concatenate(([0], (np.diff(ranks) != 0) | (character[1:] != character[:-1]))))
    return order


def shared_lengths(order: np.ndarray, groups: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """How many bytes each string in order shares with the one before; -1 where a group begins."""
    shared = np.full(len(order), -1)
    if len(order) > 1:
        equal = strings[order[1:]] == strings[order[:-1]]
        lengths = np.where(equal.all(axis=1), strings.shape[1], equal.argmin(axis=1))
        shared[1:] = np.where(groups[order[1:]] == groups[order[:-1]], lengths, -1)
    return shared


def repeated_strings(groups: np.ndarray, anchors: np.ndarray, contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two tables (record, distance): whether the string that starts ``distance`` bytes before the anchor is
    a record's own and found twice in its group; and whether it is the first of its equals.
    """
    size = len(contexts)
    right = np.zeros((size, LENGTH), np.uint8)
    left = np.zeros((size, -(-_REACH // 8) * 8), np.uint8)
    for number, (anchor, context) in enumerate(zip(anchors.tolist(), contexts)):
        right[number, : len(context) - anchor] = np.frombuffer(context, np.uint8, offset=anchor)
        if anchor:
            left[number, :anchor] = np.frombuffer(context, np.uint8, anchor)[::-1]
    by_right = multikey_order(groups, right.view(">u8"))
    by_left = multikey_order(groups, left.view(">u8"))
    share_right, share_left = shared_lengths(by_right, groups, right), shared_lengths(by_left, groups, left)
    nearest = anchors - (np.array([len(c) for c in contexts]) - LENGTH)
    twice = np.zeros((size, _REACH + 1), bool)
    first = np.zeros((size, _REACH + 1), bool)
    class_right, class_left = np.empty(size, np.int64), np.empty(size, np.int64)
    for distance in range(int(nearest.min()), int(anchors.max()) + 1):
        own = np.flatnonzero((nearest <= distance) & (distance <= anchors))
        class_right[by_right] = np.cumsum(share_right < LENGTH - distance)
        class_left[by_left] = np.cumsum(share_left < distance)
        key = class_right[own] * (size + 1) + class_left[own]
        sorted_ = np.argsort(key, kind="stable")
        same = key[sorted_][1:] == key[sorted_][:-1]
        first[own[sorted_], distance] = np.concatenate(([True], ~same))
        twice[own[sorted_], distance] = np.concatenate(([False], same)) | np.append(same, False)
    return twice, first


def _bucket(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Repeated byte ranges of a bucket, and digests of the strings in groups that may go on in another one."""
    from xxhash import xxh3_128_digest

    waiting: list[dict] = []
    cut = True  # whether the first group may have begun earlier

    def solve(records: list[dict], first_open: bool, last_open: bool) -> pa.RecordBatch:
        hashes = np.array([r["hash"] for r in records])
        groups = np.cumsum(np.concatenate(([0], np.diff(hashes) != 0)))
        counts = np.bincount(groups)
        open_group = np.zeros(len(counts), bool)
        open_group[0], open_group[-1] = first_open, open_group[-1] | last_open
        if first_open:
            open_group[0] = True
        keep = np.flatnonzero((counts[groups] > 1) | open_group[groups])
        if not len(keep):
            return _batch([], _FOUND)
        records = [records[k] for k in keep]
        groups = groups[keep]
        anchors = np.array([r["anchor"] for r in records])
        twice, first = repeated_strings(groups, anchors, [r["context"] for r in records])
        rows: list[tuple] = []
        marks = np.zeros((len(records), _REACH + 3), np.int8)
        marks[:, 1:-1] = twice
        steps = np.diff(marks, axis=1)
        for number, near, far in zip(*np.nonzero(steps == 1), np.nonzero(steps == -1)[1]):
            r = records[number]
            at = r["start"] + r["anchor"]
            rows.append((r["row"], int(at - far + 1), int(at - near + LENGTH), None, None, None, None))
        packed: dict[int, tuple[list, list, list]] = {}
        for number, distance in zip(*(x.tolist() for x in np.nonzero(first & open_group[groups][:, None]))):
            r = records[number]
            begin = r["anchor"] - distance
            digest = xxh3_128_digest(r["context"][begin : begin + LENGTH])
            digests, in_rows, starts = packed.setdefault(int.from_bytes(digest[:4], "little") % parts, ([], [], []))
            digests.append(digest)
            in_rows.append(r["row"])
            starts.append(r["start"] + begin)
        for part, (digests, in_rows, starts) in packed.items():
            rows.append((None, None, None, part, b"".join(digests), np.array(in_rows).tobytes(), np.array(starts).tobytes()))
        return _batch(rows, _FOUND)

    for batch in batches:
        waiting.extend(batch.to_pylist())
        while len(waiting) >= _CHUNK_RECORDS:
            end = _CHUNK_RECORDS
            while end > 1 and waiting[end - 1]["hash"] == waiting[_CHUNK_RECORDS - 1]["hash"]:
                end -= 1
            split = end <= 1  # one group fills the chunk: its parts meet again by digest
            end = _CHUNK_RECORDS if split else end
            yield solve(waiting[:end], cut, split)
            waiting, cut = waiting[end:], split
    if waiting:
        yield solve(waiting, cut, True)


def _across(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
    """Strings of bucket ends that were found in several places."""
    digests = np.frombuffer(b"".join(rows["digests"]), "S16").view("<u8").reshape(-1, 2)
    in_rows = np.frombuffer(b"".join(rows["rows"]), np.int64)
    starts = np.frombuffer(b"".join(rows["starts"]), np.int64)
    order = np.lexsort((starts, in_rows, digests[:, 1], digests[:, 0]))
    digests, in_rows, starts = digests[order], in_rows[order], starts[order]
    equal = (digests[1:] == digests[:-1]).all(axis=1)
    twice = np.concatenate(([False], equal)) | np.append(equal, False)
    return pd.DataFrame({"row": in_rows[twice], "start": starts[twice], "stop": starts[twice] + LENGTH})


# ---- the operator ---------------------------------------------------------------------------


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """(row, start, stop): byte ranges that together are all that is repeated, for texts (__row, __text).

    Copies of a whole text are found by their digest and give one range each; of other texts, every
    string of LENGTH bytes that starts in two places is covered.
    """
    spark = texts.sparkSession
    sized = texts.select(F.col("__row").alias("row"), F.octet_length("__text").cast("long").alias("stop"), F.sha2(F.col("__text").cast("binary"), 256).alias("digest"))
    sized = sized.filter(F.col("stop") >= LENGTH)
    copied = sized.groupBy("digest").count().filter("count > 1").select("digest")
    copies = sized.join(copied, "digest").select("row", F.lit(0).cast("long").alias("start"), "stop")
    bitmap, bits = repeated_leads(texts)
    shared = spark.sparkContext.broadcast(bitmap)
    records = written(texts.mapInArrow(lambda b: _records(b, shared.value, bits), _RECORDS), "suffix-records")
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["lead", "hash", "salt"]
    buckets = records.filter("context IS NOT NULL").repartitionByRange(*keys).sortWithinPartitions(*keys)
    found = written(buckets.mapInArrow(lambda b: _bucket(b, parts), _FOUND), "suffix-found")
    across = found.filter("part IS NOT NULL").groupBy("part").applyInPandas(_across, "row long, start long, stop long")
    alone = [x.select("row", "start", "stop") for x in (records.filter("context IS NULL"), found.filter("row IS NOT NULL"), across)]
    return copies.unionByName(alone[0]).unionByName(alone[1]).unionByName(alone[2])


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def with_ranges(docs: DataFrame, text: str = "text", into: str = "__ranges") -> DataFrame:
    """All rows with ``into``, their repeated byte ranges (null without any).

    ``docs`` must give its rows in the same order at every reading, as a stored table does.
    """
    row = fresh(docs, "__row")
    placed = docs.withColumn(row, F.monotonically_increasing_id())
    ranges = repeated_ranges(placed.select(F.col(row).alias("__row"), F.col(text).alias("__text")))
    lists = ranges.groupBy(F.col("row").alias(row)).agg(F.collect_set(F.struct("start", "stop")).alias(into))
    return placed.join(lists, row, "left").drop(row)


def cut(text: bytes, ranges: list[dict] | None) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text, and the removed runs."""
    gone = merged([(r["start"], r["stop"]) for r in ranges or ()])
    ends = [0, *(stop for _, stop in gone)]
    begins = [*(start for start, _ in gone), len(text)]
    return b"".join(text[a:b] for a, b in zip(ends, begins)), gone


def remove_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents without the bytes of any string of LENGTH bytes that starts in two places.

    Every occurrence goes, the first one too. Bytes of a character that was cut are dropped. All rows
    and columns stay, a text may become empty, a null text stays null, ``n_chars`` follows where there
    is one. Repeated rows are copies of each other, so texts of LENGTH bytes or more become empty.
    """
    schema, held = fields(docs), fresh(docs, "__ranges")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [
                None if old is None else cut(new, ranges)[0].decode(errors="ignore") if ranges else old
                for old, new, ranges in zip(batch.column(text).to_pylist(), utf8(batch.column(text)), batch.column(held).to_pylist())
            ]
            columns = {name: batch.column(name) for name in schema.names} | {text: pa.array(left, pa.string())}
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([len(t or "") for t in left], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return with_ranges(docs, text, held).mapInArrow(write, schema)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document, and a digest of what is left."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, ranges in zip(utf8(batch.column("text")), batch.column("__ranges").to_pylist()):
                left, gone = cut(text, ranges)
                rows.append((len(text), len(text) - len(left), len(gone), hashlib.sha256(left).hexdigest()))
            columns = list(zip(*rows)) or [()] * 4
            added = [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *added], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = with_ranges(documents(spark, sf_dir).select("doc_id", "text"))
    return found.mapInArrow(measure, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")

"""Exact top-k by inner product over a bit-sliced index.

Vectors are quantised to integers; each block of rows keeps, for every component, the bits of
its values as one bitmap for each binary place (a slice). A query adds its components' multiples
with bitmap arithmetic only: carry-save adders over whole slices leave the sum of every row as
slices again. The best rows are then taken from the most significant slice downward, and rows
that tie at the boundary are settled by their ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from logbrook.llm.common import rank_in
from logbrook.session import written

SCALE = 256
BLOCK_ROWS = 16384
QUERY_ROWS = 64
TOP = 5
EVERY = 50

_INDEX = "block long, width int, ids binary, low binary, bits int, slices binary"
_QUERIES = "width int, query_ids binary, weights binary"
_HITS = "query_id long, vec_id long, score long"


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows as (vec_id, q): quantised vectors that hold no null and no non-finite component."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    quantised = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE))
    return vectors.filter(F.col(key).isNotNull() & x.isNotNull()).filter(finite).select(
        F.col(key).cast("long").alias("vec_id"), quantised.alias("q")
    )


def slices_of(values: np.ndarray, bits: int) -> np.ndarray:
    """Bitmaps of unsigned values (rows, width) as (width, bits, words); bit r of a bitmap is row r."""
    rows, width = values.shape
    words = -(-rows // 64)
    out = np.zeros((width, bits, words * 8), np.uint8)
    for place in range(bits):
        plane = ((values >> np.uint64(place)) & np.uint64(1)).astype(np.uint8)
        packed = np.packbits(plane, axis=0, bitorder="little")
        out[:, place, : packed.shape[0]] = packed.T
    return out.view(np.uint64)


def weighted_sum(slices: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, int]:
    """Slices of the sum over components of weight * value, and what must be added to every row.

    A negative weight adds its size times the bitmap complement (largest value - value); the
    constant makes up for it.
    """
    width, bits, words = slices.shape
    largest = (1 << bits) - 1
    places = (int(np.abs(weights).sum()) * largest).bit_length() + 1
    total = np.zeros((places, words), np.uint64)
    carry = np.zeros((places, words), np.uint64)
    constant = 0
    for component in range(width):
        weight, value = int(weights[component]), slices[component]
        if weight < 0:
            constant += weight * largest
            weight, value = -weight, ~value
        shift = 0
        while weight:
            if weight & 1:
                a, c = total[shift:], carry[shift:]
                both = a & c
                a ^= c
                both[:bits] |= a[:bits] & value
                a[:bits] ^= value
                c[0] = 0
                c[1:] = both[:-1]
            weight >>= 1
            shift += 1
    while carry.any():
        both = total & carry
        total ^= carry
        carry[0] = 0
        carry[1:] = both[:-1]
    return total, constant


def top_rows(total: np.ndarray, allowed: np.ndarray, top: int) -> np.ndarray:
    """Row numbers of the ``top`` largest sums among the allowed rows; ties to smaller row numbers."""
    sure = np.zeros_like(allowed)
    open_ = allowed.copy()
    for plane in total[::-1]:
        ones = open_ & plane
        count = int(np.bitwise_count(sure).sum() + np.bitwise_count(ones).sum())
        if count > top:
            open_ = ones
        else:
            sure |= ones
            open_ &= ~plane
            if count == top:
                open_[:] = 0
                break
    numbers = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
    tied = np.flatnonzero(np.unpackbits(open_.view(np.uint8), bitorder="little"))
    return np.concatenate((numbers, tied[: max(top - len(numbers), 0)]))


def sums_at(total: np.ndarray, rows: np.ndarray) -> list[int]:
    """The sums of single rows, read back from the slices."""
    planes = (total[:, rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)
    return [sum(int(bit) << place for place, bit in enumerate(column)) for column in planes.T]


def _packed_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) blocks of rows with one width, ``size`` rows at most each, in id order."""
    waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
        widths = pc.list_value_length(batch.column("q")).to_numpy(zero_copy_only=False)
        for width in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == width)
            flat = batch.column("q").take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
            parts = waiting.setdefault(width, [])
            parts.append((ids[rows], flat.astype(np.int64).reshape(len(rows), width)))
            while sum(len(p[0]) for p in parts) >= size:
                ids_, matrix = (np.concatenate(x) for x in zip(*parts))
                yield _in_id_order(ids_[:size], matrix[:size])
                parts[:] = [(ids_[size:], matrix[size:])]
    for parts in waiting.values():
        ids_, matrix = (np.concatenate(x) for x in zip(*parts))
        if len(ids_):
            yield _in_id_order(ids_, matrix)


def _in_id_order(ids: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(ids, kind="stable")
    return ids[order], matrix[order]


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Bit-sliced blocks of all rows (vec_id, q), written to shared storage.

    Each scan task cuts its own rows into blocks, so nothing is shuffled. A block covers rows
    of one width; values are stored as their distance from the component's smallest value.
    """

    def pack(batches):
        block = TaskContext.get().partitionId() << 32
        for ids, matrix in _packed_rows(batches, block_rows):
            low = matrix.min(axis=0)
            values = (matrix - low).astype(np.uint64)
            bits = max(int(values.max(initial=0)).bit_length(), 1)
            yield _row(_INDEX, block, matrix.shape[1], ids, low, bits, slices_of(values, bits))
            block += 1

    return written(vectors.mapInArrow(pack, _INDEX), "bitslice-index")


def _row(schema: str, *values) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    plain = [v.tobytes() if isinstance(v, np.ndarray) else v for v in values]
    return pa.RecordBatch.from_pylist([dict(zip(names, plain))], schema=_arrow(schema))


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in schema.split(", "))])


def search(index: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` best rows of every query (vec_id, q): query_id, rank, vec_id, score.

    Score: integer inner product. A query's own id is no candidate of it; ties go to the
    smaller id; a query with fewer candidates of its width returns all of them. Repeated query
    rows give one answer for each id (the first vector in order), repeated candidate rows are
    candidates one by one. Queries meet the index in blocks: each block of up to 64 queries is
    dealt to every index block of its width.
    """

    def pack(batches):
        for ids, matrix in _packed_rows(batches, QUERY_ROWS):
            yield _row(_QUERIES, matrix.shape[1], ids, matrix)

    def answer(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.int64()) for column in zip(*_hits(row, top))] or [pa.array([], pa.int64())] * 3,
                    schema=_arrow(_HITS),
                )

    single = queries.groupBy("vec_id").agg(F.min("q").alias("q"))
    asked = written(single.mapInArrow(pack, _QUERIES), "bitslice-queries")
    pairs = asked.join(F.broadcast(index.select("block", "width")), "width")
    found = pairs.join(index.drop("width"), "block").mapInArrow(answer, _HITS)
    return rank_in(found, ["query_id"], [F.desc("score"), F.asc("vec_id")], top).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def _hits(row: dict, top: int) -> Iterator[tuple[int, int, int]]:
    """(query id, row id, score) of the best rows of one index block, for each query of one query block."""
    width, bits = row["width"], row["bits"]
    ids = np.frombuffer(row["ids"], np.int64)
    low = np.frombuffer(row["low"], np.int64)
    slices = np.frombuffer(row["slices"], np.uint64).reshape(width, bits, -(-len(ids) // 64))
    asked = np.frombuffer(row["query_ids"], np.int64)
    weights = np.frombuffer(row["weights"], np.int64).reshape(len(asked), width)
    for query, weight in zip(asked.tolist(), weights):
        total, constant = weighted_sum(slices, weight)
        allowed = np.zeros(total.shape[1] * 64, np.uint8)
        allowed[: len(ids)] = ids != query
        rows = top_rows(total, np.packbits(allowed, bitorder="little").view(np.uint64), top)
        constant += int(weight @ low)
        for number, score in zip(rows.tolist(), sums_at(total, rows)):
            yield query, int(ids[number]), score + constant


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best rows by inner product for every row whose vec_id is divisible by 50."""
    vectors = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    index = build_index(vectors)
    return search(index, vectors.filter(F.col("vec_id") % EVERY == 0))


OP2_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

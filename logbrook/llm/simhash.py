"""SimHash near-duplicates by a segment-popcount embedding.

The 64 bits of a fingerprint are 32 segments of two bits, and a fingerprint is mapped to its 32
bit counts. The Manhattan distance of two such vectors is at most the number of differing bits, so
a range join under Manhattan distance finds every pair within the bound; pairs it finds are then
verified on all bits. The join's grid: the vector is cut into blocks, and a distance of ``bits``
can touch ``bits`` blocks at most, so at least ``blocks - bits`` blocks of counts agree, and the
pair shares a grid cell for some choice of that many blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from logbrook.llm.common import documents, fields, fresh, utf8
from logbrook.session import written

WORDS = 4
BITS = 4
SEED = 42
GRID_BLOCKS = 7
#: Members of a cell that one comparison group may hold; a larger cell is cut into pairs of parts.
GROUP_ROWS = 4096
_EVEN = 0x5555555555555555


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """SimHash of one text: lower-cased ASCII, word shingles with repeats, XXH64."""
    from xxhash import xxh64_intdigest

    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    size = max(len(tokens) - words + 1, 1)
    last = ends[min(words, len(tokens)) - 1 :].tolist()
    hashes = np.fromiter(
        (xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts[:size].tolist(), last)), np.uint64, size
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, size, 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > size, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns with ``simhash``, the fingerprint's bits as a long. A null text has none set."""
    docs = docs.drop("simhash")
    schema = fields(docs, simhash=T.LongType())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter(map(fingerprint, utf8(batch.column(text))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values.view(np.int64))], names=schema.names)

    return docs.mapInArrow(add, schema)


def counts_code(bits: Column) -> Column:
    """The 32 segment counts in unary, so that the Manhattan distance is the number of differing bits."""
    shifted = F.shiftrightunsigned(bits, 1)
    some = bits.bitwiseOR(shifted).bitwiseAND(F.lit(_EVEN))
    both = bits.bitwiseAND(shifted).bitwiseAND(F.lit(_EVEN))
    return some.bitwiseOR(F.shiftleft(both, 1))


def grid_masks(bits: int = BITS, blocks: int = GRID_BLOCKS) -> list[int]:
    """One mask over the unary counts for each choice of blocks that must agree."""
    edges = [2 * (32 * k // blocks) for k in range(blocks + 1)]
    parts = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    return [sum(chosen) for chosen in combinations(parts, blocks - bits)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def links(prints: DataFrame, bits: int = BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Edges (u, v) that connect all fingerprints (column ``u``, distinct) within ``bits`` bits.

    A group of mutually near fingerprints gives a spanning forest, not all of its pairs. The size
    of every grid cell is counted first; a cell above ``group_rows`` is cut by hash into parts, and
    every pair of parts forms a group of its own, so no task holds a whole hot cell and no pair is lost.
    """
    code = counts_code(F.col("u"))
    cells = prints.select(
        "u",
        F.explode(
            F.array(
                *(
                    F.xxhash64(F.lit(number), code.bitwiseAND(F.lit(_signed(mask)).cast("long")))
                    for number, mask in enumerate(grid_masks(bits))
                )
            )
        ).alias("cell"),
    )
    hot = written(cells.groupBy("cell").count().filter(F.col("count") > group_rows), "simhash-hot-cells")
    parts = F.coalesce(F.ceil(F.col("count") / (group_rows // 2)), F.lit(1)).cast("int")
    mine = F.pmod(F.xxhash64("u", F.lit(1)), F.col("parts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.xxhash64(F.col("cell"), F.least(F.col("mine"), other), F.greatest(F.col("mine"), other)),
    )
    grouped = (
        cells.join(hot, "cell", "left")
        .withColumn("parts", parts)
        .withColumn("mine", mine)
        .select("u", F.explode(pairs).alias("group"))
    )
    sorted_groups = grouped.repartition("group").sortWithinPartitions("group", "u")
    return sorted_groups.mapInArrow(lambda batches: _compare(batches, bits), "u long, v long").distinct()


def _compare(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Spanning edges of each run of equal groups; a run may go on in the next batch."""
    group, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        group = np.concatenate((group, batch.column("group").to_numpy(zero_copy_only=False)))
        prints = np.concatenate((prints, batch.column("u").to_numpy(zero_copy_only=False).view(np.uint64)))
        whole = int(np.searchsorted(group == group[-1], True)) if len(group) else 0
        if whole:
            yield _edges(group[:whole], prints[:whole], bits)
            group, prints = group[whole:], prints[whole:]
    if len(group):
        yield _edges(group, prints, bits)


def _edges(group: np.ndarray, prints: np.ndarray, bits: int) -> pa.RecordBatch:
    size = len(group)
    begins = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    lengths = np.diff(np.append(begins, size))
    ends = np.repeat(begins + lengths, lengths)
    some = (prints | (prints >> np.uint64(1))) & np.uint64(_EVEN)
    code = some | ((prints & (prints >> np.uint64(1)) & np.uint64(_EVEN)) << np.uint64(1))
    parent = np.arange(size)
    at = np.arange(size)
    for shift in range(1, int(lengths.max(initial=1))):
        at = at[at + shift < ends[at]]
        near = at[np.bitwise_count(code[at] ^ code[at + shift]) <= bits]
        near = near[np.bitwise_count(prints[near] ^ prints[near + shift]) <= bits]
        join(parent, near, near + shift)
    root = roots(parent, np.arange(size))
    linked = np.flatnonzero(root != np.arange(size))
    return pa.RecordBatch.from_arrays(
        [pa.array(prints[linked].view(np.int64)), pa.array(prints[root[linked]].view(np.int64))], names=["u", "v"]
    )


def roots(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    found = parent[at]
    while not np.array_equal(above := parent[found], found):
        found = above
    return found


def join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Make each a[i] and b[i] share a root, the smaller one."""
    while len(a):
        a, b = roots(parent, a), roots(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def components(edges: DataFrame) -> DataFrame | None:
    """(node, root) for every node of the edges (u, v), or None without edges.

    Rounds of hooking and contraction: each node points to its smallest neighbour, pointers are
    followed twice, and edges move to the nodes pointed to. Each round at least halves the nodes of
    a component. Every round is a written table.
    """
    edges, found = written(edges, "simhash-edges"), None
    while edges.take(1):
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooked = both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("root"))
        hooked = written(hooked, "simhash-hooks")
        for _ in range(2):
            above = hooked.select(F.col("node").alias("root"), F.col("root").alias("above"))
            hooked = hooked.join(above, "root").select("node", F.col("above").alias("root"))
        hooked = written(hooked, "simhash-roots")
        step = hooked.select(F.col("node").alias("root"), F.col("root").alias("next"))
        if found is None:
            found = hooked
        else:
            moved = found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            found = written(moved, "simhash-found")
        for end in ("u", "v"):
            edges = edges.join(hooked.select(F.col("node").alias(end), F.col("root").alias("to")), end).drop(end).withColumnRenamed("to", end)
        edges = written(edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "simhash-edges")
    return found


def group_fingerprints(prints: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """(simhash, component): the smallest ``key`` among all rows whose fingerprints are linked, near by near."""
    distinct = written(prints.groupBy("simhash").agg(F.min(key).alias("first")), "simhash-distinct")
    found = components(links(distinct.select(F.col("simhash").alias("u")), bits))
    if found is None:
        return distinct.withColumnRenamed("first", "component")
    rooted = distinct.join(found.withColumnRenamed("node", "simhash"), "simhash", "left").withColumn(
        "root", F.coalesce("root", "simhash")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    return rooted.join(smallest, "root").select("simhash", "component")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """One row (key, simhash, component) for each document.

    ``component`` is the smallest key that can be reached over links. Empty and null texts have
    fingerprint zero and link like any other; equal texts share a fingerprint and so a component,
    without pairs. Null keys never name a component unless all of its keys are null. Fingerprints
    are computed once and written as a thin table; texts are never shuffled.
    """
    thin = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    prints = written(with_fingerprint(thin, "__text").select("__key", "simhash"), "simhash-prints")
    return prints.join(group_fingerprints(prints, "__key", bits), "simhash").select(
        F.col("__key").alias(key), "simhash", "component"
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """Documents with one row of each component left, the first in (key, place in the input) order.

    ``docs`` must give its rows in the same order at every reading, as a stored table does.
    """
    place = fresh(docs, "__place")
    placed = docs.withColumn(place, F.monotonically_increasing_id())
    thin = placed.select(F.struct(F.col(key).isNull().alias("null"), F.col(key).alias("key"), F.col(place).alias("place")).alias("row"), F.col(text).alias("__text"))
    prints = written(with_fingerprint(thin, "__text").select("row", "simhash"), "simhash-prints")
    kept = group_fingerprints(prints, "row", bits).select(F.col("component.place").alias(place)).distinct()
    return placed.join(kept, place, "left_semi").drop(place)


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(documents(spark, sf_dir))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )

"""Repair of the turn structure of conversations by a run-length dynamic program.

Every turn is a symbol: the class of its role, with or without a truncated text, or a turn that has to
go. Equal consecutive symbols are one run. A run of length L moves the costs to go over its L turns at
once, through the binary powers of its symbol's min-plus transition (4 by 4, kept for each symbol), and
the cheapest edits are unrolled from the costs behind every run, the least letter first.

Turns are cut into sorted ranges, so that a conversation with many turns lies in several tasks. Only
for conversations that a range border cuts, at most two ranges' ends for each range, do matrices, end
states and start states come to the driver: a few numbers for each partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from logbrook.llm.common import fields
from logbrook.session import written

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
WHITE = " \t\n\x0b\x0c\r"

# States: what the repaired conversation ends in so far.
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: The state behind the one role that may be inserted, or given to a turn.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = (None, "system", "user", "assistant")
#: Classes of roles by their first letter; any other letter is class 3, which cannot be kept.
CLASSES = "sua"
KEPT = {(NONE, 0): SYSTEM, (NONE, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
#: Symbol of a blank or repeated turn; the others are 2 * class, plus 1 if truncated.
GONE = 8
LEGAL = {(0, 1), (1, 2), (2, 1)}
FAULTS = ("", "blank", "duplicate", "truncated")

_FAR = 1 << 60
_LEAF = 64
_SHORT = 64

Vector = tuple[int, ...]


# ---- the dynamic program ----------------------------------------------------------------------


def times(left: tuple[Vector, ...], right: tuple[Vector, ...]) -> tuple[Vector, ...]:
    """Min-plus product of two matrices."""
    columns = list(zip(*right))
    return tuple(tuple(min(_FAR, *map(sum, zip(row, column))) for column in columns) for row in left)


def apply(matrix: tuple[Vector, ...], vector: Vector) -> Vector:
    """Costs to go before something, from the costs to go behind it."""
    return tuple(min(_FAR, *map(sum, zip(row, vector))) for row in matrix)


def _inserting() -> tuple[Vector, ...]:
    """Least cost of insertions from a state to a state."""
    rows = []
    for state in range(4):
        costs, cost = [_FAR] * 4, 0
        while cost < costs[state]:
            costs[state] = cost
            state, cost = NEXT[state], cost + INSERT_COST
        rows.append(tuple(costs))
    return tuple(rows)


INSERTING = _inserting()
IDENTITY = tuple(tuple(0 if p == q else _FAR for q in range(4)) for p in range(4))
#: Costs to go behind the last turn: nothing or whole pairs are right, a pair may be completed.
END = tuple(min(row[NONE], row[ASSISTANT]) for row in INSERTING)


@lru_cache(maxsize=1024)
def power(symbol: int, exponent: int) -> tuple[Vector, ...]:
    """The transition over 2**exponent turns of one symbol."""
    if exponent:
        return times(power(symbol, exponent - 1), power(symbol, exponent - 1))
    turn = []
    for state in range(4):
        costs = [_FAR] * 4
        costs[state] = DELETE_COST
        if symbol != GONE:
            extra = TRUNCATED_COST * (symbol & 1)
            for target, cost in ((KEPT.get((state, symbol >> 1)), extra), (NEXT[state], REROLE_COST + extra)):
                if target is not None:
                    costs[target] = min(costs[target], cost)
        turn.append(tuple(costs))
    return times(INSERTING, tuple(turn))


def over_run(symbol: int, length: int, behind: Vector) -> Vector:
    """Costs to go before a run, from those behind it."""
    for exponent in range(length.bit_length()):
        if length >> exponent & 1:
            behind = apply(power(symbol, exponent), behind)
    return behind


def run_matrix(runs: list[tuple[int, int]]) -> tuple[Vector, ...]:
    """The transition over all runs."""
    product = IDENTITY
    for symbol, length in runs:
        for exponent in range(length.bit_length()):
            if length >> exponent & 1:
                product = times(product, power(symbol, exponent))
    return product


def _choose(symbol: int, state: int, before: Vector, behind: Vector) -> tuple[str, int]:
    """The edits of one turn, the least letter that keeps the cost, and the state behind it."""
    edits = ""
    while True:
        if DELETE_COST + behind[state] == before[state]:
            return edits + DELETE, state
        if INSERT_COST + before[NEXT[state]] == before[state]:
            edits, state = edits + INSERT, NEXT[state]
            continue
        kept = None if symbol == GONE else KEPT.get((state, symbol >> 1))
        if kept is not None and TRUNCATED_COST * (symbol & 1) + behind[kept] == before[state]:
            return edits + KEEP, kept
        return edits + REROLE, NEXT[state]


def _unroll_run(symbol: int, length: int, state: int, behind: Vector) -> Iterator[tuple[str, int]]:
    """The edits of a run's turns and the state behind each; halves keep few costs at a time."""
    if length > _LEAF:
        second = length // 2
        middle = over_run(symbol, second, behind)
        for edits, state in _unroll_run(symbol, length - second, state, middle):
            yield edits, state
        yield from _unroll_run(symbol, second, state, behind)
        return
    costs = [behind]
    for _ in range(length):
        costs.append(apply(power(symbol, 0), costs[-1]))
    for number in range(length, 0, -1):
        edits, state = _choose(symbol, state, costs[number], costs[number - 1])
        yield edits, state


def unroll(runs: tuple[tuple[int, int], ...], state: int, behind: Vector, last: bool) -> tuple[list[str], int]:
    """The edits of every turn of a conversation's segment, and the state at its end.

    Letters before a turn's own are insertions before it. ``behind`` are the costs to go at the
    segment's end; behind the ``last`` segment the insertions that complete a pair follow.
    """
    costs = [behind]
    for symbol, length in reversed(runs):
        costs.append(over_run(symbol, length, costs[-1]))
    edits = []
    for (symbol, length), after in zip(runs, reversed(costs[:-1])):
        for letters, state in _unroll_run(symbol, length, state, after):
            edits.append(letters)
    while last and END[state]:
        edits[-1], state = edits[-1] + INSERT, NEXT[state]
    return edits, state


@lru_cache(maxsize=4096)
def _unroll_short(runs: tuple[tuple[int, int], ...]) -> tuple[list[str], int]:
    """Whole short conversations are often alike."""
    return unroll(runs, NONE, END, True)


# ---- turns in sorted ranges -------------------------------------------------------------------


def staged_turns(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) with a number, their role's class and their own faults, written.

    Nulls in role or text are one space. Other columns are left out.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"))
    shown = F.rtrim(F.col("text"), F.lit(WHITE))
    kind = F.lit(3)
    for number, letter in enumerate(CLASSES):
        kind = F.when(F.substring("role", 1, 1) == letter, number).otherwise(kind)
    return written(
        rows.withColumns(
            {
                "digest": F.sha2("text", 256),
                "kind": kind,
                "blank": shown == "",
                "truncated": ~F.right(shown, F.lit(1)).isin(".", "!", "?"),
                "tie": F.monotonically_increasing_id(),
            }
        ),
        "repair-turns",
    )


_ORDER = ["conv_id", "turn", "role", "digest", "tie"]


def placed_turns(staged: DataFrame) -> DataFrame:
    """Slim rows (no texts) in sorted ranges, with their symbol, range (``part``) and place in it (``seq``).

    A turn is a duplicate if one of the same role and text stands earlier. The first of such equals
    is found by an aggregation with a map-side part, so equal turns never meet in one task.
    """
    slim = staged.drop("text")
    # Nulls first, as in the order of the ranges.
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "tie")
    firsts = slim.groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"))
    flagged = slim.join(firsts.select(F.col("first.tie").alias("tie"), F.lit(True).alias("is_first")), "tie", "left")
    repeated = F.col("is_first").isNull()
    fault = F.when(F.col("blank"), 1).when(repeated, 2).when(F.col("truncated"), 3).otherwise(0)
    symbol = F.when(F.col("blank") | repeated, GONE).otherwise(2 * F.col("kind") + F.col("truncated").cast("int"))
    rows = flagged.select(*_ORDER, "kind", fault.alias("fault"), symbol.alias("symbol"))
    schema = fields(rows, part=T.LongType(), seq=T.LongType())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            seq = np.arange(done, done + batch.num_rows)
            done += batch.num_rows
            columns = [*batch.columns, pa.array(np.full(batch.num_rows, part)), pa.array(seq)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    ranges = rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    return written(ranges.mapInArrow(number, schema), "repair-places")


def _in_order(placed: DataFrame) -> DataFrame:
    return placed.repartition("part").sortWithinPartitions("part", "seq")


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of one range after another."""
    held, number = [], None
    for batch in batches:
        parts = batch.column("part").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
        for low, high in zip(cuts, cuts[1:]):
            if low == high:
                continue
            if held and parts[low] != number:
                yield number, pa.Table.from_batches(held)
                held = []
            number = int(parts[low])
            held.append(batch.slice(low, high - low))
    if held:
        yield number, pa.Table.from_batches(held)


def _segments(rows: pa.Table) -> Iterator[tuple[int | None, int, int, tuple[tuple[int, int], ...]]]:
    """Conversations of a range: conv_id, first row, end, and the runs of equal symbols."""
    conv = rows.column("conv_id")
    null = conv.is_null().to_numpy()
    ids = conv.fill_null(0).to_numpy()
    symbols = rows.column("symbol").to_numpy()
    new_conv = np.concatenate(([True], (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])))
    heads = np.flatnonzero(new_conv | np.concatenate(([True], symbols[1:] != symbols[:-1])))
    lengths = np.diff(np.append(heads, len(ids))).tolist()
    starts = np.flatnonzero(new_conv)
    bounds = np.append(np.searchsorted(heads, starts), len(heads)).tolist()
    head_symbols = symbols[heads].tolist()
    ends = [*starts[1:].tolist(), len(ids)]
    for number, (start, end) in enumerate(zip(starts.tolist(), ends)):
        low, high = bounds[number], bounds[number + 1]
        runs = tuple(zip(head_symbols[low:high], lengths[low:high]))
        yield None if null[start] else int(ids[start]), start, end, runs


def _cut_conversations(placed: DataFrame) -> list[list[tuple[int, int | None, int]]]:
    """Conversations that range borders cut: for each the (part, conv_id, class of the turn before) in order."""
    at = F.struct("seq", "conv_id", "kind")
    ends = placed.groupBy("part").agg(F.min(at).alias("first"), F.max(at).alias("last")).orderBy("part").collect()
    cut = []
    for before, here in zip(ends, ends[1:]):
        if before["last"]["conv_id"] != here["first"]["conv_id"]:
            continue
        if not cut or cut[-1][-1][:2] != (before["part"], before["last"]["conv_id"]):
            cut.append([(before["part"], before["last"]["conv_id"], -1)])
        cut[-1].append((here["part"], here["first"]["conv_id"], before["last"]["kind"]))
    return cut


def _segment_starts(placed: DataFrame) -> dict[tuple[int, int | None], tuple[int, Vector, bool, int]]:
    """For segments of cut conversations: start state, costs to go behind, whether last, class of the turn before."""
    cut = _cut_conversations(placed)
    if not cut:
        return {}
    wanted = [segment[:2] for segments in cut for segment in segments]
    table = placed.sparkSession.createDataFrame(wanted, "part long, _conv long")
    rows = placed.join(F.broadcast(table), "part").filter(F.col("conv_id").eqNullSafe(F.col("_conv")))
    rows = _in_order(rows.select("part", "seq", "conv_id", "symbol"))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, range_rows in _ranges(batches):
            for conv, _, _, runs in _segments(range_rows):
                flat = [cost for row in run_matrix(runs) for cost in row]
                yield pa.RecordBatch.from_pylist([{"part": part, "conv_id": conv, "costs": flat}], schema=kind)

    kind = pa.schema([("part", pa.int64()), ("conv_id", pa.int64()), ("costs", pa.list_(pa.int64()))])
    found = {}
    for row in rows.mapInArrow(matrices, "part long, conv_id long, costs array<long>").collect():
        found[row["part"], row["conv_id"]] = tuple(tuple(row["costs"][i : i + 4]) for i in range(0, 16, 4))
    behind = {}
    for segments in cut:
        costs = END
        for part, conv, _ in reversed(segments):
            behind[part, conv] = costs
            costs = apply(found[part, conv], costs)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, range_rows in _ranges(batches):
            for conv, _, _, runs in _segments(range_rows):
                states = [unroll(runs, state, behind[part, conv], False)[1] for state in range(4)]
                yield pa.RecordBatch.from_pylist([{"part": part, "conv_id": conv, "costs": states}], schema=kind)

    moved = {}
    for row in rows.mapInArrow(ends, "part long, conv_id long, costs array<long>").collect():
        moved[row["part"], row["conv_id"]] = row["costs"]
    starts = {}
    for segments in cut:
        state = NONE
        for number, (part, conv, kind_before) in enumerate(segments):
            starts[part, conv] = (state, behind[part, conv], number == len(segments) - 1, kind_before)
            state = moved[part, conv][state]
    return starts


_EDIT_FIELDS = {
    "edits": T.StringType(),
    "roles": T.ArrayType(T.StringType()),
    "illegal": T.LongType(),
    "cost": T.LongType(),
}


def _edit_rows(rows: pa.Table, part: int, starts: dict) -> tuple[list, list, list, list]:
    kinds, faults, names = rows.column("kind").to_pylist(), rows.column("fault").to_pylist(), rows.column("role").to_pylist()
    edits, roles, illegal, costs = [], [], [], []
    for conv, start, end, runs in _segments(rows):
        state, behind, last, before = starts.get((part, conv), (NONE, END, True, -1))
        if (part, conv) not in starts and len(runs) <= _SHORT and end - start <= _LEAF:
            letters = _unroll_short(runs)[0]
        else:
            letters = unroll(runs, state, behind, last)[0]
        for at, of_turn in enumerate(letters, start):
            given, cost = [], 0
            for edit in of_turn:
                if edit == DELETE:
                    given.append(None)
                    cost += DELETE_COST
                    continue
                cost += INSERT_COST if edit == INSERT else TRUNCATED_COST * (faults[at] == 3)
                if edit == KEEP:
                    state = KEPT[state, kinds[at]]
                    given.append(names[at])
                else:
                    cost += REROLE_COST * (edit == REROLE)
                    state = NEXT[state]
                    given.append(NAMES[state])
            edits.append(of_turn)
            roles.append(given)
            costs.append(cost)
            illegal.append(int(before >= 0 and (before, kinds[at]) not in LEGAL))
            before = kinds[at]
    return edits, roles, illegal, costs


def repair(turns: DataFrame) -> DataFrame:
    """The cheapest edits that give every conversation the form ``(s?(ua)+)?``, one row for each turn.

    ``turns`` has conv_id, turn, role and text. A conversation's turns stand by turn (null first), then
    role, then digest of the text; equal rows are all kept. A null role or text counts as one space, a
    null conv_id is a conversation. A turn is blank, else a duplicate of an earlier (role, text), else
    truncated. Roles count by their first letter; a role of another or no letter cannot be kept.

    Returns conv_id, part, seq (together the order), turn, role, text, fault, ``edits`` (letters of the
    insertions before the turn, its own, and behind the last turn the insertions that complete a
    pair), ``roles`` (the role that each edit leaves, null for a deletion), ``illegal`` (1 if the role does
    not follow the one before) and the edits' cost. Ties of the cost are settled by the least letters.
    No turns give no rows. A task holds the slim rows of its range, never a whole conversation.
    """
    staged = staged_turns(turns)
    placed = placed_turns(staged)
    starts = _segment_starts(placed)
    slim = _in_order(placed.select("part", "seq", "conv_id", "turn", "role", "tie", "kind", "fault", "symbol"))
    schema = fields(slim, **_EDIT_FIELDS)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _ranges(batches):
            for column, values in zip(_EDIT_FIELDS, _edit_rows(rows, part, starts)):
                kind = pa.list_(pa.string()) if column == "roles" else pa.string() if column == "edits" else pa.int64()
                rows = rows.append_column(column, pa.array(values, kind))
            yield from rows.to_batches(max_chunksize=8192)

    edits = written(slim.mapInArrow(edit, schema), "repair-edits")
    name = F.element_at(F.array(*map(F.lit, FAULTS)), F.col("fault") + 1)
    texts = staged.select("tie", "text")
    return edits.join(texts, "tie").withColumn("fault", name).drop("tie", "kind", "symbol")


def repaired_turns(edits: DataFrame) -> DataFrame:
    """The turns of the repaired conversations, from the rows of ``repair``: conv_id, part, seq, number, edit, role, text.

    Their order is that of (part, seq, number).
    """
    letters = F.transform(F.sequence(F.lit(1), F.length("edits")), lambda i: F.substring(F.col("edits"), i, F.lit(1)))
    each = F.posexplode(F.arrays_zip(letters.alias("edit"), F.col("roles").alias("role")))
    rows = edits.select("conv_id", "part", "seq", "text", each.alias("number", "one"))
    empty = F.col("one.edit") == INSERT
    return rows.filter(F.col("one.edit") != DELETE).select(
        "conv_id", "part", "seq", "number", F.col("one.edit").alias("edit"), F.col("one.role").alias("role"),
        F.when(empty, "").otherwise(F.col("text")).alias("text"),
    )


# ---- the query --------------------------------------------------------------------------------


_DIGEST = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
_DIGEST_TYPES = [pa.int64()] * 7 + [pa.string()] * 2
_DIGEST_NAMES = [part.split()[0] for part in _DIGEST.split(", ")]


class _Digest:
    """What the query returns of one conversation, fed turn by turn."""

    def __init__(self, conv: int | None):
        self.conv, self.counts, self.illegal, self.cost = conv, dict.fromkeys(FAULTS, 0), 0, 0
        self.first = self.last = None
        self.turns, self.audit, self.hash, self.begun = 0, [], hashlib.sha256(), False

    def add(self, turn, fault, edits, roles, text, illegal, cost) -> None:
        self.counts[fault] += 1
        self.illegal += illegal
        self.cost += cost
        self.audit.append(edits)
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        for edit, role in zip(edits, roles):
            if edit != DELETE:
                self.hash.update(("\n" if self.begun else "").encode() + f"{role}:{'' if edit == INSERT else text}".encode())
                self.begun = True

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        counts = (self.counts[name] for name in FAULTS[1:])
        return (self.conv, gaps, *counts, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def repair_digests(edits: DataFrame) -> DataFrame:
    """One row for each conversation of ``repair``'s rows: counts, cost, all edits, and a hash of the repaired text.

    A hash is one chain over a conversation's text, so its turns pass one task in order; they are
    streamed, and only the letters of the edits, which the row returns, are held.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("conv_id", "turn", "fault", "edits", "roles", "text", "illegal", "cost")]
            for conv, *turn in zip(*columns):
                if current is None or conv != current.conv:
                    done += [] if current is None else [current.row()]
                    current = _Digest(conv)
                current.add(*turn)
            yield _digest_batch(done)
            done = []
        yield _digest_batch(done if current is None else [*done, current.row()])

    rows = edits.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return rows.mapInArrow(digest, _DIGEST)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_DIGEST_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _DIGEST_TYPES)], names=_DIGEST_NAMES)


def damage(turns: DataFrame) -> DataFrame:
    """The query's damage of turns, by a checksum of conversation and turn; nulls are one space."""

    def known(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    rows = turns.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), kind.alias("_kind"))
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1)))
    return rows.filter(F.col("_kind") != 0).select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("_copy")
    ).drop("_copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = repair_digests(repair(damage(table)))
    ids = table.select(F.col("conv_id").alias("_id")).distinct()
    joined = ids.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    nothing = hashlib.sha256().hexdigest()
    return joined.select(
        F.col("_id").cast("long").alias("conv_id"),
        *(F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in _DIGEST_NAMES[1:7]),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )


_BIT = "CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END"
_CRC = f"""xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(spelled, ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda sum, byte: list_reduce([xor(sum, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda crc, nothing: {_BIT})
    ), 4294967295)"""

OP11_SQL = rf"""
WITH RECURSIVE spelled AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS spelled
  FROM conversations
),
kinds AS (SELECT *, {_CRC} % 20 AS kind FROM spelled),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM kinds WHERE kind <> 0)
),
numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
    substr(role, 1, 1) AS letter
  FROM damaged
),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN pos > min(pos) OVER (PARTITION BY conv, role, text) THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    lag(letter) OVER (PARTITION BY conv ORDER BY pos) || letter AS pair
  FROM numbered
),
inserts(state, added, target, letters, texts) AS (
  VALUES ('', 0, '', '', []), ('s', 0, 's', '', []), ('u', 0, 'u', '', []), ('a', 0, 'a', '', []),
    ('', 1, 'u', 'I', ['user:']), ('s', 1, 'u', 'I', ['user:']), ('u', 1, 'a', 'I', ['assistant:']), ('a', 1, 'u', 'I', ['user:']),
    ('', 2, 'a', 'II', ['user:', 'assistant:']), ('s', 2, 'a', 'II', ['user:', 'assistant:'])
),
best AS (
  SELECT conv, CAST(0 AS BIGINT) AS pos, '' AS state,
    {{'cost': CAST(0 AS BIGINT), 'audit': '', 'texts': CAST([] AS VARCHAR[])}} AS found
  FROM (SELECT DISTINCT conv FROM numbered)
  UNION ALL
  SELECT conv, pos, state, min(found) AS found FROM (
    SELECT b.conv, r.pos, CASE e.edit WHEN 'D' THEN i.target WHEN 'K' THEN r.letter
        ELSE CASE i.target WHEN 'u' THEN 'a' ELSE 'u' END END AS state,
      {{'cost': b.found.cost + 3 * i.added + CASE e.edit WHEN 'D' THEN 4 WHEN 'K' THEN 0 ELSE 3 END
          + CASE WHEN e.edit <> 'D' AND r.fault = 'truncated' THEN 3 ELSE 0 END,
        'audit': b.found.audit || i.letters || e.edit,
        'texts': list_concat(list_concat(b.found.texts, i.texts), CASE e.edit WHEN 'D' THEN []
          WHEN 'K' THEN [r.role || ':' || r.text]
          ELSE [CASE i.target WHEN 'u' THEN 'assistant:' ELSE 'user:' END || r.text] END)}} AS found
    FROM best b JOIN judged r ON r.conv = b.conv AND r.pos = b.pos + 1
      JOIN inserts i ON i.state = b.state CROSS JOIN (VALUES ('D'), ('K'), ('R')) AS e(edit)
    WHERE e.edit = 'D' OR (r.fault NOT IN ('blank', 'duplicate')
      AND (e.edit = 'R' OR r.letter <> '' AND i.target || r.letter IN ('s', 'u', 'su', 'ua', 'au')))
  ) GROUP BY conv, pos, state
),
ended AS (
  SELECT b.conv, min({{'cost': b.found.cost + 3 * i.added, 'audit': b.found.audit || i.letters,
    'texts': list_concat(b.found.texts, i.texts)}}) AS found
  FROM best b JOIN (SELECT conv, max(pos) AS pos FROM numbered GROUP BY conv) n ON n.conv = b.conv AND n.pos = b.pos
    JOIN inserts i ON i.state = b.state AND i.target IN ('', 'a')
  GROUP BY b.conv
),
counted AS (
  SELECT conv, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(found.cost, 0) AS cost,
  coalesce(found.audit, '') AS audit, sha256(coalesce(array_to_string(found.texts, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
  LEFT JOIN (counted c JOIN ended e USING (conv)) ON o.conv_id IS NOT DISTINCT FROM c.conv_id
"""

"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Each source's documents lie in a seeded order on a tape of tokens (words), which is cut into blocks
of equal length. Seats, one block each, go to the sources by highest quotients target / (2 j + 1);
consecutive seats form a shard, so every shard has an integer quota for each source and holds the
mixture. A source's k-th seat takes its k-th block in a seeded block order, and after the last
block the tape starts again; the block's words go to the shard of the seat. So the quotas fix how many
words a source gives: those of its seats, the last one cut where they exceed the target. A source
whose target is too small for a seat gives its target, less than a block. Blocks behind a source's last
seat (a tape's last block is short) go to the shard of that seat.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logbrook.llm.common import broadcast_if_small, documents, fields, fresh, running, utf8, word_count
from logbrook.session import written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
BLOCK_TOKENS = 128
SHARD_SEATS = 8192
SEED = "mix-1"
_CHUNK = 1 << 16


def _numbered(df: DataFrame, size: str, into: str) -> DataFrame:
    """Each row once for every number from 0 below its column ``size``; a large row is dealt out in chunks."""
    chunks = df.filter(F.col(size) > 0).withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.expr(f"({size} - 1) div {_CHUNK}"))))
    dealt = chunks.repartition("__chunk", *df.columns)
    first = F.col("__chunk") * _CHUNK
    last = F.least(F.col(size), first + _CHUNK) - 1
    return dealt.withColumn(into, F.explode(F.sequence(first, last))).drop("__chunk")


def targets(sizes: DataFrame) -> DataFrame:
    """Sources (source, source_size, first) with number, weight and target, written.

    Numbers follow the code points, null last; weights repeat WEIGHTS in that order. All targets
    add up to SHARE of all sizes; none exceeds REPEATS times its source, and what a source cannot
    take is shared by weight among the others. Sources fill up in the order of size by weight; running sums
    of sizes and weights in this order give the level at which the others stand, without rounds.
    """
    ordered = running(
        sizes.withColumn("__null", F.col("source").isNull()).withColumn("__one", F.lit(1).cast("long")),
        ["__null", "source"],
        "__one",
        "mix-sources",
        "number",
    ).drop("__null", "__one")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("number") % len(WEIGHTS) + 1).cast("int"))
    sources = ordered.withColumn("weight", weight).withColumn("most", F.col("source_size") * REPEATS)
    totals = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total, weights = SHARE * (totals["size"] or 0), totals["weight"] or 0
    filling = sources.withColumns({"ratio": F.col("most") / F.col("weight"), "weight": F.col("weight").cast("long")})
    filling = running(filling, ["ratio", "number"], "most", "mix-filling", "full")
    filling = running(filling, ["ratio", "number"], "weight", "mix-weights", "full_weight")
    level = (F.lit(total) - F.col("full")) / (F.lit(weights) - F.col("full_weight"))
    levels = filling.select("ratio", level.alias("level")).filter("ratio > level")
    level = levels.agg(F.min_by("level", "ratio")).first()[0] or 0.0
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.lit(level))
    return written(sources.withColumn("target", target).drop("most"), "mix-targets")


def dealt(sources: DataFrame, block_tokens: int, shard_seats: int = SHARD_SEATS) -> DataFrame:
    """Seats (number, j, shard) of all blocks' worth of the targets, dealt by highest quotients; j counts a source's seats from 0.

    Ties go to the source with the smaller number. ``shard_seats`` consecutive seats form a shard.
    """
    asked = sources.filter("target > 0").select(
        "number", "target", (F.floor(F.col("target") / block_tokens) + 2).alias("most")
    )
    bids = _numbered(asked, "most", "j").select(
        "number", "j", (-F.col("target") / (2 * F.col("j") + 1)).alias("quotient"), F.lit(1).cast("long").alias("one")
    )
    ranked = running(bids, ["quotient", "number"], "one", "mix-seats", "seat")
    in_all = F.lit(round((sources.agg(F.sum("target")).first()[0] or 0) / block_tokens))
    return ranked.filter(F.col("seat") < in_all).select("number", "j", F.expr(f"seat div {shard_seats}").alias("shard"))


def quotas_of(seated: DataFrame) -> DataFrame:
    """Quotas (number, shard, seats) of dealt seats."""
    return seated.groupBy("number", "shard").agg(F.count("*").alias("seats"))


def seats(sources: DataFrame, block_tokens: int, shard_seats: int = SHARD_SEATS) -> DataFrame:
    """Quotas (number, shard, seats) of every source in every shard."""
    return quotas_of(dealt(sources, block_tokens, shard_seats))


def blocks(sources: DataFrame, quotas: DataFrame, block_tokens: int, seed: str) -> DataFrame:
    """(number, block, epoch, taken, j): how many leading tokens of a block the mix takes in each pass over the tape.

    A source's seats, taken in its seeded block order, make up its words; the last is cut to meet the
    target. ``j`` counts a source's blocks in the order taken, through all passes.
    """
    held = quotas.groupBy("number").agg(F.sum("seats").alias("seats"))
    whole, rounded = F.coalesce(F.col("seats"), F.lit(0)) * block_tokens, F.round("target").cast("long")
    seated = F.least(whole, F.greatest(rounded, whole - block_tokens))
    demand = F.least(F.when(whole > 0, seated).otherwise(F.least(rounded, F.lit(block_tokens - 1))), F.col("source_size") * REPEATS)
    demands = broadcast_if_small(written(sources.join(held, "number", "left").select("number", "source_size", demand.alias("demand")), "mix-demands"))
    sized = sources.select("number", F.ceil(F.col("source_size") / block_tokens).alias("n"))
    cut = _numbered(sized, "n", "block").join(demands, "number")
    length = F.least(F.lit(block_tokens).cast("long"), F.col("source_size") - F.col("block") * block_tokens)
    keyed = cut.select(
        "number",
        "block",
        "source_size",
        "demand",
        length.alias("length"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col("number"), F.col("block"))).alias("key"),
    )
    placed = running(keyed, ["number", "key", "block"], "length", "mix-blocks", "place")
    firsts = broadcast_if_small(placed.groupBy("number").agg(F.min("place").alias("__first")))
    before = F.col("place") - F.col("__first") + F.col("epoch") * F.col("source_size")
    # A shorter block, of which a source has one, moves the places behind it by less than a block.
    rank = F.expr(f"(place - __first + {block_tokens - 1}) div {block_tokens}")
    in_pass = F.expr(f"(source_size + {block_tokens - 1}) div {block_tokens}")
    return (
        placed.join(firsts, "number")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1))))
        .withColumn("taken", F.greatest(F.least(F.col("demand") - before, F.col("length")), F.lit(0)))
        .filter("taken > 0")
        .select("number", "block", "epoch", "taken", (rank + F.col("epoch") * in_pass).alias("j"))
    )


def in_shards(taken: DataFrame, seated: DataFrame) -> DataFrame:
    """Blocks with the shard of their seat: a source's j-th block has its j-th seat.

    Blocks behind the last seat have the shard of that seat; a source without seats is in the last shard.
    """
    last = F.lit(seated.agg(F.max("shard")).first()[0] or 0).cast("long")
    ends = broadcast_if_small(seated.groupBy("number").agg(F.max("shard").alias("__end")))
    return (
        taken.join(seated, ["number", "j"], "left")
        .join(ends, "number", "left")
        .withColumn("shard", F.coalesce("shard", "__end", last))
        .drop("j", "__end")
    )


def plan(
    docs: DataFrame, block_tokens: int = BLOCK_TOKENS, seed: str = SEED, shard_seats: int = SHARD_SEATS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, spans, quotas) of a mix of documents (doc_id, text, source).

    rows: __row, doc_id, size, source_size, target; spans: __row, epoch, shard, start, stop, the
    words of a row that a pass takes for a shard; quotas: seats of each source and shard. A null text has no words, null
    sources form one source, repeated rows are rows of their own. ``__row`` is the row's place in
    the input, which must give its rows in the same order at every reading, as a stored table does.
    """
    thin = docs.select(
        F.monotonically_increasing_id().alias("__row"),
        F.col("doc_id"),
        F.col("source"),
        word_count("text").alias("size"),
    ).withColumn("__null", F.col("source").isNull())
    shuffled = thin.withColumn("__key", F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id"))))
    taped = running(shuffled, ["__null", "source", "__key", "doc_id", "size"], "size", "mix-tape").drop("__key", "__null")
    sizes = taped.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("before").alias("first"))
    sources = targets(sizes)
    known = broadcast_if_small(sources.select(F.col("source").alias("__source"), "number", "source_size", "target", "first"))
    rows = taped.join(known, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    begin = F.col("before") - F.col("first")
    parts = rows.filter("size > 0").select(
        "__row",
        "number",
        "size",
        begin.alias("begin"),
        F.explode(F.sequence(F.expr(f"(before - first) div {block_tokens}"), F.expr(f"(before - first + size - 1) div {block_tokens}"))).alias("block"),
    )
    start = F.greatest(F.col("block") * block_tokens - F.col("begin"), F.lit(0))
    stop = F.least(F.col("block") * block_tokens + F.col("taken") - F.col("begin"), F.col("size"))
    seated = written(dealt(sources, block_tokens, shard_seats), "mix-seats-dealt")
    quotas = written(quotas_of(seated), "mix-quotas")
    spans = (
        parts.join(in_shards(blocks(sources, quotas, block_tokens, seed), seated), ["number", "block"])
        .select("__row", "epoch", "shard", start.alias("start"), stop.alias("stop"))
        .filter("start < stop")
    )
    return rows, spans, quotas


def mix_counts(
    docs: DataFrame, block_tokens: int = BLOCK_TOKENS, seed: str = SEED, shard_seats: int = SHARD_SEATS
) -> DataFrame:
    """Every row's size, its source's size, target and seats, and the words the mix takes of it.

    ``shards`` spells the words by shard, as ``shard:words`` joined by commas, empty if none are taken.
    """
    rows, spans, quotas = plan(docs, block_tokens, seed, shard_seats)
    by_shard = spans.groupBy("__row", "shard").agg(F.sum(F.col("stop") - F.col("start")).alias("words"))
    taken = by_shard.groupBy("__row").agg(F.sum("words").alias("taken"), F.array_sort(F.collect_list(F.struct("shard", "words"))).alias("by"))
    seats_of = broadcast_if_small(quotas.groupBy("number").agg(F.sum("seats").alias("source_seats")))
    shards = F.array_join(F.transform("by", lambda s: F.concat_ws(":", s["shard"], s["words"])), ",")
    return rows.join(taken, "__row", "left").join(seats_of, "number", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source",
        F.coalesce("source_seats", F.lit(0)).cast("long").alias("source_seats"), F.coalesce(shards, F.lit("")).alias("shards"),
    )


def mixed_documents(
    docs: DataFrame, block_tokens: int = BLOCK_TOKENS, seed: str = SEED, shard_seats: int = SHARD_SEATS
) -> DataFrame:
    """The mix itself: a row of ``docs`` for each pass and shard that takes words of it, its text cut to these words.

    ``shard`` is added; the rows lie in the order of the shards. White space between words that stay
    neighbours is kept. ``n_chars``, where there is one, follows the text.
    """
    docs = docs.drop("shard")
    _, spans, _ = plan(docs, block_tokens, seed, shard_seats)
    taken = spans.groupBy("__row", "epoch").agg(F.array_sort(F.collect_list(F.struct("shard", "start", "stop"))).alias("spans"))
    row, held, tie = (fresh(docs, name) for name in ("__row", "__spans", "__tie"))
    taken = taken.select(F.col("__row").alias(row), F.col("spans").alias(held))
    joined = docs.withColumn(row, F.monotonically_increasing_id()).join(taken, row).drop(row)
    schema = fields(docs, shard=T.LongType())
    word = re.compile(rb"[^\x20\x09-\x0D]+")

    def cut(text: bytes, spans: list[dict]) -> Iterator[tuple[int, str]]:
        places = [m.span() for m in word.finditer(text)]
        shards: dict[int, list[list[int]]] = {}
        for span in spans:
            runs = shards.setdefault(span["shard"], [])
            if runs and runs[-1][1] == span["start"]:
                runs[-1][1] = span["stop"]
            else:
                runs.append([span["start"], span["stop"]])
        for shard, runs in shards.items():
            if runs == [[0, len(places)]]:
                yield shard, text.decode()
            else:
                yield shard, b"\n".join(text[places[a][0] : places[b - 1][1]] for a, b in runs).decode()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (at, shard, cut_text)
                for at, (t, s) in enumerate(zip(utf8(batch.column("text")), batch.column(held).to_pylist()))
                for shard, cut_text in cut(t, s)
            ]
            rows, shards, texts = zip(*found) if found else ((), (), ())
            at = pa.array(rows, pa.int64())
            columns = {name: batch.column(name).take(at) for name in schema.names if name not in ("text", "shard")}
            columns |= {"text": pa.array(texts, pa.string()), "shard": pa.array(shards, pa.int64())}
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([len(t) for t in texts], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays([columns[name] for name in schema.names], names=schema.names)

    keys = ["shard", tie]
    texts = written(joined.mapInArrow(write, schema), "mix-texts").withColumn(tie, F.monotonically_increasing_id())
    return texts.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(tie)


OP5_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(concat_ws(':', '{SEED}', doc_id)) AS k
  FROM documents
),
tape AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size, r ROWS UNBOUNDED PRECEDING) - size AS begin FROM docs
),
sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
  FROM docs GROUP BY source
),
weighted AS (SELECT *, [5, 2, 1][number % 3 + 1] AS weight, {REPEATS} * source_size AS most FROM sizes),
levels AS (
  SELECT most / weight AS ratio,
    ({SHARE} * (SELECT sum(source_size) FROM sizes) - (sum(most) OVER filling - most)) / (sum(weight) OVER () - sum(weight) OVER filling + weight) AS level
  FROM weighted WINDOW filling AS (ORDER BY most / weight, number ROWS UNBOUNDED PRECEDING)
),
targets AS (
  SELECT *, least(CAST(most AS DOUBLE), weight * (SELECT arg_min(level, ratio) FROM levels WHERE ratio > level)) AS target FROM weighted
),
bids AS (
  SELECT number, j, row_number() OVER (ORDER BY -target / (2 * j + 1), number) - 1 AS seat
  FROM (SELECT number, target, unnest(range(CAST(floor(target / {BLOCK_TOKENS}) AS BIGINT) + 2)) AS j FROM targets WHERE target > 0)
),
seated AS (
  SELECT number, j, seat // {SHARD_SEATS} AS shard FROM bids WHERE seat < (SELECT round(sum(target) / {BLOCK_TOKENS}) FROM targets)
),
quotas AS (SELECT number, count(*) AS seats, max(shard) AS last_shard FROM seated GROUP BY number),
demands AS (
  SELECT t.*, seats, last_shard, least(most, CASE WHEN seats > 0
    THEN least(seats * {BLOCK_TOKENS}, greatest(CAST(round(target) AS BIGINT), (seats - 1) * {BLOCK_TOKENS}))
    ELSE least(CAST(round(target) AS BIGINT), {BLOCK_TOKENS - 1}) END) AS demand
  FROM targets t LEFT JOIN quotas USING (number)
),
cut AS (
  SELECT *, least({BLOCK_TOKENS}, source_size - block * {BLOCK_TOKENS}) AS length
  FROM (SELECT *, unnest(range(CAST(ceil(source_size / {BLOCK_TOKENS}) AS BIGINT))) AS block FROM demands)
),
placed AS (
  SELECT *, sum(length) OVER (PARTITION BY number ORDER BY md5(concat_ws(':', '{SEED}', number, block)), block
    ROWS UNBOUNDED PRECEDING) - length AS place FROM cut
),
takes AS (
  SELECT number, block, last_shard, greatest(least(demand - place - epoch * source_size, length), 0) AS taken,
    CAST((place + {BLOCK_TOKENS - 1}) // {BLOCK_TOKENS} + epoch * ((source_size + {BLOCK_TOKENS - 1}) // {BLOCK_TOKENS}) AS BIGINT) AS j
  FROM placed, (SELECT unnest(range({REPEATS})) AS epoch)
),
sharded AS (
  SELECT b.number, b.block, b.taken, coalesce(s.shard, b.last_shard, (SELECT max(shard) FROM seated), 0) AS shard
  FROM takes b LEFT JOIN seated s ON s.number = b.number AND s.j = b.j WHERE b.taken > 0
),
parts AS (
  SELECT t.r, b.shard,
    sum(least(b.block * {BLOCK_TOKENS} + b.taken, t.begin + t.size) - greatest(b.block * {BLOCK_TOKENS}, t.begin)) AS words
  FROM tape t JOIN targets s ON t.source IS NOT DISTINCT FROM s.source
  JOIN sharded b ON b.number = s.number AND b.block BETWEEN t.begin // {BLOCK_TOKENS} AND (t.begin + t.size - 1) // {BLOCK_TOKENS}
  WHERE t.size > 0 AND least(b.block * {BLOCK_TOKENS} + b.taken, t.begin + t.size) > greatest(b.block * {BLOCK_TOKENS}, t.begin)
  GROUP BY t.r, b.shard
),
met AS (
  SELECT r, sum(words) AS taken, string_agg(shard || ':' || CAST(words AS BIGINT), ',' ORDER BY shard) AS shards FROM parts GROUP BY r
)
SELECT doc_id, size, source_size, target, CAST(coalesce(o.taken, 0) AS BIGINT) AS taken, t.source AS source,
  CAST(coalesce(s.seats, 0) AS BIGINT) AS source_seats, coalesce(o.shards, '') AS shards
FROM tape t JOIN demands s ON t.source IS NOT DISTINCT FROM s.source LEFT JOIN met o USING (r)
"""


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mix_counts(documents(spark, sf_dir))

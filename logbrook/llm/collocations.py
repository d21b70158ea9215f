"""Collocations by best-first branch-and-bound growth of phrases from their prefixes.

A phrase grows word by word from its first word. The cut behind the first word bounds the score of
everything that grows from it: the count of a whole phrase is at most that of its rest, so no score passes
1000 * n / f(first word). Words are the roots of the search and are opened best bound first, an octave
of bounds in each round; prefixes found in a round are opened in the next one. Whatever is bounded below
a language's 2000th best surviving score so far is cut off, and the search ends when nothing open is left.

Texts are read twice, to count words and to write them as codes: 64-bit hashes of frequent words, with
zeros where a phrase cannot pass. A round is two passes over the codes: one counts the continuations of
all open prefixes, one the rests of the new phrases; before the first, hashes of the continuations are
counted in small tables, so that only such are shuffled as may be frequent. Tasks know what to count by
bitmaps of fixed greatest size; what they let through in vain is dropped by a join. Counts are exact: two
words of one code would be noticed, and all words are given other codes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from xxhash import xxh64_intdigest

from logbrook.llm.common import arrow_rows, documents, utf8
from logbrook.session import written

LEAST = 100
LONGEST = 5
TOP = 2000
#: Words opened in one round have counts within this factor.
OCTAVE = 8

#: The bitmap has 16 bits for each prefix, up to this many (32 MB); a fuller one only lets more through.
_BITS = 1 << 28
_SEGMENT_BITS = 1 << 16
#: Places of a task's table of shared counts.
_PLACES = 1 << 24
_CHUNK = 1 << 20
_DISTINCT = 1 << 17
_POSITIONS = 1 << 18
#: Texts or rows of codes that are passed to Python at a time.
_ARROW_ROWS = 1000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

# A-Z to a-z; ends of pieces to full stops, which no word can hold, set apart by spaces.
_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = _LOWER.translate(bytes.maketrans(_ENDS + b"\t", b"." * len(_ENDS) + b" "))

KEY = ["lang", "k", "w1", "w2", "w3", "w4", "w5"]
_FOUND = "lang string, k int, w1 long, w2 long, w3 long, w4 long, w5 long, a long, firsts array<long>, score long, l long, r long, survives boolean"
_COUNTED = "lang string, k int, w1 long, w2 long, w3 long, w4 long, w5 long, a long, low_left long, high_left long, low_right long, high_right long"


# ---- words and codes ----------------------------------------------------------------------------


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text and a full stop for each end of a piece, in lists of at most about a megabyte."""
    begin, blanks = 0, b" \t\n\x0b\x0c\r"
    while begin < len(text):
        end = min(begin + _CHUNK, len(text))
        while end < len(text) and text[end] not in blanks:
            end += 1
        yield text[begin:end].translate(_TABLE).replace(b".", b" . ").split(b" ")
        begin = end


def _langs(batch: pa.RecordBatch) -> list[str]:
    return ["und" if lang is None else lang for lang in batch.column("lang").to_pylist()]


def codes_of(words: list[bytes], seed: int) -> np.ndarray:
    """A code for each word, never 0 or -1."""
    hashes = (xxh64_intdigest(word, seed) for word in words)
    return np.array([h if 0 < h < (1 << 64) - 1 else 1 for h in hashes], np.uint64).view(np.int64)


def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, code, a): all words of all texts. A task passes its counts on when it holds 131,072."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(_langs(batch), utf8(batch.column("text"))):
                found = held.setdefault(lang, Counter())
                for words in tokens(text):
                    found.update(words)
                    if len(found) > _DISTINCT:
                        yield emit(held)
            if sum(map(len, held.values())) > _DISTINCT:
                yield emit(held)
        yield emit(held)

    def emit(held: dict[str, Counter]) -> pa.RecordBatch:
        langs, words, counts = [], [], []
        for lang, found in held.items():
            found.pop(b".", None)
            found.pop(b"", None)
            langs += [lang] * len(found)
            words += found.keys()
            counts += found.values()
            found.clear()
        columns = [
            pa.array(langs, pa.string()),
            pa.array(words, pa.binary()).cast(pa.string()),
            pa.array(codes_of(words, seed)),
            pa.array(counts, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "word", "code", "a"])

    parts = docs.select("lang", "text").mapInArrow(count, "lang string, word string, code long, a long")
    return parts.groupBy("lang", "word", "code").agg(F.sum("a").alias("a"))


def coded_words(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame, int]:
    """Frequent words (lang, word, code, a), all word occurrences by language (lang, n), and the codes' seed."""
    for seed in range(42, 52):
        words = written(count_words(docs, seed), "collocation-words")
        shared = words.groupBy("lang", "code").agg(F.count("*").alias("words"), F.max("a").alias("most"))
        if shared.filter((F.col("words") > 1) & (F.col("most") >= least)).isEmpty():
            totals = written(words.groupBy("lang").agg(F.sum("a").alias("n")), "collocation-totals")
            return words.filter(F.col("a") >= least), totals, seed
    raise RuntimeError("words share codes under every seed")


def mixed(values: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values."""
    values = values ^ (values >> np.uint64(32))
    values = values * _MULTIPLIER
    return values ^ (values >> np.uint64(29))


def lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxh64_intdigest(lang.encode(), 7))


def prefix_hashes(hashes: np.ndarray, codes: list[np.ndarray]) -> np.ndarray:
    """Hashes, such as those of the language, carried on over a sequence of codes, given by position."""
    for code in codes:
        hashes = mixed(hashes * _MULTIPLIER + code.view(np.uint64))
    return hashes


Bitmap = tuple[np.ndarray, int]


def bitmap_of(prefixes: DataFrame) -> tuple[Bitmap, Bitmap]:
    """Bitmaps of the hashes of prefixes (lang, k, w1 to w4) and of all that they begin with, themselves included.

    Each has at most 32 MB, whatever the number of prefixes.
    """
    bits = min(max(1 << (16 * prefixes.count()).bit_length(), _SEGMENT_BITS), _BITS)
    segments = bits // _SEGMENT_BITS

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ends, paths = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for (lang, k), rows in frame.groupby(["lang", "k"]):
                hashes = np.full(len(rows), lang_hash(lang))
                for i in range(1, k + 1):
                    hashes = prefix_hashes(hashes, [rows[f"w{i}"].to_numpy(np.int64)])
                    paths.append(hashes)
                ends.append(hashes)
            for first, found in ((0, ends), (segments, paths)):
                bit = np.unique((np.concatenate(found) & np.uint64(bits - 1)).astype(np.int64))
                yield pd.DataFrame({"segment": first + bit // _SEGMENT_BITS, "bit": bit % _SEGMENT_BITS})

    def segment(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        plane = np.zeros(_SEGMENT_BITS, np.uint8)
        plane[rows["bit"].to_numpy()] = 1
        return pd.DataFrame({"segment": [key[0]], "plane": [np.packbits(plane, bitorder="little").tobytes()]})

    places = prefixes.select(*KEY[:-1]).mapInPandas(place, "segment long, bit long").distinct()
    whole, _ = _filled(places.groupBy("segment").applyInPandas(segment, "segment long, plane binary"), 2 * bits)
    return (whole[: bits // 8], bits), (whole[bits // 8 :], bits)


def _filled(segments: DataFrame, bits: int) -> Bitmap:
    """A bitmap from its segments; at most ``bits`` come to the driver."""
    filled = np.zeros(bits // 8, np.uint8)
    size = _SEGMENT_BITS // 8
    for row in segments.collect():
        filled[row["segment"] * size : (row["segment"] + 1) * size] = np.frombuffer(row["plane"], np.uint8)
    return filled, bits


def marked(bitmap: Bitmap, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(bitmap[1] - 1)
    return (bitmap[0][(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def encoded(docs: DataFrame, frequent: DataFrame, seed: int) -> DataFrame:
    """(lang, codes): the codes of every text as little-endian 64-bit numbers, zero where no phrase can pass."""
    codes = frequent.select("lang", F.lit(1).alias("k"), F.col("code").alias("w1"), *(F.lit(0).cast("long").alias(f"w{i}") for i in range(2, 5)))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap_of(codes)[0])

    def learn(table: dict[bytes, int], lang: str, words: list[bytes]) -> None:
        if len(table) > _DISTINCT:
            table.clear()
        table[b"."], table[b""] = 0, -1
        new = [word for word in set(words) if word not in table]
        values = codes_of(new, seed)
        often = marked(shared.value, prefix_hashes(np.full(len(new), lang_hash(lang)), [values]))
        table.update(zip(new, np.where(often, values, 0).tolist()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, dict[bytes, int]] = {}
        for batch in batches:
            langs, rows, size = [], [], 0
            for lang, text in zip(_langs(batch), utf8(batch.column("text"))):
                table, found = tables.setdefault(lang, {}), [np.zeros(1, np.int64)]
                for words in tokens(text):
                    learn(table, lang, words)
                    row = np.fromiter(map(table.__getitem__, words), np.int64, len(words))
                    found.append(row[row != -1])
                row = np.concatenate(found)
                langs.append(lang)
                rows.append(row[(row != 0) | np.append(True, row[:-1] != 0)].tobytes())
                size += len(rows[-1])
                if size > _CHUNK:
                    yield coded(langs, rows)
                    langs, rows, size = [], [], 0
            if sum(map(len, tables.values())) > 2 * _DISTINCT:
                tables.clear()
            yield coded(langs, rows)

    def coded(langs: list[str], rows: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(rows, pa.binary())], names=["lang", "codes"])

    return docs.select("lang", "text").mapInArrow(encode, "lang string, codes binary")


# ---- passes over the codes ----------------------------------------------------------------------


def _sequences(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    """The codes of a batch by language, texts set apart by zeros, in stretches with a margin of zeros or neighbours."""
    margin = LONGEST + 1
    ends = np.zeros(margin, np.int64)
    held: dict[str, list[np.ndarray]] = {}
    sizes: Counter = Counter()

    def stretches(lang: str) -> Iterator[tuple[str, np.ndarray]]:
        whole = np.concatenate([ends, *held.pop(lang), ends])
        sizes.pop(lang)
        for begin in range(0, len(whole) - 2 * margin, _POSITIONS):
            yield lang, whole[begin : begin + _POSITIONS + 2 * margin]

    for lang, codes in zip(batch.column("lang").to_pylist(), batch.column("codes")):
        row = np.frombuffer(codes.as_buffer(), np.int64)
        held.setdefault(lang, []).extend((row, ends[:1]))
        sizes[lang] += len(row) + 1
        if sizes[lang] >= _POSITIONS:
            yield from stretches(lang)
    for lang in list(held):
        yield from stretches(lang)


def _phrases(
    lang: str, row: np.ndarray, bitmaps: tuple[Bitmap, Bitmap], lengths: range, growth: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Phrases that begin in a stretch with a marked prefix and are ``growth`` words longer: size, positions, hashes."""
    own = np.arange(LONGEST + 1, len(row) - LONGEST - 1)
    own = own[row[own] != 0]
    hashes = np.full(len(own), lang_hash(lang))
    for k in range(1, lengths.stop):
        # ``own`` holds the positions where k words of a piece stand that lead to a prefix.
        hashes = prefix_hashes(hashes, [row[own + k - 1]])
        led = marked(bitmaps[1], hashes)
        own, hashes = own[led], hashes[led]
        if k in lengths:
            open_ = marked(bitmaps[0], hashes)
            if growth:
                open_ &= row[own + k] != 0
            if open_.any():
                at, found = own[open_], hashes[open_]
                yield k + growth, at, prefix_hashes(found, [row[at + k]]) if growth else found
        longer = row[own + k] != 0
        own, hashes = own[longer], hashes[longer]


def _grouped(lang: str, k: int, words: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    """Counts of equal phrases and the least and greatest code beside them."""
    order = np.argsort(prefix_hashes(np.zeros(len(left), np.uint64), words), kind="stable")
    words = [column[order] for column in words]
    new = reduce(np.logical_or, (column[1:] != column[:-1] for column in words))
    heads = np.flatnonzero(np.concatenate(([True], new)))
    nothing = np.zeros(len(heads), np.int64)
    columns = [
        pa.array([lang] * len(heads), pa.string()),
        pa.array(np.full(len(heads), k, np.int32)),
        *(pa.array(column[heads]) for column in words),
        *(pa.array(nothing) for _ in range(LONGEST - len(words))),
        pa.array(np.diff(np.append(heads, len(order)))),
        *(pa.array(f.reduceat(side[order], heads)) for side in (left, right) for f in (np.minimum, np.maximum)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[part.split()[0] for part in _COUNTED.split(", ")])


def frequent_hashes(codes: DataFrame, shared: Broadcast, lengths: range, growth: int, least: int, occurrences: int) -> Bitmap:
    """A bitmap of the hashes that all phrases of a pass together reach ``least`` times: no other phrase can.

    Tasks count hashes in a table of at most 16 MB, in which several share a place; the tables are
    added up segment by segment. With very many phrases nearly every place is reached, and the
    bitmap lets more through; the counts that follow are exact in any case.
    """
    places = min(max(1 << (occurrences // 4).bit_length(), _SEGMENT_BITS), _PLACES)
    kind = np.uint8 if least <= 255 else np.uint32
    most = np.iinfo(kind).max

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(places, kind)
        for batch in batches:
            for lang, row in _sequences(batch):
                for _, _, hashes in _phrases(lang, row, shared.value, lengths, growth):
                    at, times = np.unique(hashes & np.uint64(places - 1), return_counts=True)
                    at = at.astype(np.int64)
                    table[at] = np.minimum(table[at] + times, most)
        for number in range(places // _SEGMENT_BITS):
            part = table[number * _SEGMENT_BITS : (number + 1) * _SEGMENT_BITS]
            if part.any():
                yield segment_batch(number, part.tobytes())

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total = -1, np.zeros(0, np.int64)
        for batch in batches:
            for segment, part in zip(batch.column("segment").to_pylist(), batch.column("plane")):
                if segment != number:
                    if number >= 0:
                        yield segment_batch(number, np.packbits(total >= least, bitorder="little").tobytes())
                    number, total = segment, np.zeros(_SEGMENT_BITS, np.int64)
                total += np.frombuffer(part.as_buffer(), kind)
        if number >= 0:
            yield segment_batch(number, np.packbits(total >= least, bitorder="little").tobytes())

    parts = codes.mapInArrow(tally, "segment long, plane binary").repartition("segment").sortWithinPartitions("segment")
    return _filled(parts.mapInArrow(add_up, "segment long, plane binary"), places)


def segment_batch(number: int, plane: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([plane], pa.binary())], names=["segment", "plane"])


def counted(codes: DataFrame, prefixes: DataFrame, lengths: range, growth: int, least: int = 1) -> DataFrame:
    """Counts of all phrases that are ``growth`` words longer than one of the prefixes (0: the prefixes themselves).

    Phrases are (lang, k, w1 to w5), padded by zeros; those counted fewer than ``least`` times are left out.
    ``low_left`` to ``high_right`` are the least and greatest code beside an occurrence, zero where no
    frequent word of the piece stands there. The map side adds up stretches of a quarter of a million
    positions. Phrases of other prefixes with a marked hash come too.
    """
    context = codes.sparkSession.sparkContext
    shared = context.broadcast(bitmap_of(prefixes))
    often = None
    if least > 1:
        occurrences = prefixes.agg(F.sum(F.element_at("firsts", -1))).first()[0] or 0
        often = context.broadcast(frequent_hashes(codes, shared, lengths, growth, least, occurrences))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, row in _sequences(batch):
                for size, at, hashes in _phrases(lang, row, shared.value, lengths, growth):
                    if often is not None:
                        at = at[marked(often.value, hashes)]
                    if len(at):
                        yield _grouped(lang, size, [row[at + i] for i in range(size)], row[at - 1], row[at + size])

    parts = codes.mapInArrow(count, _COUNTED)
    sides = [F.min("low_left"), F.max("high_left"), F.min("low_right"), F.max("high_right")]
    names = ["low_left", "high_left", "low_right", "high_right"]
    found = parts.groupBy(*KEY).agg(F.sum("a").alias("a"), *(s.alias(n) for s, n in zip(sides, names)))
    return found.filter(F.col("a") >= least)


# ---- the search ---------------------------------------------------------------------------------


def _decimal(column: Column, digits: int) -> Column:
    return column.cast(f"decimal({digits},0)")


def within_floor(phrases: DataFrame, totals: DataFrame, floors: DataFrame) -> DataFrame:
    """Prefixes from which a phrase of at least their language's floor may grow: 1000 * n / f(first word) reaches it."""
    bound = F.expr("(1000 * cast(n as decimal(17,0))) div cast(firsts[0] as decimal(18,0))")
    rows = phrases.join(totals, "lang").join(floors, "lang", "left")
    return rows.filter(F.col("floor").isNull() | (bound >= F.col("floor"))).select(phrases.columns)


def cut_scores(phrases: DataFrame, rests: DataFrame, totals: DataFrame) -> DataFrame:
    """The phrases with ``score``, ``l`` and ``r`` of their lowest cut. ``firsts`` are the counts of the prefixes.

    ``rests`` has the count (``r``) of every rest, as (lang, w1 to w4). Products are decimals of up to 38 digits.
    """
    words = F.array(*(f"w{i}" for i in range(1, LONGEST + 1)))
    cuts = phrases.select(
        *KEY, "a", F.posexplode("firsts").alias("cut", "l"), words.alias("words")
    ).select(
        *KEY, "a", "cut", "l", *(F.coalesce(F.get("words", F.col("cut") + i), F.lit(0)).alias(f"r{i}") for i in range(1, LONGEST))
    )
    named = rests.select(F.col("lang").alias("_lang"), *(F.col(f"w{i}").alias(f"_w{i}") for i in range(1, LONGEST)), "r")
    same = [F.col("lang") == F.col("_lang"), *(F.col(f"r{i}") == F.col(f"_w{i}") for i in range(1, LONGEST))]
    cuts = cuts.join(named, reduce(lambda a, b: a & b, same)).join(totals, "lang")
    cuts = cuts.withColumns(
        {
            "_up": F.lit(1000).cast("decimal(4,0)") * _decimal(F.col("a"), 15) * _decimal(F.col("n"), 17),
            "_down": _decimal(F.col("l"), 18) * _decimal(F.col("r"), 18),
        }
    )
    cuts = cuts.select(*KEY, F.struct(F.expr("_up div _down").alias("score"), "cut", "l", "r").alias("one"))
    lowest = cuts.groupBy(*KEY).agg(F.min("one").alias("one")).select(*KEY, "one.score", "one.l", "one.r")
    return phrases.join(lowest, KEY)


def _prefix_of(phrases: DataFrame) -> DataFrame:
    """Phrases with the key of their prefix, one word shorter, as p1 to p4."""
    return phrases.withColumns({f"p{i}": F.when(F.col("k") > i, F.col(f"w{i}")).otherwise(F.lit(0)) for i in range(1, LONGEST)})


def _grown(codes: DataFrame, opened: DataFrame, least: int) -> DataFrame:
    """All phrases one word longer than an opened prefix, found at least ``least`` times."""
    found = _prefix_of(counted(codes, opened, range(1, LONGEST), 1, least))
    parents = opened.select("lang", (F.col("k") + 1).alias("k"), *(F.col(f"w{i}").alias(f"p{i}") for i in range(1, LONGEST)), "firsts")
    keys = ["lang", "k", "p1", "p2", "p3", "p4"]
    return found.join(parents, keys).drop("p1", "p2", "p3", "p4")


def _scored(codes: DataFrame, phrases: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """New phrases with their score and whether no longer phrase has the same count."""
    rests = phrases.select("lang", F.posexplode("firsts").alias("cut", "_l"), "k", F.array(*(f"w{i}" for i in range(1, LONGEST + 1))).alias("words"))
    needed = rests.filter(F.col("k") - F.col("cut") > 2).select(
        "lang", (F.col("k") - F.col("cut") - 1).alias("k"),
        *(F.coalesce(F.get("words", F.col("cut") + i), F.lit(0)).alias(f"w{i}") for i in range(1, LONGEST)),
    ).distinct()
    longer = counted(codes, written(needed, "collocation-rests"), range(2, LONGEST), 0)
    single = words.select("lang", F.col("code").alias("w1"), *(F.lit(0).cast("long").alias(f"w{i}") for i in range(2, LONGEST)), F.col("a").alias("r"))
    known = single.unionByName(longer.select("lang", "w1", "w2", "w3", "w4", F.col("a").alias("r")))

    def always_the_same(side: str) -> Column:
        return (F.col(f"low_{side}") == F.col(f"high_{side}")) & (F.col(f"low_{side}") != 0)

    within = (F.col("k") < LONGEST) & (always_the_same("left") | always_the_same("right"))
    scored = cut_scores(phrases, known, totals).withColumn("survives", ~within)
    return scored.select(*KEY, "a", "firsts", "score", "l", "r", "survives")


def _best(found: DataFrame, top: int) -> DataFrame:
    """(lang, floor): each language's ``top``-th best surviving score so far, where there are as many."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"))
    ranked = found.filter("survives").select("lang", "score").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.filter(F.col("rank") == top).select("lang", F.col("score").alias("floor"))


def _roots(words: DataFrame) -> DataFrame:
    nothing = (F.lit(0).cast("long").alias(f"w{i}") for i in range(2, LONGEST + 1))
    return words.select("lang", F.lit(1).alias("k"), F.col("code").alias("w1"), *nothing, F.array("a").alias("firsts"))


def _nodes(scored: DataFrame) -> DataFrame:
    """Phrases as prefixes: their own count joins those of their prefixes."""
    return scored.filter(F.col("k") < LONGEST).select(*KEY, F.array_append("firsts", F.col("a")).alias("firsts"))


def _best_phrases(found: DataFrame, words: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The ``top`` phrases of each language, spelled out. Ties of the last score are all spelled before they are cut."""
    floors = written(_best(found, top), "collocation-floors")
    rows = found.filter("survives").join(floors, "lang", "left")
    rows = rows.filter(F.col("floor").isNull() | (F.col("score") >= F.col("floor")))
    each = rows.select(*KEY, F.posexplode(F.slice(F.array(*(f"w{i}" for i in range(1, LONGEST + 1))), 1, F.col("k"))).alias("at", "code"))
    spelled = each.join(words.select("lang", "code", "word"), ["lang", "code"]).groupBy(*KEY)
    phrases = spelled.agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    phrases = phrases.withColumn("phrase", F.array_join("words.word", " ")).drop("words")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.join(phrases, KEY).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's ``top`` best phrases of 2 to 5 words: lang, rank, phrase, a, l, r, n, score.

    ``docs`` has lang and text; other columns are left out. A null lang is ``und``, a null or empty text
    has no words, equal rows count each. Order: score, then a, descending, then phrase. ``l`` and ``r`` are
    the counts of the parts at the lowest cut (of equal ones the first). No documents give no rows.
    Phrases contained in a longer one of the same count are left out: such a phrase always has the same word
    on one side, so the codes beside its occurrences tell. Every state of the search is a written table;
    only bitmaps of at most 32 MB come to the driver.
    """
    with arrow_rows(docs.sparkSession, _ARROW_ROWS):
        found, words, totals = _search(docs, least, top)
        return _best_phrases(found, words, totals, top)


def _search(docs: DataFrame, least: int, top: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All phrases scored until the search is settled, the frequent words and the totals."""
    words, totals, seed = coded_words(docs, least)
    codes = written(encoded(docs, words, seed), "collocation-codes")
    roots = _roots(words)
    first, counts = F.col("firsts")[0], least
    new = found = docs.sparkSession.createDataFrame([], _FOUND)
    while True:
        floors = written(_best(found, top), "collocation-floors")
        octave = roots.filter((first >= counts) & (first < counts * OCTAVE))
        counts *= OCTAVE
        opened = written(within_floor(octave.unionByName(_nodes(new)), totals, floors), "collocation-open")
        if opened.isEmpty():
            # Later octaves have lower bounds still.
            if within_floor(roots.filter(first >= counts), totals, floors).isEmpty():
                return found, words, totals
            new = found.limit(0)
            continue
        grown = written(_grown(codes, opened, least), "collocation-grown")
        new = written(_scored(codes, grown, words, totals), "collocation-scored")
        found = found.unionByName(new)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of every language of all documents."""
    return collocations(documents(spark, sf_dir))


OP13_SQL = rf"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
),
totals AS MATERIALIZED (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang),
grams AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS a FROM (
    SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces), range(1, {LONGEST + 1}) AS s(k)
    WHERE i + k - 1 <= len(words))
  GROUP BY ALL HAVING count(*) >= {LEAST}
),
phrases AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS words FROM grams WHERE k >= 2),
parts AS MATERIALIZED (
  SELECT lang, phrase, a, cut, array_to_string(words[1:cut], ' ') AS head, array_to_string(words[cut + 1:k], ' ') AS rest
  FROM phrases, range(1, {LONGEST}) AS c(cut) WHERE cut < k
),
cuts AS (
  SELECT p.lang, p.phrase, p.a, t.n, l.a AS l, r.a AS r, p.cut,
    (CAST(1000 AS HUGEINT) * p.a * t.n) // (CAST(l.a AS HUGEINT) * r.a) AS score
  FROM parts p JOIN totals t ON t.lang = p.lang
    JOIN grams l ON l.lang = p.lang AND l.phrase = p.head
    JOIN grams r ON r.lang = p.lang AND r.phrase = p.rest
),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
),
inner_phrases AS (
  SELECT lang, phrase, max(a) AS longest FROM (
    SELECT lang, a, array_to_string(words[i:i + size - 1], ' ') AS phrase
    FROM phrases, range(1, {LONGEST}) AS u(i), range(2, {LONGEST}) AS s(size) WHERE i + size - 1 <= k AND size < k)
  GROUP BY ALL
),
ranked AS (
  SELECT c.lang, c.phrase, c.a, c.l, c.r, c.n, c.score,
    row_number() OVER (PARTITION BY c.lang ORDER BY c.score DESC, c.a DESC, c.phrase) AS rank
  FROM lowest c LEFT JOIN inner_phrases i ON i.lang = c.lang AND i.phrase = c.phrase
  WHERE i.longest IS NULL OR 100 * i.longest < 100 * c.a
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= {TOP}
"""

"""A manifest of the log table's files, and searches that open only files that may hold a result.

For every file of a committed attempt the manifest has its day, time range, range of services, number of
rows, number of rows of each severity, and a bitmap of the trigrams of its messages. It lies in
``logs-files``, in folders named as those of ``logs``, and is built by one pass over the files when they
are written. A search reads the manifest first, then opens files newest first and ends as soon as
no other file can hold a row of the result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window as W, functions as F, types as T

from logbrook import schema as S
from logbrook.functions import clean_keyword, decode_cursor, encode_cursor
from logbrook.operators import search
from logbrook.session import read_table, written
from logbrook.sources import commits as c

#: A file's trigram bitmap is cut into so many parts of 32,768 bits; parts without a bit are not stored.
GRAM_PARTS = 8
_PART_BITS = 32_768
GRAM = 3
#: Bits are gathered in words of 64, so many for each part.
_WORDS = _PART_BITS // 64
#: Trigrams are cut out of pieces of so many characters: finding a place in a text takes time by the place.
_PIECE = 64

#: Files opened in the first step of a search; every step opens twice as many as the one before.
FIRST_FILES = 4
#: Spark's row numbers have the number of the task above so many bits.
_PLACE_BITS = 33
#: Lines of the manifest that a search asks for at a time.
MANIFEST_LINES = 4096

FILES_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("oldest", T.TimestampNTZType()),
        T.StructField("newest", T.TimestampNTZType()),
        T.StructField("first_service", T.StringType()),
        T.StructField("last_service", T.StringType()),
        T.StructField("severities", T.MapType(T.StringType(), T.LongType())),
        T.StructField("grams", T.MapType(T.IntegerType(), T.BinaryType())),
        T.StructField("ingest_id", T.StringType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("log_date", T.DateType()),
    ]
)


#: Rows as they are stored. ``origin`` is the batch and attempt that a compacted row came from.
STORED_SCHEMA = T.StructType([*S.LOGS_SCHEMA, T.StructField("attempt", T.StringType()), T.StructField("origin", T.StringType())])


def origin_of(batch: Column, attempt: Column) -> Column:
    return F.concat(batch, F.lit("@"), attempt)


def manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}-files"


# --- writing --------------------------------------------------------------------------


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once for a row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _pieces(text: Column) -> Column:
    """A text in small letters, cut so that every trigram lies in one piece; none where there is no trigram."""
    step = _PIECE - (GRAM - 1)

    def cut(low: Column) -> Column:
        last = F.floor((F.char_length(low) - GRAM) / step).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(low, k * step + 1, F.lit(_PIECE)))

    return F.when(F.char_length(text) >= GRAM, _bound(F.lower(text), cut)).otherwise(F.array().cast("array<string>"))


def _starts(piece: Column) -> Column:
    return F.sequence(F.lit(1), F.char_length(piece) - (GRAM - 1))


def _place(piece: Column, start: Column) -> Column:
    """Place of a trigram in the bitmap of all parts."""
    return F.pmod(F.xxhash64(F.substring(piece, start, F.lit(GRAM))), F.lit(GRAM_PARTS * _PART_BITS)).cast("int")


def gram_bits(text: Column) -> Column:
    """Distinct places of a text's trigrams, without regard to case, in the bitmap of all parts."""
    places = F.transform(_pieces(text), lambda p: F.transform(_starts(p), lambda i: _place(p, i)))
    return F.array_distinct(F.flatten(places))


def gram_maps(rows: DataFrame) -> DataFrame:
    """(file, grams): the trigram bitmaps of the messages of every file.

    Bits are gathered by file in words of 64 first, a hash aggregation whose groups are at most 4096 for
    a file. Gathering them into the bitmaps at once would sort every trigram of a task, because a binary
    value is no buffer of a hash aggregation.
    """
    # Rows of trigrams rather than arrays: these steps are compiled, functions of array elements are not.
    pieces = rows.select("file", F.explode(_pieces(F.col("message"))).alias("piece"))
    starts = pieces.select("file", "piece", F.explode(_starts(F.col("piece"))).alias("start"))
    bits = starts.select("file", _place(F.col("piece"), F.col("start")).alias("bit"))
    # The bits of a word stand in the order of the bitmap's bytes, so its hexadecimal digits are those bytes.
    shift = (7 - F.shiftright("bit", 3) % 8) * 8 + F.col("bit") % 8
    one = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
    words = bits.groupBy("file", F.shiftright("bit", 6).alias("word")).agg(F.bit_or(one).alias("value"))
    digits = F.struct((F.col("word") % _WORDS).alias("place"), F.lpad(F.hex("value"), 16, "0").alias("digits"))
    parts = words.groupBy("file", F.floor(F.col("word") / _WORDS).cast("int").alias("part")).agg(
        F.collect_list(digits).alias("words")
    )
    every = F.sequence(F.lit(0), F.lit(_WORDS - 1))
    whole = _bound(
        F.map_from_entries("words"),
        lambda m: F.array_join(F.transform(every, lambda w: F.coalesce(F.try_element_at(m, w), F.lit("0" * 16))), ""),
    )
    # At most GRAM_PARTS parts of 4 KB for a file.
    entry = F.struct("part", F.unhex(whole).alias("bits"))
    return parts.groupBy("file").agg(F.map_from_entries(F.collect_list(entry)).alias("grams"))


def has_bit(grams: Column, bit: Column) -> Column:
    """Whether a bitmap has the bit; a part that is not stored has none."""
    part, place = F.try_element_at(grams, F.floor(bit / _PART_BITS).cast("int")), bit % _PART_BITS
    byte = F.conv(F.hex(F.substring(part, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1, F.lit(False))


def describe(spark: SparkSession, path: str, batch: str, attempt: str, grams: bool = True) -> list[c.Entry]:
    """Write the manifest of a written attempt; returns what its commit has to add, a line for each day.

    Without ``grams`` the files have no trigrams and every keyword search opens them.
    """
    _, table = c.place(path)
    fields = [f for f in S.LOGS_SCHEMA if f.name != "ingest_id"]
    stored = read_table(spark, c.folder(path, batch, attempt), T.StructType(fields))
    none = [c.Entry(c.ADD, table, batch, attempt, None, 0)]
    if stored is None:
        return none
    file = F.regexp_extract(F.col("_metadata.file_path"), r"(log_date=[^/]*/[^/]*)$", 1)
    rows = stored.select(file.alias("file"), "log_date", "timestamp", "service_name", "severity", "message")
    kinds = {f"_n{i}": severity for i, severity in enumerate(S.SEVERITIES)}
    # By service first: the least and the last of all rows' texts would be found by sorting the rows.
    services = rows.groupBy("file", "log_date", "service_name").agg(
        F.count("*").alias("n_rows"),
        F.min("timestamp").alias("oldest"),
        F.max("timestamp").alias("newest"),
        *[F.count_if(F.col("severity") == severity).alias(n) for n, severity in kinds.items()],
    )
    of_severity = [F.struct(F.lit(severity), F.sum(n)) for n, severity in kinds.items()]
    lines = services.groupBy("file", "log_date").agg(
        F.sum("n_rows").alias("n_rows"),
        F.min("oldest").alias("oldest"),
        F.max("newest").alias("newest"),
        F.min("service_name").alias("first_service"),
        F.max("service_name").alias("last_service"),
        F.map_from_entries(F.array(*of_severity)).alias("severities"),
    )
    if grams:
        lines = lines.join(gram_maps(rows), "file", "left").withColumn("grams", F.coalesce("grams", F.create_map().cast("map<int,binary>")))
    else:
        lines = lines.withColumn("grams", F.lit(None).cast("map<int,binary>"))
    written = c.folder(manifest_path(path), batch, attempt)
    lines.write.parquet(written)
    days = spark.read.schema(FILES_SCHEMA).parquet(written).groupBy("log_date").agg(F.sum("n_rows").alias("n_rows")).collect()
    return [c.Entry(c.ADD, table, batch, attempt, day["log_date"], day["n_rows"]) for day in days] or none


# --- reading --------------------------------------------------------------------------


def manifest(spark: SparkSession, path: str, live: Iterable[c.Entry]) -> DataFrame:
    """The files of live folders."""
    base = manifest_path(path)
    filled = [e for e in live if e.n_rows]
    folders = sorted({c.folder(base, e.batch, e.attempt) for e in filled})
    rows = c.read_folders(spark, base, folders, FILES_SCHEMA)
    days = spark.createDataFrame([(e.attempt, e.day) for e in filled], "_attempt string, _day date")
    same = (F.col("attempt") == F.col("_attempt")) & F.col("log_date").eqNullSafe(F.col("_day"))
    return rows.join(days, same, "left_semi")


def stored_rows(spark: SparkSession, path: str, paths: list[str], seen: c.Snapshot) -> DataFrame:
    """Rows of live folders or files. Rows that a compaction took from an attempt that was replaced since are left out."""
    rows = c.read_folders(spark, path, paths, STORED_SCHEMA)
    if not seen.replaced:
        return rows
    replaced = [f"{batch}@{attempt}" for batch, attempt in seen.replaced]
    return rows.filter(F.col("origin").isNull() | ~F.col("origin").isin(replaced))


def may_hold(
    service: str | None = None,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    severity: str | Iterable[str] | None = None,
    q: str | None = None,
    fold_warning: bool = False,
    page_token: str | None = None,
) -> Column:
    """Whether a file of the manifest may hold a row that fits the filters of ``search.matching``."""
    start, end = (m and search._utc(m) for m in (start, end))
    tests = [F.col("n_rows") > 0]
    if service is not None:
        tests += [F.col("first_service") <= service, F.col("last_service") >= service]
    if start is not None:
        tests += [F.col("log_date") >= F.lit(start.date()), F.col("newest") >= search._at(start)]
    if end is not None:
        tests += [F.col("log_date") <= F.lit(end.date()), F.col("oldest") <= search._at(end)]
    if page_token:
        before = decode_cursor(page_token)[0]
        tests += [F.col("log_date") <= F.lit(before.date()), F.col("oldest") <= search._at(before)]
    wanted = {s.upper() for s in ([severity] if isinstance(severity, str) else severity or ())}
    if fold_warning and wanted & {"WARN", "WARNING"}:
        wanted |= {"WARN", "WARNING"}
    if wanted:
        tests.append(search.any_of(F.try_element_at("severities", F.lit(s)) > 0 for s in sorted(wanted)))
    keyword = clean_keyword(q)
    if keyword and len(keyword) >= GRAM:
        bits = gram_bits(F.lit(keyword))
        tests.append(F.col("grams").isNull() | F.forall(bits, lambda b: has_bit(F.col("grams"), b)))
    return search.all_of(tests)


@dataclass(frozen=True)
class Found:
    """Rows of a stored search, newest first, and how many files it opened of those that might hold any."""

    rows: list[Row]
    opened: int
    possible: int


def _days_of(filters: dict) -> dict:
    """Bounds of the days that a search by time may touch."""
    if filters.get("granularity", "time") == "date":
        return {}
    return {end: filters.get(name) and search._utc(filters[name]).date() for end, name in (("first", "start"), ("last", "end"))}


def _newest_rows(spark: SparkSession, path: str, size: int, service: str | None, filters: dict) -> Found:
    if filters.get("granularity", "time") == "date":
        period = search.day_range(filters.get("start"), filters.get("end"), filters.get("as_of") or filters.get("start") or filters.get("end"))
        times = {}
    else:
        period = F.lit(True)
        times = {name: filters.get(name) for name in ("start", "end")}
    seen = c.snapshot(spark, path, **_days_of(filters))
    kept = {name: filters[name] for name in ("severity", "q", "fold_warning", "page_token") if name in filters}
    lines = manifest(spark, path, seen.live).filter(period & may_hold(service, **times, **kept))
    lines = lines.select("newest", "ingest_id", "attempt", "file")
    order = [F.desc("newest"), F.desc("attempt"), F.desc("ingest_id"), F.desc("file")]
    rows, opened, step, at, possible = [], 0, FIRST_FILES, 0, []

    def more() -> list[Row]:
        """The next lines of the manifest, newest first."""
        if possible and len(possible) % MANIFEST_LINES:
            return []
        rest = lines
        if possible:
            last = possible[-1]
            here = F.struct("newest", "attempt", "ingest_id", "file")
            there = F.struct(search._at(last["newest"]), F.lit(last["attempt"]), F.lit(last["ingest_id"]), F.lit(last["file"]))
            rest = lines.filter(here < there)
        return rest.orderBy(*order).limit(MANIFEST_LINES).collect()

    possible += more()
    while at < len(possible):
        if len(rows) == size and rows[-1]["timestamp"] > possible[at]["newest"]:
            break
        chunk = possible[at : at + step]
        paths = [f"{c.folder(path, f['ingest_id'], f['attempt'])}/{f['file']}" for f in chunk]
        found = search.matching(stored_rows(spark, path, paths, seen), service, **filters)
        got = search.result_columns(found).orderBy(*search.newest_first()).limit(size).collect()
        merged = sorted(rows + got, key=lambda r: r["log_uuid"])
        rows = sorted(merged, key=lambda r: r["timestamp"], reverse=True)[:size]
        opened, at, step = opened + len(chunk), at + len(chunk), 2 * step
        if at == len(possible):
            possible += more()
    return Found(rows, opened, len(possible))


def _result_schema() -> T.StructType:
    return T.StructType([S.LOGS_SCHEMA[name] for name in S.LOG_COLUMNS])


def find(spark: SparkSession, path: str, service: str | None, limit: int = S.SEARCH_DEFAULT_LIMIT, **filters) -> Found:
    """The rows of ``search.search`` over the table, found from its newest files on.

    Files are chosen by day, time, service, severity and the trigrams of a keyword of three characters or
    more, and opened newest first, a few at a time; the search ends when the last row of a full result is
    newer than everything in the files left. Rows that reach the driver are bounded by the limit.
    """
    return _newest_rows(spark, path, search.check_limit(limit), service, filters)


def search_stored(spark: SparkSession, path: str, service: str | None, limit: int = S.SEARCH_DEFAULT_LIMIT, **filters) -> DataFrame:
    """Newest rows of the stored log that fit the filters of ``search.matching``; ``find`` tells how it went."""
    return spark.createDataFrame(find(spark, path, service, limit, **filters).rows, _result_schema())


def _numbered_pages(rows: DataFrame, size: int) -> DataFrame:
    """Rows with the ``page`` (from 0) that they have if every ``size`` rows, newest first, are one.

    Rows are cut into ranges of the order and sorted there, and written once with their place in the range.
    Only the row counts of the ranges are summed up in order, so no task has more than a range.
    """
    order, place = search.newest_first(), 2**_PLACE_BITS - 1
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = written(ranges.withColumn("_at", F.monotonically_increasing_id()), "pages-in-order")
    counts = kept.groupBy(F.shiftright("_at", _PLACE_BITS).alias("_range")).count()
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit(place))
    same = F.shiftright("_at", _PLACE_BITS) == F.col("_range")
    return kept.join(F.broadcast(starts), same).select(*rows.columns, ((rank - rank % size) / size).cast("bigint").alias("page"))


def page_stored(
    spark: SparkSession, path: str, service: str | None, limit: int = S.SEARCH_DEFAULT_LIMIT, every: bool = False, **filters
) -> search.Page:
    """A page of the stored log and the token of the next one, without a start in time and without guesses.

    With ``every`` the results are this page and all that follow, with a column ``page`` from 0, found in one
    pass over the rows: nothing of them reaches the driver, and going on from token to token would
    read rows of one time once for each of their pages. There is no next page then. Rows without a time have
    no place in the order of tokens and are on no page, as behind a token. Rows that equal each other in time
    and id follow one another, where a token would pass over those behind the page's end.
    """
    if every:
        size = search.check_limit(limit)
        seen = c.snapshot(spark, path, **_days_of(filters))
        folders = [c.folder(path, e.batch, e.attempt, e.day) for e in seen.live if e.n_rows]
        found = search.matching(stored_rows(spark, path, folders, seen), service, **filters)
        timed = search.result_columns(found.filter(F.col("timestamp").isNotNull()))
        return search.Page(_numbered_pages(timed, size), None)
    rows = _newest_rows(spark, path, search.check_limit(limit) + 1, service, filters).rows
    token = encode_cursor(rows[limit - 1]["timestamp"], rows[limit - 1]["log_uuid"]) if len(rows) > limit else None
    return search.Page(spark.createDataFrame(rows[:limit], _result_schema()), token)

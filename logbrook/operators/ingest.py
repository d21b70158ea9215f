"""Log lines to checked, enriched log rows.

Every step is a narrow projection except the batch numbering at the end, so parsing
100 TB of lines needs no shuffle. Rows are never dropped for being wrong: they carry a
``reason`` and go to the rejects table, except blank lines, which hold nothing.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from logbrook import schema as S
from logbrook.functions import full_iso, utc_of

_FIELDS = ("timestamp", "service", "severity", "message", "host", "metadata")


def _field(name: str) -> Column:
    return F.try_variant_get("doc", f"$[0].{name}", "variant")


def _strict(text: str) -> tuple[Column, Column]:
    """A parsed JSON text as ``$[0]`` of an array, and whether it was exactly one value.

    The second element is the text's own hash. The parser stops at the first closing bracket,
    so anything behind the value is noticed because the hash is not found there.
    """
    mark = F.xxhash64(text).cast("string")
    doc = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))
    second = F.try_variant_get("doc", "$[1]", "string")
    one = F.coalesce(second == mark, F.lit(False)) & F.try_variant_get("doc", "$[2]", "variant").isNull()
    return doc, one


def parse_lines(lines: DataFrame, required: tuple[str, ...] = S.REQUIRED_KEYS) -> DataFrame:
    """Add ``doc`` (the parsed line) and ``reason`` to rows that have a ``line``.

    The line is parsed once; text behind the object, or a second object, makes it invalid. A
    required key that is present with a null value counts as present here; ``validate``
    judges values.
    """
    doc, one_object = _strict("line")
    has_keys = F.lit(True)
    for key in required:
        has_keys = has_keys & _field(key).isNotNull()
    return (
        lines.filter(~F.col("line").rlike(r"^\s*$"))
        .withColumn("doc", doc)
        .withColumn("reason", F.when(~one_object, "not_json").when(~has_keys, "missing_key"))
    )


def extract_fields(parsed: DataFrame, optional_timestamp: bool = False) -> DataFrame:
    """Replace ``doc`` by typed columns; a wrong JSON type becomes a reason.

    With ``optional_timestamp`` a null is as good as no timestamp.

    Types are read from the variant because a plain cast would accept the number 5 as
    the string "5". Text columns are NULL where the value is no string, so the reasons
    follow from NULLs in a second projection and no value is taken out twice.
    """
    kept = [F.col(c) for c in parsed.columns if c not in ("doc", "reason")]
    found = parsed.select(*kept, "reason", *[_field(f).alias(f"_{f}") for f in _FIELDS])

    def kind(field: str) -> Column:
        return F.schema_of_variant(f"_{field}")

    def text(field: str) -> Column:
        return F.when(kind(field) == "STRING", F.try_variant_get(f"_{field}", "$", "string"))

    pairs = F.try_variant_get("_metadata", "$", "map<string,variant>")
    only_text = F.forall(F.map_values(pairs), lambda v: F.schema_of_variant(v) == "STRING")
    no_pairs = F.col("_metadata").isNull() | (kind("metadata") == "VOID")
    typed = found.select(
        *kept,
        "reason",
        *[text(f).alias(f) for f in _FIELDS[:-1]],
        F.try_variant_get("_metadata", "$", "map<string,string>").alias("metadata"),
        (
            F.col("_timestamp").isNotNull() & (F.lit(not optional_timestamp) | (kind("timestamp") != "VOID"))
        ).alias("_has_timestamp"),
        F.col("_host").isNotNull().alias("_has_host"),
        (no_pairs | F.coalesce(only_text, F.lit(False))).alias("_good_metadata"),
    )
    problem = (
        F.when(F.col("_has_timestamp") & F.col("timestamp").isNull(), "bad_timestamp")
        .when(F.col("service").isNull(), "bad_service")
        .when(F.col("severity").isNull(), "bad_severity")
        .when(F.col("message").isNull(), "bad_message")
        .when(F.col("_has_host") & F.col("host").isNull(), "bad_host")
        .when(~F.col("_good_metadata"), "bad_metadata")
    )
    return typed.select(*kept, *_FIELDS, F.coalesce("reason", problem).alias("reason"))


def with_defaults(events: DataFrame) -> DataFrame:
    """Give absent columns and NULL host / metadata their defaults."""
    host = F.col("host") if "host" in events.columns else F.lit(None)
    pairs = F.col("metadata") if "metadata" in events.columns else F.lit(None)
    reason = F.col("reason") if "reason" in events.columns else F.lit(None)
    return events.withColumns(
        {
            "host": F.coalesce(host, F.lit(S.UNKNOWN_HOST)),
            "metadata": F.coalesce(pairs.cast("map<string,string>"), F.create_map().cast("map<string,string>")),
            "reason": reason.cast("string"),
        }
    )


def normalize_ts(events: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Turn ``timestamp`` into UTC wall time; an absent one becomes ``as_of``.

    ``as_of`` is an argument, not the clock, so that a repeated batch gives equal rows.
    Without it an absent timestamp is a reject.
    """
    if "timestamp" not in events.columns:
        events = events.withColumn("timestamp", F.lit(None).cast("string"))
    if "reason" not in events.columns:
        events = events.withColumn("reason", F.lit(None).cast("string"))
    columns = [c for c in events.columns if c not in ("timestamp", "reason")]
    fallback = F.lit(as_of).cast("timestamp_ntz")
    if isinstance(events.schema["timestamp"].dataType, T.StringType):
        # One step per projection: each text is matched once, however often it is used.
        spelled = events.withColumn("_iso", full_iso(F.col("timestamp")))
        moment = F.when(F.col("_iso").isNull(), fallback).otherwise(utc_of(F.col("_iso")))
        resolved = spelled.select(*columns, "reason", moment.alias("timestamp"))
    else:
        moment = F.coalesce(F.col("timestamp").cast("timestamp_ntz"), fallback)
        resolved = events.select(*columns, "reason", moment.alias("timestamp"))
    problem = F.when(F.col("timestamp").isNull(), "bad_timestamp")
    return resolved.withColumn("reason", F.coalesce("reason", problem))


def validate(events: DataFrame) -> DataFrame:
    """Upper-case ``severity`` and add ``reason``: NULL for a good row, else the first rule broken.

    Needs ``service, severity, message``; ``host`` and ``metadata`` are optional.
    """
    checked = with_defaults(events).withColumn("severity", F.upper("severity"))

    def within(column: str, least: int, most: int) -> Column:
        return F.coalesce(F.char_length(column).between(least, most), F.lit(False))

    known = F.coalesce(F.col("severity").isin(*S.SEVERITIES), F.lit(False))
    problem = (
        F.when(~within("service", 1, S.SERVICE_MAX_CHARS), "bad_service")
        .when(~known, "bad_severity")
        .when(~within("message", 1, S.MESSAGE_MAX_CHARS), "bad_message")
        .when(~within("host", 0, S.HOST_MAX_CHARS), "bad_host")
    )
    return checked.withColumn("reason", F.coalesce("reason", problem))


def enrich(events: DataFrame) -> DataFrame:
    """Add ``service_name``, ``log_date`` and a repeatable ``log_uuid``.

    A line is identified by its file, byte offset and text, so delivering it again gives
    the same id, and a rotated file that reuses an offset gives another one. Without
    offsets equal lines of a file share an id. Rows that are no lines use their fields.
    """
    parts = [F.col(c).cast("string") for c in ("file", "off", "line") if c in events.columns]
    if "line" not in events.columns:
        pairs = F.to_json(F.array_sort(F.map_entries("metadata")))
        fields = ("service", "host", "severity", "message")
        parts = [F.col("timestamp").cast("string"), *map(F.col, fields), pairs]
    key = F.concat_ws("\u0001", *parts)
    return events.withColumns(
        {
            "service_name": F.col("service"),
            "log_date": F.to_date("timestamp"),
            "log_uuid": F.md5(key),
        }
    )


def _computed_once(column: str) -> Column:
    """The column itself, but as a value that filters are not rewritten into.

    A filter on a computed column is normally moved below the projection and so computes
    the column a second time; for ``reason`` that would be the whole parse, once per
    projection. The planner leaves filters above a projection with a non-deterministic
    column. The extra branch is never taken.
    """
    return F.when(F.spark_partition_id() >= 0, F.col(column))


def ingest_lines(lines: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Lines (``line``, optionally ``file`` and ``off``) to log rows with a ``reason``."""
    rows = enrich(validate(normalize_ts(extract_fields(parse_lines(lines)), as_of)))
    return rows.withColumn("reason", _computed_once("reason"))


def request_lines(requests: DataFrame) -> DataFrame:
    """Request bodies (``request``, ``body``) to one row for each event: ``request, file, off, line``.

    A body is one event or a JSON array of events; ``off`` is the event's place in it. A body that
    is no JSON stays one line, which the parser will refuse; an empty array or an empty body
    becomes a row without a line.
    """
    doc, one_value = _strict("body")
    parsed = requests.select("request", "body", doc.alias("doc"))
    items = F.try_variant_get("doc", "$[0]", "array<variant>")
    bodies = (
        F.when(~one_value, F.array("body"))
        .when(items.isNull(), F.array("body"))
        .when(F.size(items) == 0, F.array(F.lit(None).cast("string")))
        .otherwise(F.transform(items, lambda item: F.to_json(item)))
    )
    blank = F.coalesce(F.col("body").rlike(r"^\s*$"), F.lit(True))
    lines = F.when(blank, F.array(F.lit(None).cast("string"))).otherwise(bodies)
    return parsed.select(
        "request", F.col("request").cast("string").alias("file"), F.posexplode(lines).alias("off", "line")
    ).withColumn("off", F.col("off").cast("bigint"))


def ingest_requests(requests: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Request bodies to log rows with a ``reason``, all or nothing for each request (``batch_ok``).

    Other than in log files, an event without a timestamp is one of ``as_of``. A request
    without events fails with ``empty_request``.
    """
    lines = request_lines(requests)
    empty = lines.filter(F.col("line").isNull()).select("request", F.lit("empty_request").alias("reason"))
    required = tuple(key for key in S.REQUIRED_KEYS if key != "timestamp")
    parsed = parse_lines(lines.filter(F.col("line").isNotNull()), required)
    rows = enrich(validate(normalize_ts(extract_fields(parsed, optional_timestamp=True), as_of)))
    rows = rows.withColumn("reason", _computed_once("reason"))
    return batch_gate(rows.unionByName(empty, allowMissingColumns=True), "request")


def accepted(events: DataFrame) -> DataFrame:
    return events.filter(F.col("reason").isNull()).select(*S.LOG_COLUMNS)


def rejected(events: DataFrame) -> DataFrame:
    """Rejected input in the rejects layout: the line as it came, and why."""
    columns = [
        F.col(f.name) if f.name in events.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in S.REJECTS_SCHEMA
    ]
    return events.filter(F.col("reason").isNotNull()).select(*columns)


def number_batches(
    lines: DataFrame, size: int = S.BATCH_ROWS, chunk_bytes: int = 16 * 1024 * 1024
) -> DataFrame:
    """Add ``batch_no``: every ``size`` consecutive lines of a ``file``, in ``off`` order.

    A file may hold a third of all rows, so it is not ranked as one group. Byte offsets
    cut it into chunks of ``chunk_bytes`` (which bounds the rows of a chunk); lines are
    ranked inside their chunk and shifted by the line count of the chunks before it. Only
    those counts, one row per chunk, are summed in file order. Lines without an offset
    cannot be numbered: the columns must be there, and a NULL offset fails the job.
    """
    if not {"file", "off"} <= set(lines.columns):
        raise ValueError("numbering batches needs the columns file and off")
    no_offset = F.raise_error(F.lit("a line without an offset cannot be numbered")).cast("bigint")
    chunk = F.when(F.col("off").isNull(), no_offset).otherwise(F.floor(F.col("off") / F.lit(chunk_bytes)))
    chunked = lines.withColumn("_chunk", chunk.cast("bigint"))
    before = W.partitionBy("file").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        chunked.groupBy("file", "_chunk")
        .count()
        .select(
            F.col("file").alias("_file"),
            F.col("_chunk").alias("_of"),
            F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"),
        )
    )
    rank = F.row_number().over(W.partitionBy("file", "_chunk").orderBy("off")) - 1
    return (
        chunked.withColumn("_rank", rank)
        .join(starts, F.col("file").eqNullSafe(F.col("_file")) & (F.col("_chunk") == F.col("_of")))
        .withColumn("batch_no", F.floor((F.col("_before") + F.col("_rank")) / size).cast("bigint"))
        .drop("_chunk", "_before", "_rank", "_file", "_of")
    )


def batch_gate(events: DataFrame, *batch_columns: str) -> DataFrame:
    """Add ``batch_ok``: false for every row of a batch that holds an invalid row.

    The bad batches are found by aggregation and joined back. No batch has to fit into
    one task, whatever the caller chose as its batches. Rows whose batch is NULL are one
    batch like any other.
    """
    keys = {c: f"_bad_{c}" for c in batch_columns}
    bad = (
        events.filter(F.col("reason").isNotNull())
        .groupBy(*[F.col(c).alias(k) for c, k in keys.items()])
        .agg(F.lit(False).alias("_ok"))
    )
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()))
    return (
        events.join(bad, same, "left")
        .withColumn("batch_ok", F.coalesce("_ok", F.lit(True)))
        .drop("_ok", *keys.values())
    )


def accounting(events: DataFrame) -> DataFrame:
    """Row counts by outcome. ``status`` is accepted or rejected; ``reason`` names the rule."""
    status = F.when(F.col("reason").isNull(), "accepted").otherwise("rejected")
    return events.groupBy(
        status.alias("status"), F.coalesce("reason", F.lit("")).alias("reason")
    ).agg(F.count("*").alias("n_rows"))

"""The ``events`` and ``documents`` tables seen as logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The service names of the log view, by user_id modulo their number.
SERVICES = (
    "auth-service",
    "payment-service",
    "api-gateway",
    "notification-service",
    "user-service",
    "report-service",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _service() -> Column:
    slot = F.col("user_id") % len(SERVICES)
    chain = F.when(slot == 0, SERVICES[0])
    for i, name in enumerate(SERVICES[1:-1], start=1):
        chain = chain.when(slot == i, name)
    return chain.otherwise(SERVICES[-1])


def _severity() -> Column:
    kind, n = F.col("event_type"), F.col("event_id")
    warning = F.when(n % 2 == 0, "WARN").otherwise("WARNING")
    return (
        F.when((kind == "error") & (n % 6 <= F.col("user_id") % 6), "ERROR")
        .when(kind == "signup", warning)
        .when(kind == "click", "DEBUG")
        .otherwise("INFO")
    )


def _message() -> Column:
    amount = F.col("value").cast("decimal(18,2)").cast("string")
    return F.concat(
        "event_type", F.lit(" user_id="), _text("user_id"), F.lit(" amt="), amount
    )


def log_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log rows; the event payload becomes the metadata."""
    return logs_of(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of its files."""
    schema = table(spark, sf_dir, "events").schema
    # A pattern that matches just this table: as such it may name a file or a folder.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def logs_of(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        _service().alias("service_name"),
        F.col("ts").cast("date").alias("log_date"),
        F.col("ts").alias("timestamp"),
        F.md5(_text("event_id")).alias("log_uuid"),
        _severity().alias("severity"),
        _message().alias("message"),
        F.concat(F.lit("host-"), (F.col("event_id") % 7).cast("string")).alias("host"),
        F.create_map(F.lit("props"), "props").alias("metadata"),
    )


def lines_of(events: DataFrame) -> DataFrame:
    """Events as JSON Lines text, the form log files hold."""
    wire = F.struct(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.col("service_name").alias("service"),
        "severity",
        "message",
        "host",
        "metadata",
    )
    return logs_of(events).select("event_id", F.to_json(wire).alias("line"))


# Ways a line can be broken, by event_id modulo 8; "@" stands for the good line.
BROKEN = {
    1: "@ trailing",
    2: "[@]",
    3: "@,@",
    4: "not json",
    5: '{"service":"auth-service","severity":"INFO","message":"no time"}',
    6: "@]",
    7: '@] {"x":1',
}


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short JSON lines of which seven in eight are broken, each in its own way.

    Lines of one ``file`` (an event type) are placed at offsets of 100 bytes.
    """
    events = table(spark, sf_dir, "events")
    good = F.concat(
        F.lit('{"timestamp":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit('","service":"'), _service(), F.lit('","severity":"'), _severity(),
        F.lit('","message":"'), F.col("event_type"), F.lit('"}'),
    )
    chosen = F.when(F.col("event_id") % 8 == 0, F.col("_good"))
    for slot, pattern in BROKEN.items():
        chosen = chosen.when(
            F.col("event_id") % 8 == slot, F.replace(F.lit(pattern), F.lit("@"), F.col("_good"))
        )
    return events.withColumn("_good", good).select(
        "event_id",
        F.col("event_type").alias("file"),
        (F.col("event_id") * 100).alias("off"),
        chosen.otherwise(F.col("_good")).alias("line"),
    )


def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as bodies of requests, five in each, some of them special (by ``request`` modulo 7).

    1: the first event is wrong; 2: no events; 3: the first event alone, not in an array; 4: the
    first event has no timestamp, the second a null; 5: no JSON.
    """
    events = table(spark, sf_dir, "events")
    request = F.floor(F.col("event_id") / 5).cast("bigint")
    kind = request % 7
    sent = F.concat(F.lit('"timestamp":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('",'))
    first, second = F.col("event_id") % 5 == 0, F.col("event_id") % 5 == 1
    stamp = F.when((kind == 4) & first, "").when((kind == 4) & second, '"timestamp":null,').otherwise(sent)
    severity = F.when((kind == 1) & first, "LOUD").otherwise(_severity())
    item = F.concat(
        F.lit("{"), stamp, F.lit('"service":"'), _service(), F.lit('","severity":"'), severity,
        F.lit('","message":"'), F.col("event_type"), F.lit('"}'),
    )
    grouped = events.select(request.alias("request"), F.struct("event_id", item.alias("item")).alias("event"))
    bodies = grouped.groupBy("request").agg(F.sort_array(F.collect_list("event")).alias("events"))
    kind, items = F.col("request") % 7, F.col("events.item")
    body = (
        F.when(kind == 2, "[]")
        .when(kind == 3, items[0])
        .when(kind == 5, F.concat(F.lit("["), F.array_join(items, ",")))
        .otherwise(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")))
    )
    return bodies.select("request", body.alias("body"))


def document_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as events to validate: source = service, whole text = message.

    Severity and host are made from ``doc_id`` so that every rule is broken somewhere.
    """
    documents = table(spark, sf_dir, "documents")
    n = F.col("doc_id")
    severity = (
        F.when(n % 11 == 0, "fatal")
        .when(n % 11 == 1, F.lit(None).cast("string"))
        .when(n % 5 == 0, "Warning")
        .when(n % 5 == 1, "error")
        .when(n % 5 == 2, "warn")
        .when(n % 5 == 3, "DEBUG")
        .otherwise("info")
    )
    return documents.select(
        "doc_id",
        F.when(n % 13 == 0, "").otherwise(F.col("source")).alias("service"),
        severity.alias("severity"),
        F.col("text").alias("message"),
        F.when(n % 17 == 0, F.repeat(F.lit("h"), 256)).otherwise("web-1").alias("host"),
        F.floor(n / 100).cast("bigint").alias("batch_no"),
    )

"""Column layouts and fixed values shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# They must stay as they are for results to agree with the log format.
SEVERITIES = ("DEBUG", "INFO", "WARN", "WARNING", "ERROR")
SEVERITY_CLASSES = ("ERROR", "WARN", "INFO", "DEBUG")
COUNT_COLUMNS = ("error_count", "warn_count", "info_count", "debug_count")
REQUIRED_KEYS = ("timestamp", "service", "severity", "message")
SERVICE_MAX_CHARS = 100
MESSAGE_MAX_CHARS = 10_000
HOST_MAX_CHARS = 255
UNKNOWN_HOST = "unknown"
SEARCH_DEFAULT_LIMIT = 50
SEARCH_MAX_LIMIT = 500
BATCH_ROWS = 100
SPIKE_PERCENT = 15
RED_PERCENT = 10
AMBER_PERCENT = 3
TREND_HOURS = 12
TOP_SERVICES = 5
PRESET_HOURS = {"1h": 1, "6h": 6, "12h": 12, "24h": 24, "7d": 168}
SEED_SERVICES = ("auth-service", "payment-service", "api-gateway")
SEED_HOST = "host-local"

LOG_COLUMNS = (
    "service_name",
    "log_date",
    "timestamp",
    "log_uuid",
    "severity",
    "message",
    "host",
    "metadata",
)

# A stored row also remembers which batch wrote it (see streaming.sink); that and the day are folders.
LOGS_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("log_uuid", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("ingest_id", T.StringType()),
        T.StructField("log_date", T.DateType()),
        T.StructField("service_name", T.StringType()),
    ]
)

# Additive partial counts. Several rows may exist for one (service, hour): one per
# micro-batch that touched it. They are summed on read.
HOURLY_SCHEMA = T.StructType(
    [
        T.StructField("service_name", T.StringType()),
        T.StructField("hour_bucket", T.TimestampNTZType()),
        *[T.StructField(c, T.LongType()) for c in COUNT_COLUMNS],
        T.StructField("first_seen", T.TimestampNTZType()),
        T.StructField("last_seen", T.TimestampNTZType()),
        T.StructField("last_host", T.StringType()),
    ]
)

REJECTS_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("off", T.LongType()),
        T.StructField("line", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)

SAVED_QUERIES_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("query_name", T.StringType()),
        T.StructField("query_text", T.StringType()),
        T.StructField("created_by", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)
SAVED_QUERY_PARAMS = (
    "service STRING, severity STRING, q STRING, start TIMESTAMP_NTZ, end TIMESTAMP_NTZ, limit INT"
)

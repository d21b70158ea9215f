"""Registered batch queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from logbrook import schema as S
from logbrook.functions import encode_cursor, severity_class, short_name
from logbrook.operators import analytics, ingest, periods, rollup, saved, search
from logbrook.plans import events_view as view
from logbrook.session import written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = dt.datetime(2024, 1, 31)

_LOGS = """logs AS (
  SELECT event_id,
    CASE user_id % 6 WHEN 0 THEN 'auth-service' WHEN 1 THEN 'payment-service'
      WHEN 2 THEN 'api-gateway' WHEN 3 THEN 'notification-service'
      WHEN 4 THEN 'user-service' ELSE 'report-service' END AS service_name,
    CAST(ts AS DATE) AS log_date, ts AS "timestamp",
    md5(CAST(event_id AS VARCHAR)) AS log_uuid,
    CASE WHEN event_type = 'error' AND event_id % 6 <= user_id % 6 THEN 'ERROR'
      WHEN event_type = 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'WARN' ELSE 'WARNING' END
      WHEN event_type = 'click' THEN 'DEBUG' ELSE 'INFO' END AS severity,
    concat(event_type, ' user_id=', CAST(user_id AS VARCHAR), ' amt=',
      CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)) AS message,
    concat('host-', CAST(event_id % 7 AS VARCHAR)) AS host
  FROM events)"""
_ROLLUP = """rollup AS (
  SELECT service_name, date_trunc('hour', "timestamp") AS hour_bucket,
    count(*) FILTER (severity = 'ERROR') AS error_count,
    count(*) FILTER (severity IN ('WARN', 'WARNING')) AS warn_count,
    count(*) FILTER (severity = 'INFO') AS info_count,
    count(*) FILTER (severity = 'DEBUG') AS debug_count,
    max("timestamp") AS updated_at
  FROM logs GROUP BY ALL)"""
_REGISTRY = """registry AS (
  SELECT service_name, min("timestamp") AS first_seen, max("timestamp") AS last_seen,
    arg_max(host, "timestamp") AS host, count(*) AS total_events
  FROM logs GROUP BY service_name)"""
_PERCENT = "CAST(floor({part} / {total} * CAST(100 AS DOUBLE) + 0.5) AS BIGINT)"
_HEALTH = f"""counts AS (
  SELECT service_name, CAST(sum(error_count) AS BIGINT) AS error_count,
    CAST(sum(warn_count) AS BIGINT) AS warn_count, CAST(sum(info_count) AS BIGINT) AS info_count,
    CAST(sum(debug_count) AS BIGINT) AS debug_count
  FROM rollup {{where}} GROUP BY service_name),
rated AS (
  SELECT r.*, coalesce(error_count, 0) AS error_count, coalesce(warn_count, 0) AS warn_count,
    coalesce(info_count, 0) AS info_count, coalesce(debug_count, 0) AS debug_count,
    {_PERCENT.format(part="coalesce(error_count, 0)", total="total_events")} AS error_rate,
    CASE WHEN error_count + warn_count + info_count + debug_count > 0 THEN
      {_PERCENT.format(part="error_count", total="(error_count + warn_count + info_count + debug_count)")}
      ELSE 0 END AS window_error_rate
  FROM registry r LEFT JOIN counts c USING (service_name)),
health AS (
  SELECT *, CASE WHEN error_rate > 10 THEN 'red' WHEN error_rate > 3 THEN 'amber'
    ELSE 'green' END AS health FROM rated)"""
_ROW = 'service_name, log_date, "timestamp", log_uuid, severity, message, host'
_NEWEST = 'ORDER BY "timestamp" DESC, log_uuid'


def with_logs(sql: str) -> str:
    return f"WITH {_LOGS}\n{sql}"


def with_rollup(sql: str) -> str:
    return f"WITH {_LOGS},\n{_ROLLUP}\n{sql}"


def with_registry(sql: str) -> str:
    return f"WITH {_LOGS},\n{_REGISTRY}\n{sql}"


def with_health(sql: str, where: str = "") -> str:
    return f"WITH {_LOGS},\n{_ROLLUP},\n{_REGISTRY},\n{_HEALTH.format(where=where)}\n{sql}"


def register(name: str, sql: str | None = None):
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return keep


def shown(rows: DataFrame) -> DataFrame:
    """Search result without the map column, which a value hash cannot compare."""
    return rows.select(*S.LOG_COLUMNS[:-1])


def rollup_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.hourly_rollup(view.log_view(spark, sf_dir))


def registry_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.service_registry(view.log_view(spark, sf_dir))


def health_table(spark: SparkSession, sf_dir: str, *period: dt.datetime) -> DataFrame:
    """Registry and rollup come from the same stored partials, so logs are read once."""
    partials = written(rollup.hourly_partials(view.log_view(spark, sf_dir)), "hourly")
    registry, hours = rollup.registry_of(partials), rollup.rollup_of(partials)
    return analytics.service_health(registry, hours, *period)


# --- search -------------------------------------------------------------------------


@register(
    "log_view",
    with_logs(
        f"""SELECT event_id, {_ROW},
        CASE severity WHEN 'WARNING' THEN 'WARN' ELSE severity END AS severity_class FROM logs"""
    ),
)
def _log_view(spark, sf_dir):
    logs = view.log_view(spark, sf_dir)
    return logs.select(
        "event_id", *S.LOG_COLUMNS[:-1], severity_class(F.col("severity")).alias("severity_class")
    )


@register(
    "search_filters",
    with_logs(
        f"""SELECT {_ROW} FROM logs WHERE service_name = 'api-gateway' AND severity = 'INFO'
        AND contains(lower(message), 'amt=1')
        AND log_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' {_NEWEST} LIMIT 50"""
    ),
)
def _search_filters(spark, sf_dir):
    return shown(
        search.search(
            view.log_view(spark, sf_dir),
            "api-gateway",
            severity="info",
            q="  AMT=1 ",
            start=dt.datetime(2024, 1, 10, 15),
            end=dt.datetime(2024, 1, 12, 3),
            granularity="date",
        )
    )


@register(
    "search_time_range",
    with_logs(
        f"""SELECT {_ROW} FROM logs WHERE service_name = 'auth-service'
        AND "timestamp" BETWEEN TIMESTAMP '2024-01-10 06:30:00' AND TIMESTAMP '2024-01-11 18:15:00'
        {_NEWEST} LIMIT 100"""
    ),
)
def _search_time_range(spark, sf_dir):
    return shown(
        search.search(
            view.log_view(spark, sf_dir),
            "auth-service",
            limit=100,
            start=dt.datetime(2024, 1, 10, 6, 30),
            end=dt.datetime(2024, 1, 11, 18, 15),
        )
    )


@register(
    "search_today",
    with_logs(
        f"""SELECT {_ROW} FROM logs WHERE service_name = 'user-service'
        AND log_date = DATE '2024-01-30' {_NEWEST} LIMIT 50"""
    ),
)
def _search_today(spark, sf_dir):
    logs = view.log_view(spark, sf_dir)
    now = dt.datetime(2024, 1, 30, 9)
    return shown(search.search(logs, "user-service", granularity="date", as_of=now))


@register(
    "search_severity_set",
    with_logs(
        f"""SELECT {_ROW} FROM logs WHERE service_name = 'report-service'
        AND severity IN ('ERROR', 'WARN') {_NEWEST} LIMIT 500"""
    ),
)
def _search_severity_set(spark, sf_dir):
    logs = view.log_view(spark, sf_dir)
    return shown(search.search(logs, "report-service", limit=500, severity=["ERROR", "warn"]))


@register(
    "search_fold_warning",
    with_logs(
        f"""SELECT {_ROW} FROM logs WHERE service_name = 'payment-service'
        AND severity IN ('WARN', 'WARNING') {_NEWEST} LIMIT 50"""
    ),
)
def _search_fold_warning(spark, sf_dir):
    logs = view.log_view(spark, sf_dir)
    return shown(search.search(logs, "payment-service", severity="WARN", fold_warning=True))


@register(
    "search_host",
    with_logs(f"SELECT {_ROW} FROM logs WHERE host = 'host-3' {_NEWEST} LIMIT 50"),
)
def _search_host(spark, sf_dir):
    return shown(search.search_host(view.log_view(spark, sf_dir), "host-3"))


@register(
    "page_keyset",
    with_logs(
        f"""SELECT {_ROW} FROM logs WHERE service_name = 'auth-service'
        AND ("timestamp" < TIMESTAMP '2024-01-15 12:00:00'
          OR ("timestamp" = TIMESTAMP '2024-01-15 12:00:00' AND log_uuid > '8'))
        {_NEWEST} LIMIT 50"""
    ),
)
def _page_keyset(spark, sf_dir):
    token = encode_cursor(dt.datetime(2024, 1, 15, 12), "8")
    return shown(search.search(view.log_view(spark, sf_dir), "auth-service", page_token=token))


@register(
    "page_second",
    with_logs(
        f"SELECT {_ROW} FROM logs WHERE service_name = 'api-gateway' {_NEWEST} LIMIT 20 OFFSET 20"
    ),
)
def _page_second(spark, sf_dir):
    logs = view.log_view(spark, sf_dir)
    first = search.search_page(logs, "api-gateway", limit=20)
    return shown(search.search_page(logs, "api-gateway", 20, page_token=first.next_cursor).results)


@register(
    "per_day_newest",
    with_logs(
        f"""SELECT {_ROW}, rank FROM (SELECT *, row_number() OVER (
          PARTITION BY service_name, log_date {_NEWEST}) AS rank FROM logs) WHERE rank <= 5"""
    ),
)
def _per_day_newest(spark, sf_dir):
    newest = search.per_day_newest(view.log_view(spark, sf_dir), 5)
    return newest.select(*S.LOG_COLUMNS[:-1], "rank")


@register("dedup_uuid", with_logs("SELECT log_uuid, event_id, service_name, severity FROM logs"))
def _dedup_uuid(spark, sf_dir):
    logs = view.log_view(spark, sf_dir).select("log_uuid", "event_id", "service_name", "severity")
    return search.dedup(logs.unionByName(logs))


_SAVED_QUERIES = [
    (1, "auth errors", '{"service":"auth-service","severity":"error"}'),
    (2, "big purchases", '{"service":"payment-service","q":"Purchase","limit":10}'),
    (3, "gateway mid January", '{"service":"api-gateway","start":"2024-01-14T00:00:00","end":"2024-01-16T00:00:00","limit":500}'),
    (4, "auth views", '{"service":"auth-service","severity":"INFO","q":"view user_id=1"}'),
    (5, "no service", '{"severity":"ERROR"}'),
]


@register(
    "saved_query_match",
    with_logs(
        f"""SELECT query_id, rank, log_uuid, service_name, severity, message FROM (
          SELECT l.*, query_id, q_limit,
            row_number() OVER (PARTITION BY query_id {_NEWEST}) AS rank
          FROM logs l JOIN (VALUES
            (CAST(1 AS BIGINT), 'auth-service', 'ERROR', NULL, NULL, NULL, 50),
            (2, 'payment-service', NULL, 'purchase', NULL, NULL, 10),
            (3, 'api-gateway', NULL, NULL, TIMESTAMP '2024-01-14', TIMESTAMP '2024-01-16', 500),
            (4, 'auth-service', 'INFO', 'view user_id=1', NULL, NULL, 50)
          ) AS s(query_id, q_service, q_severity, q_word, q_start, q_end, q_limit)
          ON service_name = q_service AND (q_severity IS NULL OR severity = q_severity)
            AND (q_word IS NULL OR contains(lower(message), q_word))
            AND (q_start IS NULL OR "timestamp" >= q_start)
            AND (q_end IS NULL OR "timestamp" <= q_end)) WHERE rank <= q_limit"""
    ),
)
def _saved_query_match(spark, sf_dir):
    stored = spark.createDataFrame(
        [(*q, "cli", AS_OF) for q in _SAVED_QUERIES], S.SAVED_QUERIES_SCHEMA
    )
    found = saved.run_saved_queries(view.log_view(spark, sf_dir), stored)
    return found.select("query_id", "rank", "log_uuid", "service_name", "severity", "message")


# --- rollup and registry ------------------------------------------------------------


@register("hourly_rollup", with_rollup("SELECT * FROM rollup"))
def _hourly_rollup(spark, sf_dir):
    return rollup_table(spark, sf_dir)


@register("rollup_merge", with_rollup("SELECT * FROM rollup"))
def _rollup_merge(spark, sf_dir):
    logs = view.log_view(spark, sf_dir)
    # The cut lies inside an hour, so that hour has counts on both sides.
    early = F.col("timestamp") < F.lit(dt.datetime(2024, 1, 15, 12, 30)).cast("timestamp_ntz")
    halves = (rollup.hourly_rollup(logs.filter(early)), rollup.hourly_rollup(logs.filter(~early)))
    return rollup.merge_rollups(*halves)


@register(
    "stats_range",
    with_rollup(
        """SELECT * FROM rollup WHERE service_name = 'api-gateway' AND hour_bucket BETWEEN
        TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'
        ORDER BY hour_bucket DESC, service_name"""
    ),
)
def _stats_range(spark, sf_dir):
    period = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20, 12)
    return analytics.stats(rollup_table(spark, sf_dir), "api-gateway", *period)


@register(
    "stats_row_total",
    with_rollup(
        """SELECT service_name, hour_bucket,
        error_count + warn_count + info_count + debug_count AS total FROM rollup
        ORDER BY hour_bucket DESC, service_name"""
    ),
)
def _stats_row_total(spark, sf_dir):
    rows = analytics.stats(rollup_table(spark, sf_dir))
    return rollup.with_total(rows).select("service_name", "hour_bucket", "total")


@register("service_registry", with_registry("SELECT * FROM registry"))
def _service_registry(spark, sf_dir):
    return analytics.services(registry_table(spark, sf_dir))


@register(
    "registry_with_seed",
    with_registry(
        """SELECT * FROM registry UNION ALL SELECT s, TIMESTAMP '2024-01-31', TIMESTAMP '2024-01-31',
        'host-local', 0 FROM (VALUES ('auth-service'), ('payment-service'), ('api-gateway'),
        ('idle-service')) AS seed(s) WHERE s NOT IN (SELECT service_name FROM registry)"""
    ),
)
def _registry_with_seed(spark, sf_dir):
    registry = registry_table(spark, sf_dir)
    names = (*S.SEED_SERVICES, "idle-service")
    seed = spark.createDataFrame([(n, AS_OF, AS_OF, S.SEED_HOST, 0) for n in names],
        "service_name string, first_seen timestamp_ntz, last_seen timestamp_ntz, host string, total_events bigint",
    )
    return analytics.services(rollup.with_seed(registry, seed))


@register("known_services", with_logs("SELECT DISTINCT service_name FROM logs"))
def _known_services(spark, sf_dir):
    return rollup.known_services(registry_table(spark, sf_dir))


@register(
    "short_names",
    with_registry("SELECT service_name, replace(service_name, '-service', '') AS short_name FROM registry"),
)
def _short_names(spark, sf_dir):
    names = rollup.known_services(registry_table(spark, sf_dir))
    return names.withColumn("short_name", short_name(F.col("service_name")))


# --- dashboard analytics ------------------------------------------------------------


@register("service_health", with_health("SELECT * FROM health"))
def _service_health(spark, sf_dir):
    return health_table(spark, sf_dir)


@register(
    "service_health_window",
    with_health(
        "SELECT * FROM health",
        "WHERE hour_bucket BETWEEN TIMESTAMP '2024-01-24' AND TIMESTAMP '2024-01-31'",
    ),
)
def _service_health_window(spark, sf_dir):
    return health_table(spark, sf_dir, *periods.preset_period("7d", AS_OF))


@register(
    "spikes",
    with_health(
        "SELECT service_name, error_count, total_events, error_rate FROM health WHERE error_rate > 15"
    ),
)
def _spikes(spark, sf_dir):
    return analytics.spikes(health_table(spark, sf_dir))


@register(
    "overall_totals",
    with_health(
        f"""SELECT *, CASE WHEN error_rate > 10 THEN 'red' WHEN error_rate > 3 THEN 'amber'
        ELSE 'green' END AS health FROM (SELECT *,
          {_PERCENT.format(part="total_errors", total="total_events")} AS error_rate FROM (
          SELECT count(*) AS n_services, CAST(sum(total_events) AS BIGINT) AS total_events,
          CAST(sum(error_count) AS BIGINT) AS total_errors FROM health))"""
    ),
)
def _overall_totals(spark, sf_dir):
    return analytics.overall_totals(health_table(spark, sf_dir))


@register(
    "most_active",
    with_registry(
        "SELECT service_name, total_events FROM registry ORDER BY total_events DESC, service_name LIMIT 1"
    ),
)
def _most_active(spark, sf_dir):
    counts = view.log_view(spark, sf_dir).groupBy("service_name").agg(F.count("*").alias("total_events"))
    return analytics.most_active(counts)


_HOUR_TOTALS = "CAST(sum(error_count + warn_count + info_count + debug_count) AS BIGINT) AS total"


@register(
    "peak_hour",
    with_rollup(
        f"""SELECT hour_bucket, {_HOUR_TOTALS} FROM rollup GROUP BY hour_bucket
        ORDER BY total DESC, hour_bucket DESC LIMIT 1"""
    ),
)
def _peak_hour(spark, sf_dir):
    return analytics.peak_hour(rollup_table(spark, sf_dir))


@register(
    "peak_bucket",
    with_rollup(
        """SELECT service_name, hour_bucket,
        error_count + warn_count + info_count + debug_count AS total FROM rollup
        ORDER BY total DESC, hour_bucket DESC, service_name LIMIT 1"""
    ),
)
def _peak_bucket(spark, sf_dir):
    return analytics.peak_bucket(rollup_table(spark, sf_dir))


@register(
    "top_error_services",
    with_health(
        """SELECT row_number() OVER (ORDER BY error_count DESC, service_name) AS rank, service_name,
        error_count, error_count / max(error_count) OVER () * CAST(100 AS DOUBLE) AS pct_of_max
        FROM (SELECT * FROM health WHERE error_count > 0
          ORDER BY error_count DESC, service_name LIMIT 5)"""
    ),
)
def _top_error_services(spark, sf_dir):
    return analytics.top_error_services(health_table(spark, sf_dir))


@register(
    "error_trend",
    with_rollup(
        """SELECT hour_bucket, CAST(sum(error_count) AS BIGINT) AS errors,
        CAST(sum(warn_count) AS BIGINT) AS warns FROM rollup
        GROUP BY hour_bucket ORDER BY hour_bucket DESC LIMIT 12"""
    ),
)
def _error_trend(spark, sf_dir):
    return analytics.error_trend(rollup_table(spark, sf_dir))


@register(
    "severity_split",
    with_rollup(
        f"""SELECT severity, value,
          {_PERCENT.format(part="value", total="sum(value) OVER ()")} AS pct FROM (
          SELECT 'ERROR' AS severity, CAST(sum(error_count) AS BIGINT) AS value FROM rollup
          UNION ALL SELECT 'WARN', CAST(sum(warn_count) AS BIGINT) FROM rollup
          UNION ALL SELECT 'INFO', CAST(sum(info_count) AS BIGINT) FROM rollup
          UNION ALL SELECT 'DEBUG', CAST(sum(debug_count) AS BIGINT) FROM rollup) WHERE value > 0"""
    ),
)
def _severity_split(spark, sf_dir):
    return analytics.severity_split(rollup_table(spark, sf_dir))


@register(
    "severity_mix",
    with_health(
        """SELECT service_name, severity, value,
          CAST(value AS DOUBLE) / sum(value) OVER (PARTITION BY service_name) AS share FROM (
          SELECT service_name, 'ERROR' AS severity, error_count AS value FROM health
          UNION ALL SELECT service_name, 'WARN', warn_count FROM health
          UNION ALL SELECT service_name, 'INFO', info_count FROM health
          UNION ALL SELECT service_name, 'DEBUG', debug_count FROM health) WHERE value > 0"""
    ),
)
def _severity_mix(spark, sf_dir):
    return analytics.severity_mix(health_table(spark, sf_dir))


@register(
    "hourly_volume",
    with_rollup(
        """SELECT hour_bucket, CAST(sum(error_count) AS BIGINT) AS "ERROR",
        CAST(sum(warn_count) AS BIGINT) AS "WARN", CAST(sum(info_count) AS BIGINT) AS "INFO",
        CAST(sum(debug_count) AS BIGINT) AS "DEBUG" FROM rollup GROUP BY hour_bucket"""
    ),
)
def _hourly_volume(spark, sf_dir):
    return rollup.normalize_rollup(analytics.hourly_volume(rollup_table(spark, sf_dir)))


@register(
    "preset_windows",
    with_logs(
        """SELECT preset, count(log_uuid) AS n_events FROM (VALUES ('1h', 1), ('6h', 6), ('12h', 12),
          ('24h', 24), ('7d', 168)) AS p(preset, hours)
        LEFT JOIN logs ON "timestamp" >= TIMESTAMP '2024-01-30 12:00:00' - to_hours(hours)
          AND "timestamp" <= TIMESTAMP '2024-01-30 12:00:00' GROUP BY preset"""
    ),
)
def _preset_windows(spark, sf_dir):
    now = dt.datetime(2024, 1, 30, 12)
    logs = view.log_view(spark, sf_dir)
    names = list(S.PRESET_HOURS)
    inside = {p: search.time_range(*periods.preset_period(p, now)) for p in names}
    widest = max(names, key=S.PRESET_HOURS.get)
    counts = logs.filter(inside[widest]).agg(*[F.count_if(inside[p]).alias(p) for p in names])
    return counts.unpivot([], names, "preset", "n_events")


@register(
    "custom_range",
    with_logs(
        """SELECT service_name, count(*) AS n_events FROM logs WHERE "timestamp" BETWEEN
        TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 23:59:59' GROUP BY service_name"""
    ),
)
def _custom_range(spark, sf_dir):
    start, end = periods.custom_period("2024-01-10", "2024-01-12", AS_OF)
    rows = search.matching(view.log_view(spark, sf_dir), start=start, end=end)
    return rows.groupBy("service_name").agg(F.count("*").alias("n_events"))


# --- ingest -------------------------------------------------------------------------

_CHECKED_DOCUMENTS = """checked AS (
  SELECT *, CASE WHEN length(service) NOT BETWEEN 1 AND 100 THEN 'bad_service'
    WHEN coalesce(severity NOT IN ('DEBUG', 'INFO', 'WARN', 'WARNING', 'ERROR'), true)
      THEN 'bad_severity'
    WHEN length(message) NOT BETWEEN 1 AND 10000 THEN 'bad_message'
    WHEN length(host) > 255 THEN 'bad_host' END AS reason
  FROM (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN '' ELSE source END AS service,
    upper(CASE WHEN doc_id % 11 = 0 THEN 'fatal' WHEN doc_id % 11 = 1 THEN NULL
      WHEN doc_id % 5 = 0 THEN 'Warning' WHEN doc_id % 5 = 1 THEN 'error'
      WHEN doc_id % 5 = 2 THEN 'warn' WHEN doc_id % 5 = 3 THEN 'DEBUG' ELSE 'info' END) AS severity,
    text AS message, CASE WHEN doc_id % 17 = 0 THEN repeat('h', 256) ELSE 'web-1' END AS host,
    CAST(floor(doc_id / 100) AS BIGINT) AS batch_no FROM documents))"""


def checked_documents(spark, sf_dir):
    return ingest.validate(view.document_events(spark, sf_dir))


@register(
    "validate_documents",
    f"WITH {_CHECKED_DOCUMENTS} SELECT doc_id, service, severity, reason FROM checked",
)
def _validate_documents(spark, sf_dir):
    return checked_documents(spark, sf_dir).select("doc_id", "service", "severity", "reason")


@register(
    "ingest_accounting",
    f"""WITH {_CHECKED_DOCUMENTS}
    SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
      coalesce(reason, '') AS reason, count(*) AS n_rows FROM checked GROUP BY ALL""",
)
def _ingest_accounting(spark, sf_dir):
    return ingest.accounting(checked_documents(spark, sf_dir))


_DAMAGED = """lines AS (
  SELECT event_id, event_type AS file, event_id * 100 AS off, CASE event_id % 8
    WHEN 1 THEN concat(good, ' trailing') WHEN 2 THEN concat('[', good, ']')
    WHEN 3 THEN concat(good, ',', good) WHEN 4 THEN 'not json'
    WHEN 5 THEN '{"service":"auth-service","severity":"INFO","message":"no time"}'
    WHEN 6 THEN concat(good, ']') WHEN 7 THEN concat(good, '] {"x":1')
    ELSE good END AS line
  FROM (SELECT l.*, e.event_type, concat('{"timestamp":"', strftime(ts, '%Y-%m-%dT%H:%M:%S'),
    '","service":"', service_name, '","severity":"', severity, '","message":"', event_type, '"}')
    AS good FROM logs l JOIN events e USING (event_id))),
parsed AS (
  SELECT *, CASE WHEN NOT json_valid(line) THEN 'not_json'
    WHEN json_type(line) <> 'OBJECT' OR NOT json_exists(line, '$.timestamp')
      OR NOT json_exists(line, '$.service') OR NOT json_exists(line, '$.severity')
      OR NOT json_exists(line, '$.message') THEN 'missing_key' END AS reason FROM lines)"""


@register("parse_lines", f"WITH {_LOGS},\n{_DAMAGED}\nSELECT event_id, reason FROM parsed")
def _parse_lines(spark, sf_dir):
    return ingest.parse_lines(view.damaged_lines(spark, sf_dir)).select("event_id", "reason")


@register(
    "ingest_lines",
    f"""WITH {_LOGS},\n{_DAMAGED}
    SELECT event_id, parsed.reason, service_name, log_date, date_trunc('second', "timestamp") AS "timestamp",
      severity, file AS message, 'unknown' AS host,
      md5(concat(file, chr(1), CAST(off AS VARCHAR), chr(1), line)) AS log_uuid
    FROM parsed JOIN logs USING (event_id) WHERE reason IS NULL""",
)
def _ingest_lines(spark, sf_dir):
    rows = ingest.ingest_lines(view.damaged_lines(spark, sf_dir)).filter("reason IS NULL")
    return rows.select("event_id", "reason", *S.LOG_COLUMNS[:-1])


@register(
    "ingest_requests",
    f"""WITH {_LOGS},
    sent AS (
      SELECT l.event_id // 5 AS request, l.event_id % 5 AS off, l."timestamp" AS ts, l.severity, e.event_type,
        l.service_name, l.event_id // 5 % 7 AS kind
      FROM logs l JOIN events e USING (event_id))
    SELECT request, off, CASE WHEN kind = 1 AND off = 0 THEN 'bad_severity' END AS reason, kind <> 1 AS batch_ok,
      CASE WHEN kind = 4 AND off < 2 THEN TIMESTAMP '2024-01-31' ELSE date_trunc('second', ts) END AS "timestamp",
      CASE WHEN kind = 1 AND off = 0 THEN 'LOUD' ELSE severity END AS severity, event_type AS message, service_name
    FROM sent WHERE kind NOT IN (2, 3, 5) OR (kind = 3 AND off = 0)
    UNION ALL SELECT DISTINCT request, NULL, 'empty_request', false, NULL, NULL, NULL, NULL FROM sent WHERE kind = 2
    UNION ALL SELECT DISTINCT request, 0, 'not_json', false, NULL, NULL, NULL, NULL FROM sent WHERE kind = 5""",
)
def _ingest_requests(spark, sf_dir):
    rows = ingest.ingest_requests(view.request_bodies(spark, sf_dir), AS_OF)
    known = F.col("reason").isNull() | (F.col("reason") == "bad_severity")
    shown_only = {c: F.when(known, F.col(c)) for c in ("timestamp", "severity", "message", "service_name")}
    return rows.withColumns(shown_only).select("request", "off", "reason", "batch_ok", *shown_only)


@register(
    "batch_gate",
    f"""WITH {_CHECKED_DOCUMENTS}
    SELECT doc_id, batch_no, reason,
      bool_and(reason IS NULL) OVER (PARTITION BY batch_no) AS batch_ok FROM checked""",
)
def _batch_gate(spark, sf_dir):
    gated = ingest.batch_gate(checked_documents(spark, sf_dir), "batch_no")
    return gated.select("doc_id", "batch_no", "reason", "batch_ok")


@register(
    "number_batches",
    f"""WITH {_LOGS},\n{_DAMAGED}
    SELECT event_id, file, CAST(floor((row_number() OVER (PARTITION BY file ORDER BY off) - 1) / 100)
      AS BIGINT) AS batch_no FROM lines""",
)
def _number_batches(spark, sf_dir):
    # Chunks far smaller than the default, so that a file spans many of them.
    numbered = ingest.number_batches(view.damaged_lines(spark, sf_dir), chunk_bytes=64 * 1024)
    return numbered.select("event_id", "file", "batch_no")

"""Filtered newest-first search with keyset pages."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from logbrook import schema as S
from logbrook.functions import (
    clean_keyword,
    contains_text,
    decode_cursor,
    encode_cursor,
)

# Parallel slices of a hot (service, day) group in per_day_newest, per level of ranking.
RANK_SLICES = 64

# Days that search_page reads first when a search has no start.
RECENT_DAYS = (1, 30)


@dataclass(frozen=True)
class Page:
    """One page of results and the token of the next, if there is one."""

    results: DataFrame
    next_cursor: str | None


def all_of(predicates: Iterable[Column | None]) -> Column:
    """AND of the predicates that are given; true when none is."""
    return reduce(lambda a, b: a & b, (p for p in predicates if p is not None), F.lit(True))


def any_of(predicates: Iterable[Column]) -> Column:
    """OR of the predicates; false when there is none."""
    return reduce(lambda a, b: a | b, predicates, F.lit(False))


def _utc(moment: dt.datetime) -> dt.datetime:
    """Naive UTC, the form the tables hold."""
    if moment.tzinfo is None:
        return moment
    return moment.astimezone(dt.timezone.utc).replace(tzinfo=None)


def _at(moment: dt.datetime) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def time_range(start: dt.datetime | None, end: dt.datetime | None) -> Column:
    """Exact inclusive range on ``timestamp``.

    The same bounds are put on ``log_date``: the planner does not derive a partition
    filter from a timestamp, and without one every day of the table would be listed.
    """
    start, end = (m and _utc(m) for m in (start, end))
    return all_of(
        [
            F.col("log_date") >= F.lit(start.date()) if start else None,
            F.col("timestamp") >= _at(start) if start else None,
            F.col("log_date") <= F.lit(end.date()) if end else None,
            F.col("timestamp") <= _at(end) if end else None,
        ]
    )


def day_range(start: dt.datetime | None, end: dt.datetime | None, as_of: dt.datetime) -> Column:
    """Whole days: both ends given = every day between, one given = that day, none = today."""
    first, last = (_utc(m).date() if m else None for m in (start, end))
    if first is None and last is None:
        first = last = _utc(as_of).date()
    first, last = first or last, last or first
    return F.col("log_date").between(F.lit(first), F.lit(last))


def severity_filter(severities: Iterable[str], fold_warning: bool = False) -> Column | None:
    """Membership in a set of severities, in any case. An empty set filters nothing."""
    wanted = sorted({s.upper() for s in severities})
    if not wanted:
        return None
    if fold_warning and {"WARN", "WARNING"} & set(wanted):
        wanted = sorted({*wanted, "WARN", "WARNING"})
    return F.col("severity") == wanted[0] if len(wanted) == 1 else F.col("severity").isin(wanted)


def after_cursor(token: str) -> Column:
    """Rows that sort behind the token's row."""
    ts, log_uuid = decode_cursor(token)
    later_id = (F.col("timestamp") == _at(ts)) & (F.col("log_uuid") > log_uuid)
    return (
        (F.col("log_date") <= F.lit(ts.date()))
        & (F.col("timestamp") <= _at(ts))
        & ((F.col("timestamp") < _at(ts)) | later_id)
    )


def newest_first() -> list[Column]:
    return [F.desc("timestamp"), F.asc("log_uuid")]


def result_columns(logs: DataFrame) -> DataFrame:
    """The fixed columns of a search result, with an empty map for absent metadata."""
    empty = F.create_map().cast("map<string,string>")
    pairs = F.col("metadata") if "metadata" in logs.columns else F.lit(None)
    return logs.select(
        *S.LOG_COLUMNS[:-1],
        F.coalesce(pairs.cast("map<string,string>"), empty).alias("metadata"),
    )


def matching(
    logs: DataFrame,
    service: str | None = None,
    *,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    severity: str | Iterable[str] | None = None,
    q: str | None = None,
    host: str | None = None,
    granularity: str = "time",
    as_of: dt.datetime | None = None,
    fold_warning: bool = False,
    page_token: str | None = None,
) -> DataFrame:
    """All rows that fit the filters, unordered."""
    if granularity == "date":
        if as_of is None and start is None and end is None:
            raise ValueError("whole-day search without a range needs as_of")
        period = day_range(start, end, as_of or start or end)
    elif granularity == "time":
        period = time_range(start, end)
    else:
        raise ValueError(f"granularity must be 'time' or 'date', not {granularity!r}")
    severities = [severity] if isinstance(severity, str) else list(severity or ())
    keyword = clean_keyword(q)
    return logs.filter(
        all_of(
            [
                F.col("service_name") == service if service is not None else None,
                period,
                severity_filter(severities, fold_warning),
                F.col("host") == host if host is not None else None,
                contains_text(F.col("message"), keyword) if keyword else None,
                after_cursor(page_token) if page_token else None,
            ]
        )
    )


def check_limit(limit: int) -> int:
    if not 1 <= limit <= S.SEARCH_MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {S.SEARCH_MAX_LIMIT}")
    return limit


def search(logs: DataFrame, service: str, limit: int = S.SEARCH_DEFAULT_LIMIT, **filters) -> DataFrame:
    """Newest rows of one service that fit the filters of ``matching``.

    Filter, then order and limit: one scan of the pruned partitions and a top-k per task,
    never a full sort.
    """
    return _newest(matching(logs, service, **filters), check_limit(limit))


def search_host(logs: DataFrame, host: str, limit: int = S.SEARCH_DEFAULT_LIMIT, **filters) -> DataFrame:
    """Newest rows of one host across services."""
    return _newest(matching(logs, host=host, **filters), check_limit(limit))


def _newest(rows: DataFrame, n: int) -> DataFrame:
    return result_columns(rows).orderBy(*newest_first()).limit(n)


def search_page(logs: DataFrame, service: str, limit: int = S.SEARCH_DEFAULT_LIMIT, **filters) -> Page:
    """One page and the token of the next one.

    One row more than the page is fetched to learn whether there is a next page. The
    page limit bounds what reaches the driver.

    A search without a start covers the whole history, while its page mostly lies in the
    last days before the token, the end or ``as_of``. So those days are tried first; only
    when they do not fill the page, more are read. The page is the same in any case.
    """
    size = check_limit(limit) + 1
    rows = []
    for start in _starts_to_try(filters):
        fetched = _newest(matching(logs, service, **{**filters, "start": start}), size)
        rows = fetched.collect()
        if len(rows) == size:
            break
    token = None
    if len(rows) > limit:
        last = rows[limit - 1]
        token = encode_cursor(last["timestamp"], last["log_uuid"])
    return Page(logs.sparkSession.createDataFrame(rows[:limit], fetched.schema), token)


def _starts_to_try(filters: dict) -> list[dt.datetime | None]:
    """Start bounds for ``search_page``, nearest first; the caller's own bound comes last."""
    given = filters.get("start")
    token = filters.get("page_token")
    latest = decode_cursor(token)[0] if token else filters.get("end") or filters.get("as_of")
    if given is not None or latest is None or filters.get("granularity", "time") != "time":
        return [given]
    return [*(_utc(latest) - dt.timedelta(days=d) for d in RECENT_DAYS), None]


def newest_per_group(rows: DataFrame, n: int | Column, *keys: str) -> DataFrame:
    """Newest ``n`` rows of every group, with their ``rank`` from 1. ``n`` may be a column.

    A group can hold most of the table, and every scan task may pass ``n`` of its rows on.
    So ranking has two levels: first inside slices of a group (a slice is a set of scan
    tasks, which keeps the cut before the shuffle), then over at most
    ``RANK_SLICES * n`` survivors per group. The slice only spreads work; the result does
    not depend on it.
    """
    sliced = rows.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(RANK_SLICES)))
    by_slice = W.partitionBy(*keys, "_slice").orderBy(*newest_first())
    survivors = (
        sliced.withColumn("_rank", F.row_number().over(by_slice))
        .filter(F.col("_rank") <= n)
        .drop("_rank", "_slice")
    )
    by_group = W.partitionBy(*keys).orderBy(*newest_first())
    ranked = survivors.withColumn("rank", F.row_number().over(by_group).cast("bigint"))
    return ranked.filter(F.col("rank") <= n)


def per_day_newest(logs: DataFrame, n: int) -> DataFrame:
    """Newest ``n`` rows of every service and day."""
    return newest_per_group(logs, n, "service_name", "log_date")


def dedup(logs: DataFrame) -> DataFrame:
    """One row per ``log_uuid``.

    Ids are counted first, by hash and without the rows. Only rows whose id is there twice or
    more are compared, so the others are neither sorted nor shuffled when those ids are few.
    """
    twice = logs.groupBy("log_uuid").count().filter("count > 1").select(F.col("log_uuid").alias("_id"))
    same = F.col("log_uuid").eqNullSafe(F.col("_id"))
    copies = logs.join(twice, same, "left_semi").dropDuplicates(["log_uuid"])
    return logs.join(twice, same, "left_anti").unionByName(copies)

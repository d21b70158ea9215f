"""Saved searches: run every stored parameter set over the log table in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logbrook import schema as S
from logbrook.functions import contains_text
from logbrook.operators.search import newest_per_group


def check_saved(saved: DataFrame) -> DataFrame:
    """Parameter columns of every stored query, and ``reason`` where it cannot be run as it was meant.

    Reasons: ``not_json``, ``no_service``, ``bad_severity``, ``bad_start``, ``bad_end``, ``bad_limit``
    (not a whole number from 1 to the largest page). NULL means the query can be run.
    """

    def given(name: str):
        return F.get_json_object("query_text", f"$.{name}")

    wanted = given("limit").try_cast("int")
    severity = F.upper("p.severity")
    reason = (
        F.when(F.try_parse_json("query_text").isNull(), "not_json")
        .when(F.col("p.service").isNull(), "no_service")
        .when(severity.isNotNull() & ~severity.isin(*S.SEVERITIES), "bad_severity")
        .when(given("start").isNotNull() & F.col("p.start").isNull(), "bad_start")
        .when(given("end").isNotNull() & F.col("p.end").isNull(), "bad_end")
        .when(
            given("limit").isNotNull() & ~F.coalesce(wanted.between(1, S.SEARCH_MAX_LIMIT), F.lit(False)),
            "bad_limit",
        )
    )
    keyword = F.trim("p.q")
    return saved.withColumn("p", F.from_json("query_text", S.SAVED_QUERY_PARAMS)).select(
        F.col("id").alias("query_id"),
        "query_name",
        reason.alias("reason"),
        F.col("p.service").alias("q_service"),
        severity.alias("q_severity"),
        F.when(keyword != "", keyword).alias("q_keyword"),
        F.col("p.start").alias("q_start"),
        F.col("p.end").alias("q_end"),
        F.coalesce(wanted, F.lit(S.SEARCH_DEFAULT_LIMIT)).alias("q_limit"),
    )


def parse_saved(saved: DataFrame) -> DataFrame:
    """The stored queries that can be run."""
    return check_saved(saved).filter("reason IS NULL").drop("reason")


def rejected_saved(saved: DataFrame) -> DataFrame:
    """The stored queries that cannot be run, and why."""
    return check_saved(saved).filter("reason IS NOT NULL").select("query_id", "query_name", "reason")


def saved_query_hits(logs: DataFrame, saved: DataFrame) -> DataFrame:
    """Every (saved query, matching log row).

    Service and severity are equi-join keys, a query without a severity counting for all of
    them; so a row meets only the queries of its own group. The other parameters filter inside
    the join. Whether the queries are broadcast is left to the planner's size estimate; a
    shuffled join of a hot service is split at run time.
    """
    any_severity = F.array(*map(F.lit, S.SEVERITIES))
    params = parse_saved(saved).withColumn(
        "q_kind", F.explode(F.coalesce(F.when(F.col("q_severity").isNotNull(), F.array("q_severity")), any_severity))
    )

    def holds(parameter: str, test):
        return F.col(parameter).isNull() | test

    on = (
        (F.col("service_name") == F.col("q_service"))
        & (F.col("severity") == F.col("q_kind"))
        & holds("q_keyword", contains_text(F.col("message"), F.col("q_keyword")))
        & holds("q_start", F.col("timestamp") >= F.col("q_start"))
        & holds("q_end", F.col("timestamp") <= F.col("q_end"))
    )
    return logs.join(params, on).drop("q_kind")


def run_saved_queries(logs: DataFrame, saved: DataFrame) -> DataFrame:
    """Newest rows of every saved query, up to the limit stored with it, ranked from 1."""
    return newest_per_group(saved_query_hits(logs, saved), F.col("q_limit"), "query_id")

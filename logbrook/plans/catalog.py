"""All registered queries and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logbrook.plans import batch, events_view, stored  # noqa: F401  (registers its queries)
from logbrook.operators.search import search
from logbrook.session import configure


def _configured(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run


def queries():
    return {name: _configured(query) for name, query in batch.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(batch.ORACLES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest 50 rows of one service."""
    logs = events_view.log_view(configure(spark), sf_dir)
    return batch.shown(search(logs, "auth-service"))

"""Every registered query against DuckDB on the same tables."""

import os

import duckdb
import pytest

from logbrook.plans import catalog

TABLES = ("events", "documents")
QUERIES = catalog.queries()
ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS FROM read_parquet('{os.path.join(sf_dir, name)}.parquet')")
    yield con
    con.close()


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return round(value, 9) if isinstance(value, float) else value

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: [str(v) for v in r])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert _rows(result.columns, result.collect()) == _rows(columns, expected.fetchall())

"""Operators that SQL can express, against DuckDB on whole tables."""

import compare
import pytest

from orderlens.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con(folder):
    import duckdb

    connection = duckdb.connect()
    for name in ("documents", "labels", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_sql(name, spark, folder, con):
    assert compare.differences(QUERIES[name](spark, folder), con, ORACLE_SQL[name]) == {}


def test_one_query_per_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, len(QUERIES) + 1)]

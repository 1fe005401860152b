"""Every named query against its SQL counterpart, whole tables, exact values."""

import pytest
from compare import differences, oracle

from orderlens.checks.oracle import ORACLE_SQL
from orderlens.checks.registry import QUERIES


@pytest.fixture(scope="module")
def con(folder):
    connection = oracle(folder)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(name, spark, folder, con):
    assert differences(QUERIES[name](spark, folder), con, ORACLE_SQL[name]) == {}


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 5
    assert QUERIES.keys() <= entry.queries().keys()
    assert ORACLE_SQL.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()

"""Comparing a Spark result with a DuckDB result, exactly and regardless of order."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()

TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def oracle(folder):
    con = duckdb.connect()
    for table in TABLES:
        path = f"{folder}/{table}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{files}'")
    return con


def _key(value):
    if isinstance(value, float) and value == 0 and math.copysign(1, value) < 0:
        return repr(0.0)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def differences(df, con, sql):
    """Empty when both sides have the same columns, types and values."""
    spark_types = {f.name: TYPE_NAMES[f.dataType.simpleString()] for f in df.schema}
    relation = con.sql(sql)
    sql_types = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    if spark_types != sql_types:
        return {n: (spark_types.get(n), sql_types.get(n)) for n in spark_types.keys() | sql_types.keys() if spark_types.get(n) != sql_types.get(n)}
    left, right = _rows(df.columns, df.collect()), _rows(relation.columns, relation.fetchall())
    if left == right:
        return {}
    only_left = [r for r in left if r not in set(right)][:3]
    only_right = [r for r in right if r not in set(left)][:3]
    return {"rows": (len(left), len(right)), "spark only": only_left, "sql only": only_right}

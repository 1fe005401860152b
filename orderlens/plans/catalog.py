"""What the warehouse holds: documented tables, rules and columns with their fill."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.sources.tables import count_rows


def _filled(df, columns):
    """(column, rows_with_value, nb_rows) for several columns from one scan."""
    counted = df.agg(
        F.count("*").alias("nb_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"filled_{i}") for i, c in enumerate(columns)],
    )
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(f"filled_{i}").alias("rows_with_value"))
        for i, c in enumerate(columns)
    ]
    return counted.select("nb_rows", F.inline(F.array(*pairs)))


def _fills(columns, tables):
    """(table, column, rows_with_value, nb_rows) of (table, column) pairs, a scan per table."""
    parts = []
    for name in dict.fromkeys(table for table, _ in columns):
        own = list(dict.fromkeys(column for table, column in columns if table == name))
        parts.append(_filled(tables[name], own).withColumn("table", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


def table_catalog(contract, tables):
    """Documentation of each declared table next to its row count."""
    spark = next(iter(tables.values())).sparkSession
    docs = spark.createDataFrame(
        [(d.table, d.description, d.grain, d.documented_columns) for d in contract.tables],
        "table string, description string, grain string, documented_columns int",
    )
    documented = {d.table for d in contract.tables}
    counts = count_rows({name: df for name, df in tables.items() if name in documented})
    return docs.join(counts.withColumnRenamed("object", "table"), "table", "left").orderBy("table")


def rule_listing(contract, tables):
    """The normalised rules with the number of rows each has to look at."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (
            number,
            rule.table,
            rule.column,
            rule.test,
            [str(v) for v in rule.options["values"]] if "values" in rule.options else None,
            float(rule.options["min"]) if "min" in rule.options else None,
            float(rule.options["max"]) if "max" in rule.options else None,
            rule.options.get("to"),
            rule.options.get("field"),
        )
        for number, rule in enumerate(contract.rules, start=1)
    ]
    rules = spark.createDataFrame(
        rows,
        "rule_no int, table string, column string, test string, values array<string>, "
        "min double, max double, to string, field string",
    )
    columns = [(rule.table, rule.column) for rule in contract.rules]
    return rules.join(_fills(columns, tables), ["table", "column"], "left").orderBy("rule_no")


def documented_columns(contract, tables):
    """Type and description of each documented column next to the rows that fill it."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(d.table, d.column, d.type, d.description) for d in contract.columns]
    docs = spark.createDataFrame(rows, "table string, column string, type string, description string")
    fills = _fills([(d.table, d.column) for d in contract.columns], tables)
    return docs.join(fills, ["table", "column"], "left").orderBy("table", "column")


def column_listing(dictionary, raw):
    """Documented raw columns with the number of lines that fill them."""
    fills = _filled(raw, raw.columns).withColumnRenamed("column", "field")
    return dictionary.join(fills, "field", "left").orderBy("field")

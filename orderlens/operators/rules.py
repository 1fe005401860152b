"""Counting the rows that break quality rules.

Row rules of one table are columns of a single aggregate, so any number of them
costs one scan. Uniqueness and reference rules need a shuffle on their key and get
one aggregate each; both shrink to one row per key before they are shuffled, so a
key that fills a third of the table weighs no more than any other.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators.distinct import with_distinct_count

ROW_TESTS = ("not_null", "positive", "accepted_values", "accepted_range")
KEY_TESTS = ("unique", "relationships")

# Detail texts of the result table.
DETAIL_VALUES = "domaine autorise : {}"
DETAIL_BOUNDS = "bornes : {}"
DETAIL_REFERENCE = "-> {}.{}"
DETAIL_UNKNOWN = "test inconnu"


def detail(rule):
    if rule.test == "accepted_values":
        return DETAIL_VALUES.format(rule.options["values"])
    if rule.test == "accepted_range":
        return DETAIL_BOUNDS.format(rule.options)
    if rule.test == "relationships":
        return DETAIL_REFERENCE.format(rule.options["to"], rule.options["field"])
    return "" if rule.test in ROW_TESTS + KEY_TESTS else DETAIL_UNKNOWN


def breaks(df, rule):
    """Predicate of a row that breaks a row rule; NULL only ever breaks not_null."""
    value = F.col(f"`{rule.column}`")
    if rule.test == "not_null":
        return value.isNull()
    if rule.test == "positive":
        return value <= 0
    if rule.test == "accepted_values":
        # The allowed list is compared as text.
        if not isinstance(df.schema[rule.column].dataType, T.StringType):
            value = value.cast("string")
        return ~value.isin([str(v) for v in rule.options["values"]])
    broken = F.lit(False)
    if "min" in rule.options:
        broken = broken | (value < rule.options["min"])
    if "max" in rule.options:
        broken = broken | (value > rule.options["max"])
    return broken


def count_breaks(df, rules):
    """One row counting the breaks of each row rule; ``rules`` maps numbers to rules."""
    return df.agg(*[F.count_if(breaks(df, r)).alias(f"rule_{n}") for n, r in rules.items()])


def duplicate_surplus(df, column):
    """Rows beyond the first of each value; NULL is a value of its own.

    Of whole numbers the bits of buckets are counted (see ``distinct``), so the shuffle
    has a row for 1,024 neighbours; of other types every value is counted.
    """
    if isinstance(df.schema[column].dataType, T.IntegralType):
        found = with_distinct_count(df, [], column, "known", [F.count("*").alias("n"), F.count_if(F.col(f"`{column}`").isNull()).alias("missing")])
        firsts = F.col("known") + F.least(F.col("missing"), F.lit(1))
        return found.select((F.col("n") - firsts).alias("failing_rows"))
    groups = df.groupBy(f"`{column}`").agg(F.count("*").alias("n"))
    surplus = F.sum(F.col("n") - 1)
    return groups.agg(F.coalesce(surplus, F.lit(0)).alias("failing_rows"))


def orphan_rows(child, column, parent, field):
    """Rows whose key is missing in the parent, with SQL ``NOT IN`` semantics.

    A NULL among the parent keys makes every membership test unknown, hence zero
    failing rows; ``parent_has_null`` and ``unmatched_rows`` say what that hides.

    Both sides are counted per key in one aggregation over their union. Nothing is
    broadcast, each side is read once, and neither side's repetition of a key
    reaches the shuffle.
    """
    key = F.col(f"`{column}`")
    children = child.where(key.isNotNull()).select(key.alias("k"), F.lit(1).alias("n"), F.lit(False).alias("p"))
    parents = parent.select(F.col(f"`{field}`").alias("k"), F.lit(0).alias("n"), F.lit(True).alias("p"))
    keys = children.union(parents).groupBy("k").agg(F.sum("n").alias("n"), F.bool_or("p").alias("known"))
    found = keys.agg(
        F.coalesce(F.sum(F.when(~F.col("known"), F.col("n"))), F.lit(0)).alias("unmatched_rows"),
        F.coalesce(F.bool_or(F.col("k").isNull()), F.lit(False)).alias("parent_has_null"),
    )
    failing = F.when(F.col("parent_has_null"), F.lit(0)).otherwise(F.col("unmatched_rows"))
    return found.withColumn("failing_rows", failing.cast("bigint"))

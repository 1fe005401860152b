"""Sums per group from order lines, or from a cube that holds those of many groupings.

All figures of the exploration follow from sums and counts that add up. A cube has them for
every grouping of the breakdowns, from one scan: one aggregation over grouping sets, whose
small result is written aside.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import measures as M
from orderlens.operators.distinct import BUCKET, added_up, bits_set, with_bucket, with_distinct_count
from orderlens.operators.filters import without_null_keys
from orderlens.sources.tables import written_aside

ORDERS = "nb_orders"
_AVERAGED = ("delay_days", "days_real", "days_scheduled", "discount_rate")


#: Sums, which are NULL where there is nothing to add; everything else counts.
_TOTALS = {"sales": "sales", "profit": "profit", "units": "quantity"} | {f"_{c}_sum": c for c in _AVERAGED}


def additive():
    """Sums and counts of lines, by name."""
    counts = {"nb_lines": F.count("*"), "_kept": F.count_if(M.kept())}
    for flag in ("is_late", "is_on_time"):
        counts |= dict(zip(M.count_names(flag), M.flag_counts(flag)))
    counts |= {f"_{c}_n": F.count(c) for c in _AVERAGED}
    totals = {"_identified": M.identified_sales()} | {name: F.sum(c) for name, c in _TOTALS.items()}
    return {name: column.alias(name) for name, column in (counts | totals).items()}


def mean(column):
    """Mean of a column of ``_AVERAGED`` from its sums."""
    return M.safe_ratio(F.col(f"_{column}_sum"), F.col(f"_{column}_n"))


@dataclass(frozen=True)
class Cube:
    """Sums of a selection for each of some groupings; every breakdown over them takes it in place of lines."""

    rows: DataFrame
    numbers: dict

    def sums(self, keys, names, orders=False):
        """One row per group with a value in every key; without keys always one row."""
        number, with_orders = self.numbers.get(tuple(keys), (None, False))
        if number is None or (orders and not with_orders):
            raise ValueError(f"the cube has no such grouping: {list(keys)}{' with orders' if orders else ''}")
        rows = self.rows.where(F.col("grouped_by") == number)
        if keys:
            return without_null_keys(rows, *keys)
        # No line, no row; the counts of nothing are 0 all the same.
        null_of_nothing = {"_identified", *_TOTALS}
        one = {n: F.sum(n) if n in null_of_nothing else F.coalesce(F.sum(n), F.lit(0)) for n in (ORDERS, *names)}
        return rows.agg(*[column.alias(n) for n, column in one.items()])


def cube(lines, groupings, with_orders=()):
    """The sums of every grouping, a tuple of columns each, from one scan of the lines.

    Groupings in ``with_orders`` also count distinct orders: their rows are made per bucket
    of 1,024 order numbers first, and the buckets then add up, like everything else. What is
    written has a row per group.
    """
    keys = list(dict.fromkeys(k for g in groupings for k in g))
    columns = [*keys, BUCKET]
    sets = {g: [*g, BUCKET] if g in with_orders else list(g) for g in groupings}
    numbers = {g: sum(1 << i for i, c in enumerate(reversed(columns)) if c not in s) for g, s in sets.items()}
    sums = list(additive().values())
    lines = with_bucket(lines, "order_id")
    grouped = lines.groupingSets([[F.col(c) for c in s] for s in sets.values()], *[F.col(c) for c in columns])
    words = grouped.agg(F.grouping_id().alias("grouped_by"), bits_set().alias(ORDERS), *sums)
    rows = words.groupBy("grouped_by", *keys).agg(F.sum(ORDERS).alias(ORDERS), *added_up(lines, sums))
    return Cube(written_aside(rows), {g: (numbers[g], g in with_orders) for g in groupings})


def sums(selection, keys, *names, orders=False):
    """Sums and counts by name, after the keys and, if asked for, distinct orders.

    ``selection`` has lines or is a cube of them. Groups without a value in a key are
    left out.
    """
    if isinstance(selection, Cube):
        grouped = selection.sums(keys, names, orders)
    else:
        wanted = [additive()[n] for n in names]
        lines = without_null_keys(selection, *keys) if keys else selection
        if orders:
            grouped = with_distinct_count(lines, keys, "order_id", ORDERS, wanted)
        else:
            grouped = lines.groupBy(*keys).agg(*wanted)
    return grouped.select(*keys, *([ORDERS] if orders else []), *names)

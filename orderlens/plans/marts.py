"""The four aggregate marts over the fact.

Every figure of a mart follows from sums and counts, so a mart is its keys, a final
projection and an order. It can be made from the lines alone or, in a rebuild, with all
others in one pass: grouping sets over the keys of all marts, whose rows each mart then
picks and adds up. Distinct orders are bits in buckets of 1,024 order numbers, so they add up
too. NULL group keys are kept, and sorted last.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import functions as F

from orderlens.functions import measures as M
from orderlens.operators.distinct import BUCKET, bits_set, with_bucket, with_distinct_count

_SUMMED = ("sales", "profit", "quantity")
_AVERAGED = ("delay_days", "days_real", "days_scheduled", "discount_rate")
def _additive():
    """Sums and counts of lines from which all figures follow, by name."""
    sums = {
        "nb_lines": F.count("*"),
        "late": F.count_if("is_late"),
        "on_time": F.count_if("is_on_time"),
        "kept": F.count_if(M.kept()),
    }
    sums |= {f"{c}_sum": F.sum(c) for c in (*_SUMMED, *_AVERAGED)}
    return sums | {f"{c}_n": F.count(c) for c in _AVERAGED}


def _sums():
    return [c.alias(n) for n, c in _additive().items()]


def _amount(name):
    return M.round_to(F.col(f"{name}_sum").cast("double"), 2).alias(name)


def _mean(name):
    return M.round_to(M.safe_ratio(F.col(f"{name}_sum"), F.col(f"{name}_n")), 2).alias(f"avg_{name}")


def _rate(name, alias):
    return M.round_to(M.percent_of(F.col(name), F.col("kept")), 1).alias(alias)


def _margin():
    return M.round_to(M.percent_of(F.col("profit_sum"), F.col("sales_sum")), 1).alias("margin_pct")


def _last(name):
    return F.col(name).asc_nulls_last()


@dataclass(frozen=True)
class Mart:
    """Keys, figures and order of a mart; the latter two as functions, for want of a session."""

    keys: tuple
    figures: Callable
    order: Callable
    with_orders: bool = False

    def __call__(self, fact):
        """The mart from order lines."""
        if self.with_orders:
            return self._finished(with_distinct_count(fact, self.keys, "order_id", "nb_orders", _sums()))
        return self._finished(fact.groupBy(*self.keys).agg(*_sums()))

    def rolled_up(self, totals):
        """The mart from the rows of ``totals_of_all`` that belong to its keys."""
        return self._finished(totals.where(F.col("grouped_by") == _grouping_number(self)))

    def _finished(self, grouped):
        orders = ["nb_orders"] if self.with_orders else []
        return grouped.select(*self.keys, *orders, *self.figures()).orderBy(*self.order())


def _discount():
    mean = M.safe_ratio(F.col("discount_rate_sum"), F.col("discount_rate_n"))
    return M.round_to(100.0 * mean, 1).alias("avg_discount_pct")


monthly_performance = Mart(
    ("order_month", "order_year"),
    lambda: [
        "nb_lines", _amount("sales"), _amount("profit"), _margin(), _rate("late", "late_rate_pct"),
        _rate("on_time", "on_time_rate_pct"), _mean("delay_days"),
    ],
    lambda: [_last("order_month")],
    with_orders=True,
)
shipping_mode = Mart(
    ("shipping_mode",),
    lambda: [
        "nb_lines", _rate("late", "late_rate_pct"), _mean("days_real"), _mean("days_scheduled"),
        _mean("delay_days"), _amount("sales"), _amount("profit"),
    ],
    lambda: [F.col("late_rate_pct").desc(), _last("shipping_mode")],
)
category_finance = Mart(
    ("department_name", "category_name"),
    lambda: [
        "nb_lines", F.col("quantity_sum").alias("units_sold"), _amount("sales"), _amount("profit"),
        _margin(), _discount(), _rate("late", "late_rate_pct"),
    ],
    lambda: [F.col("sales").desc(), _last("department_name"), _last("category_name")],
)
region = Mart(
    ("market", "order_region"),
    lambda: [_amount("sales"), _amount("profit"), _margin(), _rate("late", "late_rate_pct")],
    lambda: [F.col("sales").desc(), _last("market"), _last("order_region")],
    with_orders=True,
)

MARTS = {
    "mart_monthly_performance": monthly_performance,
    "mart_shipping_mode": shipping_mode,
    "mart_category_finance": category_finance,
    "mart_region": region,
}

_KEYS = list(dict.fromkeys(k for mart in MARTS.values() for k in mart.keys))


def _grouping_set(mart):
    """Keys of a mart, and the bucket of its orders where it counts them."""
    return [*mart.keys, BUCKET] if mart.with_orders else list(mart.keys)


def _grouping_number(mart):
    """What ``grouping_id`` says of a mart's rows: a bit for every column that is not grouped by."""
    present = _grouping_set(mart)
    return sum(1 << i for i, c in enumerate(reversed([*_KEYS, BUCKET])) if c not in present)


def totals_of_all(fact):
    """Sums and counts of all marts from one scan of the fact.

    One aggregation over grouping sets makes a row per group of each mart, or per group and
    bucket of order numbers; the buckets then add up to a row per group. ``grouped_by`` tells
    the marts apart.
    """
    sets = [[F.col(c) for c in _grouping_set(mart)] for mart in MARTS.values()]
    grouped = with_bucket(fact, "order_id").groupingSets(sets, *_KEYS, BUCKET)
    words = grouped.agg(F.grouping_id().alias("grouped_by"), bits_set().alias("nb_orders"), *_sums())
    return words.groupBy("grouped_by", *_KEYS).agg(*[F.sum(n).alias(n) for n in ("nb_orders", *_additive())])

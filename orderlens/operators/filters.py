"""The filter set of the exploration layer."""

from dataclasses import dataclass

from pyspark.sql import functions as F


@dataclass(frozen=True)
class Filters:
    """Inclusive month range (``YYYY-MM``) and value lists; ``None`` means all.

    "All" means every value present, so a line without a market, mode or segment
    is never selected.
    """

    month_from: str | None = None
    month_to: str | None = None
    markets: tuple | None = None
    modes: tuple | None = None
    segments: tuple | None = None


def _month(text):
    return F.lit(f"{text}-01").cast("timestamp_ntz")


def _number(text):
    """Months since year 0."""
    return int(text[:4]) * 12 + int(text[5:])


def month_range(month_from=None, month_to=None, number=None):
    """Range on the stored month, repeated for pruning on the partition column and, by name, the month's number."""
    tests = [F.lit(True)]
    if month_from:
        tests += [F.col("order_month") >= _month(month_from), F.col("order_year") >= int(month_from[:4])]
        tests += [F.col(number) >= _number(month_from)] if number else []
    if month_to:
        tests += [F.col("order_month") <= _month(month_to), F.col("order_year") <= int(month_to[:4])]
        tests += [F.col(number) <= _number(month_to)] if number else []
    return _all(tests)


def one_of(column, values=None):
    if values is None:
        return F.col(column).isNotNull()
    return F.col(column).isin(list(values))


def _all(tests):
    result = tests[0]
    for test in tests[1:]:
        result = result & test
    return result


def apply_filters(fact, filters=Filters()):
    """One conjunction on stored columns, so all of it reaches the scan."""
    number = fact.schema["order_month"].metadata.get("number")
    return fact.where(
        month_range(filters.month_from, filters.month_to, number)
        & one_of("market", filters.markets)
        & one_of("shipping_mode", filters.modes)
        & one_of("customer_segment", filters.segments)
    )


def without_null_keys(df, *keys):
    return df.dropna(subset=list(keys))

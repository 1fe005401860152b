"""Exploration queries over a filtered fact.

Each takes the lines kept by ``apply_filters``, or ``breakdown_cube`` of them, and returns
a small table. Lines without a value in a group key are left out. Rates read only lines
that were not cancelled, as conditions inside the aggregate, so the lines are scanned
once even where a result combines all lines with the kept ones.
"""

from pyspark.sql import functions as F

from orderlens.functions import measures as M
from orderlens.functions.timestamps import month_label
from orderlens.operators import histogram, ranking
from orderlens.operators.cube import Cube, cube, mean, sums

DEFAULT_TARGET = 20

# Sizes and quantiles of the ranked breakdowns.
TOP_REGIONS = 12
TOP_DEPARTMENTS = 11
TOP_COUNTRIES = 12
CATEGORY_ENDS = 6
MARGIN_SALES_QUANTILE = 0.4
DISCOUNT_SALES_QUANTILE = 0.3
DELAY_BINS = 20


#: What the breakdowns group by; those that count orders are named again.
GROUPINGS = [
    (),
    ("order_month",),
    ("order_month", "customer_segment"),
    ("delivery_status",),
    ("shipping_mode",),
    ("delay_days",),
    ("order_region",),
    ("department_name",),
    ("category_name",),
    ("market",),
    ("order_country",),
    ("customer_segment",),
    ("customer_segment", "market"),
]
WITH_ORDERS = [(), ("market",), ("customer_segment",)]


def breakdown_cube(selection):
    """What all breakdowns need of a selection, from one scan of its lines."""
    return cube(selection, GROUPINGS, WITH_ORDERS)


def is_empty(selection):
    if isinstance(selection, Cube):
        return selection.sums((), ["nb_lines"]).first()["nb_lines"] == 0
    return selection.isEmpty()


def _basket():
    """Mean amount per order."""
    return M.safe_ratio(F.col("_identified"), F.col("nb_orders"))


def _with_margin(df):
    return df.withColumn("margin", M.margin(F.col("profit"), F.col("sales")))


def _amounts(selection, keys, *names):
    """Sums of amounts, handed out as doubles."""
    return _handed_out(sums(selection, keys, *names), *names)


def _late_rates(selection, key):
    """Late rate of every group that has a kept line."""
    counts = sums(selection, [key], "_kept", *M.count_names("is_late"))
    return _having_kept(counts).select(key, M.rate_of_counts("is_late").alias("late_rate"))


def _handed_out(df, *names):
    return df.withColumns({name: F.col(name).cast("double") for name in names})


# --- option lists --------------------------------------------------------------


def month_options(fact):
    months = fact.select("order_month").dropna().distinct()
    return months.select(month_label(F.col("order_month")).alias("month")).orderBy("month")


def dimension_options(fact):
    """Distinct values per filter dimension, from one pass over the combinations."""
    dimensions = ["market", "shipping_mode", "customer_segment"]
    combinations = fact.select(dimensions).distinct()
    pairs = [F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dimensions]
    values = combinations.select(F.inline(F.array(*pairs)))
    return values.dropna().distinct().orderBy("dimension", "value")


# --- headline ------------------------------------------------------------------


def header_counts(selection):
    return sums(selection, [], "nb_lines", orders=True)


def overall_late_rate(selection):
    return selection.agg(M.overall_late_rate().alias("late_rate"))


def overall_on_time_rate(selection):
    return selection.agg(M.flag_rate("is_on_time").alias("on_time_rate"))


def average_basket(selection):
    return sums(selection, [], "_identified", orders=True).select(_basket().alias("avg_basket"))


def kpi_cards(selection, late_target=DEFAULT_TARGET):
    counts = [*M.count_names("is_late"), *M.count_names("is_on_time"), "_kept", "_delay_days_sum", "_delay_days_n"]
    totals = sums(selection, [], "sales", "profit", "_identified", *counts, orders=True)
    late = F.when(F.col("_kept") == 0, 0.0).otherwise(M.rate_of_counts("is_late"))
    figures = totals.select(
        late.alias("late_rate"),
        M.rate_of_counts("is_on_time").alias("on_time_rate"),
        mean("delay_days").alias("avg_delay_days"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in ("sales", "profit")],
        _basket().alias("avg_basket"),
    )
    margin = F.coalesce(M.margin(F.col("profit"), F.col("sales")), F.lit(0.0))
    return figures.withColumn("margin", margin).withColumns(
        {
            "gap_to_target": F.col("late_rate") - late_target,
            "late_tone": M.late_target_tone(F.col("late_rate"), late_target),
            "delay_tone": M.delay_tone(F.col("avg_delay_days")),
            "margin_tone": M.margin_tone(F.col("margin")),
        }
    )


# --- over time -----------------------------------------------------------------


def monthly_sales_profit(selection):
    return _amounts(selection, ["order_month"], "sales", "profit").orderBy("order_month")


def monthly_late_rate(selection, late_target=DEFAULT_TARGET):
    rates = _late_rates(selection, "order_month")
    return rates.withColumn("target", F.lit(late_target)).orderBy("order_month")


def monthly_sales_by_segment(selection):
    keys = ["order_month", "customer_segment"]
    return _amounts(selection, keys, "sales").orderBy(*keys)


# --- logistics -----------------------------------------------------------------


def delivery_status_share(selection):
    counts = sums(selection, ["delivery_status"], "nb_lines").withColumnRenamed("nb_lines", "n")
    shares = ranking.share_of_total(counts, "n", "share_pct")
    return shares.orderBy(F.col("n").desc(), F.col("delivery_status"))


def late_rate_by_mode(selection):
    rates = _late_rates(selection, "shipping_mode")
    toned = rates.withColumn("tone", M.late_rate_tone(F.col("late_rate")))
    return toned.orderBy("late_rate", "shipping_mode")


def days_real_vs_scheduled(selection):
    days = ("days_real", "days_scheduled")
    totals = sums(selection, ["shipping_mode"], *[f"_{c}_{part}" for c in days for part in ("sum", "n")])
    means = totals.select("shipping_mode", *[mean(c).alias(f"avg_{c}") for c in days])
    return means.orderBy("shipping_mode")


def delay_histogram(selection):
    return sums(selection, ["delay_days"], "nb_lines").orderBy("delay_days")


def delay_histogram_bins(selection, bins=DELAY_BINS):
    if isinstance(selection, Cube):
        return histogram.equal_width(sums(selection, ["delay_days"], "nb_lines"), "delay_days", bins, "nb_lines")
    return histogram.equal_width(selection, "delay_days", bins)


def late_rate_top_regions(selection, k=TOP_REGIONS):
    return ranking.top_k(_late_rates(selection, "order_region"), "late_rate", "order_region", k)


# --- finance -------------------------------------------------------------------


def department_top_sales(selection, k=TOP_DEPARTMENTS):
    return ranking.top_k(
        _amounts(selection, ["department_name"], "sales", "profit"), "sales", "department_name", k
    )


def sales_quantiles(selection, group="category_name", quantiles=(0.3, 0.4)):
    """Interpolated quantiles of the sales per group, one row."""
    grouped = ranking.grouped_aside(_amounts(selection, [group], "sales"), "sales")
    found = grouped.quantiles(quantiles)
    named = [F.lit(value).cast("double").alias(f"q{round(q * 100)}") for q, value in zip(quantiles, found)]
    return grouped.rows.sparkSession.range(1).select(*named)


def category_margin_topflop(selection, group="category_name"):
    """Lowest and highest margins among groups that sell enough."""
    grouped = ranking.grouped_aside(_amounts(selection, [group], "sales", "profit"), "sales")
    selling = _with_margin(grouped.above_quantile(MARGIN_SALES_QUANTILE))
    ends = ranking.both_ends(selling, "margin", group, CATEGORY_ENDS)
    return ends.withColumn("tone", M.category_tone(F.col("margin"))).orderBy("side", "position")


def discount_vs_margin(selection):
    totals = sums(selection, ["category_name"], "_discount_rate_sum", "_discount_rate_n", "profit", "sales", "units")
    discount = (mean("discount_rate") * 100.0).alias("discount")
    grouped = _handed_out(totals.select("category_name", discount, "profit", "sales", "units"), "profit", "sales")
    selling = ranking.grouped_aside(grouped, "sales").above_quantile(DISCOUNT_SALES_QUANTILE)
    return _with_margin(selling).orderBy("category_name")


# --- places --------------------------------------------------------------------


def sales_by_market(selection):
    return _amounts(selection, ["market"], "sales").orderBy("sales", "market")


def region_sales_late(selection, k=TOP_REGIONS):
    """Best-selling regions with their late rate.

    Joining the sales of all lines to the rate of kept lines drops a region with
    only cancelled lines; one aggregate and a test on the kept lines does too.
    """
    totals = _handed_out(sums(selection, ["order_region"], "sales", "_kept", *M.count_names("is_late")), "sales")
    grouped = totals.select("order_region", "sales", M.rate_of_counts("is_late").alias("late_rate"), "_kept")
    return ranking.top_k(_having_kept(grouped), "sales", "order_region", k)


def country_top_sales(selection, k=TOP_COUNTRIES):
    return ranking.top_k(_amounts(selection, ["order_country"], "sales"), "sales", "order_country", k)


def _having_kept(grouped):
    return grouped.where(F.col("_kept") > 0).drop("_kept")


def _summary(selection, key):
    totals = sums(selection, [key], "sales", "profit", *M.count_names("is_late"), "_kept", orders=True)
    grouped = _handed_out(totals, "sales", "profit").withColumn("late_rate", M.rate_of_counts("is_late"))
    return _with_margin(_having_kept(grouped)).drop(*M.count_names("is_late"))


def market_summary(selection):
    return _summary(selection, "market").orderBy(F.col("sales").desc(), F.col("market"))


# --- segments ------------------------------------------------------------------


def segment_summary(selection):
    summary = _summary(selection, "customer_segment")
    return summary.withColumn("tone", M.margin_tone(F.col("margin"))).orderBy("customer_segment")


def profit_segment_market(selection):
    keys = ["customer_segment", "market"]
    return _amounts(selection, keys, "profit").orderBy(*keys)

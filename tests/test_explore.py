import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.operators import histogram, ranking
from orderlens.operators.filters import Filters, apply_filters
from orderlens.plans import explore
from orderlens.schema import CANCELED, EARLY, LATE, ON_TIME


def listed(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_default_selection_drops_lines_without_a_dimension(make_fact):
    lines = make_fact({}, {"market": None}, {"shipping_mode": None}, {"customer_segment": None})
    assert apply_filters(lines).count() == 1


def test_month_range_is_inclusive(make_fact):
    days = [(2015, 12, 31), (2016, 1, 1), (2016, 1, 31), (2016, 2, 29), (2016, 3, 1)]
    lines = make_fact(*[{"order_ts": dt.datetime(*d, 23, 59)} for d in days])
    kept = apply_filters(lines, Filters(month_from="2016-01", month_to="2016-02"))
    assert sorted(r["order_id"] for r in kept.collect()) == [2, 3, 4]
    assert apply_filters(lines, Filters(month_from="2016-02")).count() == 2
    assert apply_filters(lines, Filters(month_to="2016-01")).count() == 3


def test_value_lists_and_their_conjunction(make_fact):
    lines = make_fact({}, {"market": "Africa"}, {"market": "Africa", "shipping_mode": "Same Day"}, {"market": None})
    assert apply_filters(lines, Filters(markets=("Africa",))).count() == 2
    assert apply_filters(lines, Filters(markets=("Africa",), modes=("Same Day",))).count() == 1
    nothing = apply_filters(lines, Filters(segments=()))
    assert explore.is_empty(nothing) and not explore.is_empty(lines)


def test_filters_only_shrink(house):
    fact = house.fact()
    everything = apply_filters(fact).count()
    narrow = apply_filters(fact, Filters(month_from="1997-01", markets=("ASIA",))).count()
    assert 0 < narrow < everything <= fact.count()


def test_options_are_sorted_and_without_null(make_fact):
    lines = make_fact({"order_ts": dt.datetime(2017, 5, 2)}, {"market": None}, {"market": "Africa"}, {"market": "Africa"})
    assert listed(explore.month_options(lines), "month") == [("2016-03",), ("2017-05",)]
    assert listed(explore.dimension_options(lines), "dimension", "value") == [
        ("customer_segment", "Consumer"),
        ("market", "Africa"),
        ("market", "Europe"),
        ("shipping_mode", "First Class"),
    ]


def test_kpis(make_fact):
    lines = make_fact(
        {"order_id": 1, "sales": 100, "profit": 5},
        {"order_id": 1, "sales": 50, "profit": 5, "delivery_status": EARLY, "days_real": 1},
        {"order_id": 2, "sales": 50, "profit": 10, "delivery_status": CANCELED},
        {"order_id": None, "sales": 100, "profit": 0, "delivery_status": ON_TIME, "days_real": 2},
    )
    row = explore.kpi_cards(lines, late_target=20).first()
    assert row["late_rate"] == pytest.approx(100 / 3) and row["on_time_rate"] == pytest.approx(200 / 3)
    assert row["avg_delay_days"] == 0.25 and row["avg_basket"] == 100.0
    assert (row["sales"], row["profit"]) == (300.0, 20.0)
    assert row["gap_to_target"] == pytest.approx(100 / 3 - 20)
    assert (row["late_tone"], row["delay_tone"], row["margin_tone"]) == ("warn", "good", "warn")
    assert explore.average_basket(lines).first()[0] == 100.0


def test_kpis_of_an_empty_selection(make_fact):
    row = explore.kpi_cards(make_fact({}).where("false")).first()
    assert (row["late_rate"], row["on_time_rate"], row["sales"], row["margin"], row["avg_basket"]) == (0.0, None, 0.0, 0.0, None)
    assert tuple(explore.header_counts(make_fact({}).where("false")).first()) == (0, 0)


def test_zero_sales_margins(make_fact):
    lines = make_fact({"sales": 0, "profit": 3})
    assert explore.kpi_cards(lines).first()["margin"] == 0.0
    assert explore.market_summary(lines).first()["margin"] is None


def test_region_with_only_cancelled_lines_is_left_out(make_fact):
    lines = make_fact({}, {"order_region": "Oceania", "sales": 900, "delivery_status": CANCELED}, {"order_region": None})
    assert listed(explore.region_sales_late(lines), "order_region", "sales", "late_rate") == [("Western Europe", 100.0, 100.0)]
    gone = make_fact({"market": "Africa", "delivery_status": CANCELED}, {})
    assert listed(explore.market_summary(gone), "market") == [("Europe",)]
    assert listed(explore.segment_summary(gone), "customer_segment", "nb_orders") == [("Consumer", 2)]


def test_null_keys_are_left_out(make_fact):
    lines = make_fact({}, {"order_country": None}, {"department_name": None}, {"category_name": None}, {"delivery_status": None})
    assert explore.country_top_sales(lines).first()["sales"] == 400.0
    assert explore.department_top_sales(lines).first()["sales"] == 400.0
    assert listed(explore.delivery_status_share(lines), "delivery_status", "n", "share_pct") == [(LATE, 4, 100.0)]


def test_top_k_comes_smallest_first_and_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0), ("d", 2.0), ("e", 2.0)], "k string, v double")
    assert listed(ranking.top_k(df, "v", "k", 3), "k") == [("d",), ("c",), ("b",)]
    assert len(ranking.top_k(df, "v", "k", 9).collect()) == 5


@pytest.mark.parametrize("n", [1, 2, 5, 11, 12, 13, 30])
def test_both_ends_equal_two_cuts(spark, n):
    values = [(f"k{i:02d}", float((i * 7) % n)) for i in range(n)]
    df = spark.createDataFrame(values, "k string, v double").repartition(5)
    ordered = [k for k, _ in sorted(values, key=lambda p: (p[1], p[0]))]
    found = ranking.both_ends(df, "v", "k", 6).collect()
    side = lambda s: [r["k"] for r in sorted(found, key=lambda r: r["position"]) if r["side"] == s]
    assert side("flop") == ordered[:6] and side("top") == ordered[-6:]


@pytest.mark.parametrize("q", [0.0, 0.3, 0.4, 0.5, 1.0])
@pytest.mark.parametrize("n", [1, 2, 6, 11, 26])
def test_quantile_cut(spark, n, q):
    values = [float((i * i) % 17) for i in range(n)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, v double").repartition(4)
    kept = sorted(r["v"] for r in ranking.above_quantile(df, "v", q).collect())
    assert kept == sorted(v for v in values if v > np.quantile(values, q))


@pytest.mark.parametrize(
    "values",
    [
        [5e-324, 0.0, 1e-300, 1.0, 1e300, -1e308, 1.7e308, 3.0, 3.0, 3.0],
        [1.0, 1.0 + 2**-52, 1.0 + 2**-51, 1.0, 2.0**60],
        [float("nan"), None, float("inf"), 7.5, -2.25, float("-inf")],
        [4.0] * 9,
        [],
    ],
)
def test_quantiles_of_far_flung_values(spark, values):
    """Values that one bin of the first passes holds together, and those without a rank."""
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    known = sorted(v for v in values if v is not None and abs(v) < float("inf"))
    qs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    found = ranking.grouped_aside(df, "v").quantiles(qs)
    if not known:
        assert found == [None] * len(qs)
        return
    for q, value in zip(qs, found):
        rank = q * (len(known) - 1)
        low, high = known[int(rank)], known[min(int(rank) + 1, len(known) - 1)]
        assert value == (low if rank == int(rank) else low + (rank - int(rank)) * (high - low))


def test_quantiles_of_many_groups_need_few_passes(spark):
    """A million skewed values, a third of them equal; every pass hands on counts, not values."""
    v = F.when(F.col("id") % 3 == 0, 2.5).otherwise(F.exp(F.rand(1) * 12))
    rows = spark.range(1_000_000).select(v.alias("v"))
    grouped = ranking.grouped_aside(rows, "v")
    values = np.array([r[0] for r in grouped.rows.collect()])
    for q, value in zip((0.1, 0.3, 0.9999), grouped.quantiles((0.1, 0.3, 0.9999))):
        assert value == pytest.approx(np.quantile(values, q), rel=1e-15)


def test_bins_of_amounts_shuffle_counts_only(spark, make_fact):
    lines = make_fact(*[{"sales": f"{(i * 37) % 101}.{i % 100:02d}"} for i in range(400)])
    found = histogram.equal_width(lines, "sales", 20)
    counts, _ = np.histogram([float(r["sales"]) for r in lines.collect()], bins=20)
    assert {r["bin"]: r["nb_lines"] for r in found.collect()} == {i + 1: c for i, c in enumerate(counts) if c}
    assert "partial_count" in found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(sales" not in found._jdf.queryExecution().executedPlan().toString()


def test_shares_add_up(house):
    shares = explore.delivery_status_share(apply_filters(house.fact()))
    assert shares.agg(F.sum("share_pct")).first()[0] == pytest.approx(100)


@pytest.mark.parametrize("bins", [3, 20])
@pytest.mark.parametrize("values", [[4], [1, 1, 2], list(range(-4, 7)), [0, 100, 100, 7, 33, None]])
def test_equal_width_bins(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(3)
    found = histogram.equal_width(df, "v", bins).collect()
    known = [v for v in values if v is not None]
    counts, edges = np.histogram(known, bins=bins, range=(min(known), max(known)) if len(set(known)) > 1 else None)
    if len(set(known)) == 1:
        assert [(r["bin"], r["nb_lines"]) for r in found] == [(1, len(known))]
        return
    assert {r["bin"]: r["nb_lines"] for r in found} == {i + 1: c for i, c in enumerate(counts) if c}
    for r in found:
        assert (r["bin_from"], r["bin_to"]) == pytest.approx((edges[r["bin"] - 1], edges[r["bin"]]))


def test_bands(make_fact):
    lines = make_fact({"shipping_mode": "A"}, {"shipping_mode": "B", "delivery_status": EARLY})
    assert listed(explore.late_rate_by_mode(lines), "shipping_mode", "tone") == [("B", "good"), ("A", "bad")]
    assert listed(explore.monthly_late_rate(lines, 30), "late_rate", "target") == [(50.0, 30)]

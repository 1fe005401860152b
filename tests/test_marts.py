import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.functions import measures as M
from orderlens.operators.distinct import BUCKET, with_bucket, with_distinct_count
from orderlens.plans import marts
from orderlens.schema import CANCELED, EARLY, LATE, ON_TIME


def rows(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize(
    "value, digits, expected",
    [(1.005, 2, 1.0), (0.285, 2, 0.28), (2.5, 0, 3.0), (-2.5, 0, -3.0), (57.25, 1, 57.3), (0.15, 1, 0.2), (None, 1, None)],
)
def test_rounding_is_half_away_from_zero_on_the_scaled_value(spark, value, digits, expected):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(M.round_to(F.col("x"), digits)).first()[0] == expected


def test_cancelled_lines_leave_the_rate_but_not_the_delay(make_fact):
    lines = make_fact(
        {"delivery_status": LATE, "days_real": 5, "days_scheduled": 2},
        {"delivery_status": ON_TIME, "days_real": 2, "days_scheduled": 2},
        {"delivery_status": CANCELED, "days_real": 0, "days_scheduled": 2},
    )
    row = marts.monthly_performance(lines).first()
    assert (row["late_rate_pct"], row["on_time_rate_pct"], row["avg_delay_days"]) == (50.0, 50.0, 0.33)


def test_unknown_status_counts_in_the_mart_denominator_only(make_fact):
    lines = make_fact({}, {"delivery_status": EARLY}, {"delivery_status": None}, {"delivery_status": None})
    assert marts.shipping_mode(lines).first()["late_rate_pct"] == 25.0
    assert lines.agg(M.flag_rate("is_late")).first()[0] == 50.0


def test_all_cancelled_group_has_no_rate(make_fact):
    lines = make_fact({"delivery_status": CANCELED})
    assert marts.shipping_mode(lines).first()["late_rate_pct"] is None
    assert lines.agg(M.overall_late_rate()).first()[0] == 0.0
    assert lines.agg(M.flag_rate("is_on_time")).first()[0] is None


def test_zero_sales_give_no_margin(make_fact):
    lines = make_fact({"sales": 0, "profit": 5}, {"sales": 0, "profit": -5})
    row = marts.category_finance(lines).first()
    assert row["margin_pct"] is None and row["sales"] == 0.0 and row["units_sold"] == 2


def test_null_keys_form_a_group_sorted_last(make_fact):
    lines = make_fact({"market": None, "order_region": None}, {"market": None, "order_region": None}, {})
    found = marts.region(lines).collect()
    assert [(r["market"], r["nb_orders"], r["sales"]) for r in found] == [(None, 2, 200.0), ("Europe", 1, 100.0)]
    ties = make_fact({"market": None}, {"market": "Africa"})
    assert [r["market"] for r in marts.region(ties).collect()] == ["Africa", None]


def test_orders_are_counted_once_per_group(make_fact):
    lines = make_fact(
        {"order_id": 1},
        {"order_id": 1},
        {"order_id": 1, "order_region": "Oceania"},
        {"order_id": None},
        {"order_id": None, "order_region": "Canada"},
    )
    found = rows(marts.region(lines), "order_region")
    assert {k: v["nb_orders"] for k, v in found.items()} == {"Western Europe": 1, "Oceania": 1, "Canada": 0}


def test_mart_order(make_fact):
    lines = make_fact(
        {"order_ts": dt.datetime(2017, 1, 2)},
        {"order_ts": dt.datetime(2016, 1, 2), "category_name": "Boats", "sales": 300},
        {"order_ts": dt.datetime(2016, 2, 2), "shipping_mode": "Same Day", "delivery_status": EARLY},
    )
    months = [r["order_month"] for r in marts.monthly_performance(lines).collect()]
    assert months == sorted(months)
    assert [r["category_name"] for r in marts.category_finance(lines).collect()] == ["Boats", "Tents"]
    assert [r["shipping_mode"] for r in marts.shipping_mode(lines).collect()] == ["First Class", "Same Day"]


def test_marts_add_up_to_the_fact(house):
    fact = house.fact()
    total = fact.agg(F.sum("sales").cast("double"), F.count("*")).first()
    for name in marts.MARTS:
        assert house.mart(name).agg(F.sum("sales")).first()[0] == pytest.approx(total[0], abs=1)
    for name in ("mart_monthly_performance", "mart_shipping_mode", "mart_category_finance"):
        assert house.mart(name).agg(F.sum("nb_lines")).first()[0] == total[1]
    flagged = fact.agg(F.count_if("is_late"), F.count_if("is_on_time"), F.count_if("is_canceled"), F.count("delivery_status"))
    late, on_time, canceled, known = flagged.first()
    assert late + on_time + canceled == known


@pytest.mark.parametrize("keys", [[], ["g"], ["g", "h"]])
def test_distinct_count_equals_the_built_in_one(spark, keys):
    # A third of the rows share one key, and some values and groups are NULL.
    hot = F.when(F.col("id") < 10_000, 0).otherwise(F.col("id"))
    df = spark.range(0, 30_000, 1, 16).select(
        F.nullif((hot % 997).cast("int"), F.lit(5)).alias("g"),
        F.when(hot % 3 > 0, (hot % 3).cast("string")).alias("h"),
        F.nullif(F.col("id") % 4001, F.lit(7)).alias("v"),
        F.col("id").alias("x"),
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        sums = [F.sum("x").alias("s"), F.count("*").alias("c")]
        plain = df.groupBy(*keys).agg(F.countDistinct("v").alias("n"), F.sum("x").alias("s"), F.count("*").alias("c"))
        for value in ("v", "-v", "v * 1000003"):
            split = with_distinct_count(df.withColumn("v", F.expr(value)), keys, "v", "n", sums)
            assert split.columns == plain.columns
            assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_distinct_count_of_no_rows(spark):
    none = spark.range(0).select("id", F.col("id").alias("x"))
    row = with_distinct_count(none, [], "id", "n", [F.count("*").alias("c"), F.sum("x").alias("s")]).first()
    assert tuple(row) == (0, 0, None)


def test_distinct_count_at_borders_of_words(spark):
    values = [-(1 << 63), -(1 << 40), -65, -64, -63, -1, 0, 1, 63, 64, 65, 127, 128, 1 << 40, (1 << 63) - 1, 1, 0, -64, None]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert tuple(with_distinct_count(df, [], "v", "n", [F.count("*").alias("c")]).first()) == (15, 19)


def test_a_bucket_holds_a_thousand_neighbours(spark):
    """A row of the shuffle for each, beside sums that take more room than its words."""
    ids = spark.range(-1024, 4096)
    assert with_bucket(ids, "id").select(BUCKET).distinct().count() == 5
    groups = ids.union(ids).withColumn("k", F.col("id") % 3)
    found = with_distinct_count(groups, ["k"], "id", "n", [F.count("*").alias("c")]).orderBy("k").collect()
    want = {k: sum(1 for v in range(-1024, 4096) if int(f"{'-' if v < 0 else ''}{abs(v) % 3}") == k) for k in (-2, -1, 0, 1, 2)}
    assert {r["k"]: (r["n"], r["c"]) for r in found} == {k: (n, 2 * n) for k, n in want.items()}


@pytest.mark.parametrize("name", marts.MARTS)
def test_written_marts_equal_direct_ones(house, name):
    """Every value of the one-pass marts, and their order, against the mart from the lines."""
    assert [tuple(r) for r in house.mart(name).collect()] == [tuple(r) for r in marts.MARTS[name](house.fact()).collect()]


def test_one_pass_keeps_null_keys_apart_from_absent_ones(make_fact):
    lines = make_fact(
        {"market": None, "order_region": None, "order_id": 5},
        {"market": None, "order_region": None, "shipping_mode": None, "category_name": None, "department_name": None, "order_id": 5},
        {"order_id": None},
        {"order_id": 70_000, "order_region": None},
    )
    totals = marts.totals_of_all(lines)
    for mart in marts.MARTS.values():
        assert mart.rolled_up(totals).collect() == mart(lines).collect()

"""What the physical plans must and must not contain."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderlens.checks.registry import ALL_FILTERS, QUERIES
from orderlens.operators.filters import Filters, apply_filters
from orderlens.plans import explore, marts, quality
from orderlens.contracts import packaged_contract
from orderlens.schema import FACT_COLUMNS
from orderlens.sources import star, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_filters_reach_the_scan(house):
    text = formatted(explore.monthly_sales_profit(apply_filters(house.fact(), ALL_FILTERS)))
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    for part in ("GreaterThanOrEqual(order_month", "LessThanOrEqual(order_month", "In(market", "In(shipping_mode", "In(customer_segment"):
        assert part in pushed
    partitions = re.search(r"PartitionFilters: (.*)", text).group(1)
    assert ">= 1997" in partitions and "<= 1998" in partitions


def test_only_needed_columns_are_read(house):
    text = formatted(marts.shipping_mode(house.fact()))
    columns = set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*)>", text).group(1)))
    assert columns == {"shipping_mode", "days_real", "days_scheduled", "delay_days", "is_late", "is_canceled", "sales", "profit"}


def test_all_row_rules_share_one_scan(house):
    rules = [r for r in packaged_contract("order_lines").rules if r.test != "unique"]
    assert len(rules) == 22
    assert plan(quality.run_contract({"fct_sales": house.fact()}, rules)).count("FileScan") == 1


@pytest.mark.parametrize("name", ["region_sales_late", "late_rate_by_mode", "monthly_late_rate", "department_top_sales"])
def test_one_scan_and_no_join(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_top_k_is_not_a_full_sort(house):
    text = plan(explore.country_top_sales(apply_filters(house.fact())))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_no_query_multiplies_rows_or_runs_python(spark, folder):
    """Nor does any rank or gather all groups in a window: the only ones number lines within a file's ranges."""
    for name, query in QUERIES.items():
        text = plan(query(spark, folder))
        assert set(re.findall(r"windowspecdefinition\((\w+)", text)) <= {"file"}, name
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
            assert word not in text, (name, word)


@pytest.mark.parametrize("name", ["mart_region", "mart_monthly_performance", "kpi_cards", "market_summary", "segment_summary", "header_counts"])
def test_distinct_orders_take_one_scan(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert text.count("FileScan") == 1 and "bit_or(" in text and "SortAggregate" not in text and "Join" not in text
    # No shuffle by order number.
    assert not re.search(r"hashpartitioning\([^)]*order_id", text)


def test_catalog_counts_neither_join_nor_parse(spark, folder):
    for name in ("catalog_counts", "pipeline_row_counts"):
        text = plan(QUERIES[name](spark, folder))
        assert "Join" not in text and "FileScan csv" not in text


def test_marts_of_a_rebuild_scan_the_fact_once(house):
    text = plan(marts.totals_of_all(house.fact()))
    assert text.count("FileScan") == 1 and text.count("Expand [") == 1 and "InMemoryTableScan" not in text


def test_star_joins_are_not_forced(spark, folder):
    """Without the size check in favour, every join sorts and merges."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = star.order_lines(spark, folder)
        text = plan(lines)
        assert "Broadcast" not in text and text.count("SortMergeJoin") == 7
        assert lines.count() == spark.read.parquet(f"{folder}/lineitem.parquet").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_year_with_most_rows_is_split_over_files(spark, make_fact, tmp_path):
    one = make_fact({}, {"order_ts": dt.datetime(2017, 1, 2)})
    many = spark.range(0, 60_000, 1, 16).crossJoin(F.broadcast(one)).where((F.col("order_year") == 2016) | (F.col("id") < 100))
    lines = many.withColumn("product_name", F.sha2(F.col("id").cast("string"), 256)).drop("id")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        tables.write_fact(lines, str(tmp_path / "f"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = lambda year: len(list(Path(tmp_path / "f" / f"order_year={year}").glob("*.parquet")))
    assert files(2016) > 3 and files(2017) == 1
    assert tables.read_fact(spark, str(tmp_path / "f")).count() == 60_100


def test_filters_on_any_dimension_skip_rows_of_a_file(spark, make_fact, tmp_path):
    places = spark.createDataFrame([(m, s, c) for m in "ABCDE" for s in "FGHI" for c in "XYZ"], "market string, shipping_mode string, customer_segment string")
    months = make_fact({}, {"order_ts": dt.datetime(2016, 9, 5)}).drop(*places.columns)
    lines = months.join(F.broadcast(places)).join(spark.range(600))
    lines = lines.withColumn("product_name", F.sha2(F.monotonically_increasing_id().cast("string"), 256))
    tables.write_fact(lines.select(FACT_COLUMNS), str(tmp_path / "f"), row_group_bytes=1 << 16)
    written = tables.read_fact(spark, str(tmp_path / "f"))

    def rows_read(filters):
        execution = apply_filters(written, filters)._jdf.queryExecution()
        rows = execution.toRdd().count()
        return execution.executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value(), rows

    for filters in (
        Filters(month_from="2016-09"), Filters(markets=("B",)), Filters(modes=("G",)), Filters(segments=("Y",)),
        Filters("2016-01", "2016-08", ("E",), ("I",), ("X",)),
    ):
        read, kept = rows_read(filters)
        assert 0 < kept <= read < max(2 * kept, 2000), filters

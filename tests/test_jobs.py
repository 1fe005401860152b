"""The command-line jobs from a raw Latin-1 file to a gate decision."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlens.__main__ import BREAKDOWNS, main
from orderlens.plans.warehouse import Warehouse
from orderlens.schema import CANCELED, LATE, ON_TIME, RAW_TYPES
from orderlens.sources.star import order_lines


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    line = {
        "Order Id": 1, "Order Item Id": 10, "order date (DateOrders)": "1/5/2015 9:07",
        "shipping date (DateOrders)": "1/8/2015 9:07", "Days for shipping (real)": 3,
        "Days for shipment (scheduled)": 2, "Delivery Status": LATE, "Shipping Mode": "First Class",
        "Late_delivery_risk": 1, "Order Status": "COMPLETE", "Market": "Europe", "Order Region": "Western Europe",
        "Order Country": "España", "Customer Segment": "Consumer", "Department Name": "Outdoors",
        "Category Name": "Tents", "Product Name": '"Tent, ""big"""', "Type": "DEBIT", "Sales": 100.5,
        "Order Item Total": 90.45, "Order Profit Per Order": 10.05, "Order Item Profit Ratio": 0.11,
        "Order Item Discount": 10.05, "Order Item Discount Rate": 0.1, "Order Item Quantity": 2,
    }
    lines = [
        line,
        {**line, "Order Item Id": 11, "Delivery Status": ON_TIME, "Days for shipping (real)": 2},
        {
            **line,
            "Order Id": 2,
            "Order Item Id": 12,
            "Delivery Status": CANCELED,
            "order date (DateOrders)": "2/1/2015 0:00",
            "Category Name": "Boats",
            "Sales": 300,
        },
    ]
    names = list(RAW_TYPES)
    text = "\n".join([",".join(names)] + [",".join(str(x[n]) for n in names) for x in lines])
    (base / "latin.csv").write_bytes(text.encode("latin-1"))
    assert main(["transcode", str(base / "latin.csv"), str(base / "utf8")]) == 0
    assert main(["build", str(base / "utf8"), str(base / "house")]) == 0
    return base


def test_build_counts(built, capsys):
    assert main(["build", str(built / "utf8"), str(built / "again")]) == 0
    shown = capsys.readouterr().out
    assert "|raw_order_lines         |3      |" in shown and "|mart_monthly_performance|2      |" in shown


def test_clean_file_passes_the_gate(built):
    assert main(["check", str(built / "house"), str(built / "report")]) == 0


def test_failing_contract_gives_exit_code_one(built, tmp_path):
    contract = {"tables": [{"name": "fct_sales", "columns": [{"name": "order_id", "tests": ["unique", "odd"]}]}]}
    (tmp_path / "c.json").write_text(json.dumps(contract))
    assert main(["check", str(built / "house"), str(tmp_path / "r"), "--contract", str(tmp_path / "c.json")]) == 1
    written = json.loads(next((tmp_path / "r").glob("*.json")).read_text())
    assert (written["total_tests"], written["failed"], written["quality_score"]) == (2, 1, 0.0)
    assert [r["status"] for r in written["results"]] == ["FAIL", "SKIP"]


@pytest.mark.parametrize("name", BREAKDOWNS)
def test_every_breakdown_shows_rows(name, built, capsys):
    assert main(["explore", str(built / "house"), name]) == 0
    assert capsys.readouterr().out.count("\n|") >= 2


def test_all_breakdowns_are_written(built, tmp_path, spark, capsys):
    assert main(["explore", str(built / "house"), "all", "--output", str(tmp_path / "out")]) == 0
    assert {p.name for p in (tmp_path / "out").iterdir()} == set(BREAKDOWNS)
    assert spark.read.parquet(str(tmp_path / "out" / "market_summary")).count() == 1
    assert main(["explore", str(built / "house"), "market_summary", "--market", "Nowhere", "--output", str(tmp_path / "none")]) == 0
    assert "no order line matches" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "none" / "market_summary")).count() == 0


def test_nothing_is_left_out_of_a_listing(spark, folder, tmp_path, capsys):
    house = Warehouse(spark, str(tmp_path / "house")).build_fact(order_lines(spark, folder))
    want = BREAKDOWNS["monthly_sales_by_segment"](house.fact()).count()
    assert want > 100
    main(["explore", str(tmp_path / "house"), "monthly_sales_by_segment"])
    assert capsys.readouterr().out.count("\n|") - 1 == want


def test_a_failed_rebuild_leaves_the_old_tables(spark, folder, tmp_path):
    lines = order_lines(spark, folder)
    house = Warehouse(spark, str(tmp_path / "house")).build(lines)
    rows, region = house.fact().count(), house.mart("mart_region").collect()
    reader = Warehouse(spark, str(tmp_path / "house")).fact()  # has listed its files
    stop = F.when(F.col("Order Id") > 100, F.raise_error(F.lit("midway"))).otherwise(F.lit("Europe"))
    for _ in range(2):
        with pytest.raises(PySparkException, match="midway"):
            Warehouse(spark, str(tmp_path / "house")).build(lines.withColumn("Market", stop))
    again = Warehouse(spark, str(tmp_path / "house"))
    assert again.fact().count() == rows and again.raw().count() == lines.count()
    assert again.mart("mart_region").collect() == region
    again.build(lines.where(F.col("Order Id") <= 100))
    assert 0 < again.fact().count() < rows and reader.count() == rows
    assert again.written["fct_sales"] == again.fact().count() and again.written["mart_region"] == again.mart("mart_region").count()
    for _ in range(2):
        again.build_marts()
    kept = [p.name for p in (tmp_path / "house" / "mart_region").iterdir() if p.is_dir()]
    assert len(kept) == 2


def test_a_build_may_check_itself(built, tmp_path):
    failed = main(["build", str(built / "utf8"), str(tmp_path / "house"), "--report", str(tmp_path / "r")])
    written = json.loads(next((tmp_path / "r").glob("*.json")).read_text())
    assert written["total_tests"] > 20 and failed == (written["failed"] > 0)


def test_rules_on_the_raw_table(built, tmp_path):
    contract = {"tables": [{"name": "raw_order_lines", "columns": [{"name": "Order Id", "tests": ["not_null"]}]}]}
    (tmp_path / "c.json").write_text(json.dumps(contract))
    assert main(["check", str(built / "house"), str(tmp_path / "r"), "--contract", str(tmp_path / "c.json")]) == 0


def test_both_ways_in_give_the_same_categories(spark, tmp_path):
    names = list(RAW_TYPES)
    row = {"Order Id": "1", "order date (DateOrders)": "1/5/2015 9:07", "Sales": "1", "Product Name": '"two\nlines"'}
    lines = [",".join({**row, "Category Name": c}.get(n, "") for n in names) for c in ("Baby ", "Baby", "é")]
    (tmp_path / "latin.csv").write_bytes("\n".join([",".join(names), *lines]).encode("latin-1"))
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        main(["build", str(tmp_path / "latin.csv"), str(tmp_path / "x"), "--encoding", "ISO-8859-1"])
    main(["transcode", str(tmp_path / "latin.csv"), str(tmp_path / "utf8"), "--multiline"])
    main(["build", str(tmp_path / "latin.csv"), str(tmp_path / "a"), "--encoding", "ISO-8859-1", "--multiline"])
    main(["build", str(tmp_path / "utf8"), str(tmp_path / "b"), "--multiline"])
    a, b = (sorted(map(str, Warehouse(spark, str(tmp_path / h)).mart("mart_category_finance").collect())) for h in "ab")
    assert a == b and len(a) == 3


def test_filters_and_target_are_applied(built, capsys):
    main(["explore", str(built / "house"), "monthly_late_rate", "--month-to", "2015-01", "--market", "Europe", "--late-target", "35"])
    shown = capsys.readouterr().out
    assert "|2015-01-01 00:00:00|50.0     |35    |" in shown and "2015-02" not in shown
    main(["explore", str(built / "house"), "country_top_sales"])
    assert "España" in capsys.readouterr().out

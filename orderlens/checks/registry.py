"""Named queries, one per operator, each a function of (spark, folder of star tables).

Raw order lines are assembled from the star tables, staged and written once per
application as a fact table; the queries then read that table, as they would on a
cluster. Variants with missing or odd values alter whole columns by an attribute,
never by sampling rows.
"""

import hashlib
import re

from pyspark.sql import functions as F

from orderlens import schema as S
from orderlens.contracts import packaged, packaged_contract
from orderlens.functions import measures as M
from orderlens.functions.timestamps import month_start, parse_minutes
from orderlens.operators import rules as R
from orderlens.operators.filters import Filters, apply_filters
from orderlens.operators.staging import fact, stage, with_double_amounts
from orderlens.plans import catalog, explore, marts, quality
from orderlens.plans.warehouse import Warehouse
from orderlens.session import workspace
from orderlens.sources import raw_csv, report, star, tables
from orderlens.sources.contract import Rule

GENERATED_AT = "2024-01-01T00:00:00"
MONTHS = Filters(month_from="1997-01", month_to="1998-12")
DIMENSIONS = Filters(
    markets=("EUROPE", "ASIA"), modes=("1-URGENT", "2-HIGH"), segments=("BUILDING", "MACHINERY")
)
ALL_FILTERS = Filters(
    MONTHS.month_from, MONTHS.month_to, DIMENSIONS.markets, DIMENSIONS.modes, DIMENSIONS.segments
)

_built = {}
_houses = {}


def _scratch(spark, folder, name):
    """A folder of this application for a source; the digest keeps look-alike names apart."""
    source = re.sub(r"[^A-Za-z0-9.]+", "_", folder).strip("_")
    return f"{workspace(spark)}/{source}-{hashlib.md5(folder.encode()).hexdigest()[:8]}/{name}"


def _once(spark, folder, part, build):
    """Run a build step once per application and source folder."""
    key = (spark.sparkContext.applicationId, folder, part)
    if key not in _built:
        build()
        _built[key] = True


def forget(folder, *parts):
    """Have these build steps of a source run again at their next use."""
    for key in [k for k in _built if k[1] == folder and k[2] in parts]:
        del _built[key]


def warehouse(spark, folder):
    """The warehouse of a star folder, its fact written on first use."""
    key = (spark.sparkContext.applicationId, folder)
    house = _houses.setdefault(key, Warehouse(spark, _scratch(spark, folder, "warehouse")))
    _once(spark, folder, "fact", lambda: house.build_fact(star.order_lines(spark, folder, whole=True)))
    return house


def warehouse_with_marts(spark, folder):
    house = warehouse(spark, folder)
    _once(spark, folder, "marts", house.build_marts)
    return house


def _raw_file(spark, folder):
    """The order lines as a raw CSV file, dates spelled as text."""
    path = _scratch(spark, folder, "raw_csv")
    lines = star.as_file_text(star.order_lines(spark, folder, whole=True))
    _once(spark, folder, "raw_csv", lambda: raw_csv.write_order_lines(lines, path, compression="gzip"))
    return path


def _sales_fact(spark, folder):
    return warehouse(spark, folder).fact()


def _selection(spark, folder, filters=Filters()):
    return apply_filters(_sales_fact(spark, folder), filters)


def _orders(spark, folder):
    return spark.read.parquet(f"{folder}/orders.parquet")


# --- sources and sinks ---------------------------------------------------------


def src_csv_scan(spark, folder):
    raw = raw_csv.read_order_lines(spark, _raw_file(spark, folder))
    return with_double_amounts(stage(raw))


def _odd_text(lines):
    """File text with blanks, line breaks, empty fields, odd dates and fractional days.

    What is odd about a line hangs on its payment type, priority, status and segment.
    """
    name, date, days = "Product Name", "order date (DateOrders)", "Days for shipping (real)"
    paid, due = F.col("Type"), F.col("Shipping Mode")
    odd_name = (
        F.when(paid == "A", F.concat(F.lit("  "), name, F.lit(" ")))
        .when(paid == "R", F.concat(name, F.lit("\nsecond, \"line\"")))
        .otherwise(F.col(name))
    )
    odd_date = F.when(due == "5-LOW", None).when(F.col("Order Status") == "P", "n/a").otherwise(F.concat(F.lit("\t"), date))
    odd_days = F.when(F.col("Customer Segment") == "BUILDING", F.col(days) + 0.5).otherwise(F.col(days))
    country = F.when(paid == "N", "").otherwise(F.col("Order Country"))
    return star.as_file_text(lines).withColumns(
        {name: odd_name, date: odd_date, days: odd_days.cast("string"), "Order Country": country}
    )


def _odd_file(spark, folder):
    path = _scratch(spark, folder, "odd_csv")
    lines = _odd_text(star.order_lines(spark, folder, whole=True))
    _once(spark, folder, "odd_csv", lambda: raw_csv.write_order_lines(lines, path, compression="gzip"))
    return path


_ODD_COLUMNS = [
    "order_item_id", "product_name", "order_country", "order_ts", "order_month", "days_real", "delay_days", "sales",
]


def src_csv_multiline(spark, folder):
    """Staged rows of a file with quoted line breaks and other odd values."""
    raw = raw_csv.read_order_lines(spark, _odd_file(spark, folder), multiline=True)
    return with_double_amounts(stage(raw).select(_ODD_COLUMNS))


def fct_from_odd_file(spark, folder):
    """Fact rows of the same file: those without a date are gone."""
    raw = raw_csv.read_order_lines(spark, _odd_file(spark, folder), multiline=True)
    return with_double_amounts(fact(stage(raw)).select(_ODD_COLUMNS))


def src_csv_latin1(spark, folder):
    """Odd and accented text written as ISO-8859-1, scanned, and rewritten as UTF-8 and scanned."""
    latin, utf8 = _scratch(spark, folder, "latin1_csv"), _scratch(spark, folder, "utf8_csv")
    lines = _odd_text(star.order_lines(spark, folder, whole=True))
    accented = lines.withColumn("Product Name", F.concat("Product Name", F.lit("Niñez, \"été\" ")))

    def build():
        raw_csv.write_order_lines(accented, latin, "ISO-8859-1", "gzip", fast=True)
        raw_csv.transcode(spark, latin, utf8, multiline=True, compression="gzip", fast=True)

    _once(spark, folder, "latin1", build)
    direct = stage(raw_csv.read_order_lines(spark, latin, "ISO-8859-1", multiline=True))
    rewritten = stage(raw_csv.read_order_lines(spark, utf8, multiline=True))
    parts = [df.select(F.lit(name).alias("file"), *_ODD_COLUMNS) for name, df in (("latin1", direct), ("utf8", rewritten))]
    return with_double_amounts(parts[0].unionByName(parts[1]))


def src_fact_scan(spark, folder):
    return with_double_amounts(_sales_fact(spark, folder).select(S.EXPLORED_COLUMNS))


def sink_fact_roundtrip(spark, folder):
    path = _scratch(spark, folder, "fact_roundtrip")
    lines = fact(stage(star.order_lines(spark, folder)))
    _once(spark, folder, "fact_roundtrip", lambda: tables.write_fact(lines, path))
    return with_double_amounts(tables.read_fact(spark, path))


def column_dictionary(spark, folder):
    path = _scratch(spark, folder, "raw_columns")
    lines = spark.createDataFrame([(x,) for x in packaged("raw_columns.csv").splitlines()], "value string")
    _once(spark, folder, "raw_columns", lambda: lines.coalesce(1).write.mode("overwrite").text(path))
    dictionary = raw_csv.read_column_dictionary(spark, path)
    return catalog.column_listing(dictionary, raw_csv.read_order_lines(spark, _raw_file(spark, folder)))


def pipeline_row_counts(spark, folder):
    """Full rebuild from the CSV file: rows of every object and columns of the raw one."""
    raw = raw_csv.read_order_lines(spark, _raw_file(spark, folder))
    house = Warehouse(spark, _scratch(spark, folder, "rebuild"))
    _once(spark, folder, "rebuild", lambda: house.build(raw))
    width = F.when(F.col("object") == "raw_order_lines", len(raw.columns))
    return house.row_counts().withColumn("nb_columns", width)


# --- staging -------------------------------------------------------------------


def stg_order_lines(spark, folder):
    return with_double_amounts(stage(star.order_lines(spark, folder)))


def stg_large_amounts(spark, folder):
    """Amounts beyond ten digits for urgent orders, summed per region and staged as text."""
    lines = star.order_lines(spark, folder)
    large = F.when(F.col("Shipping Mode") == "1-URGENT", F.col("Sales") * 1_000_000_000).otherwise(F.col("Sales"))
    text = lines.withColumn("Sales", large.cast("decimal(38,2)").cast("string"))
    return stage(text).groupBy("order_region", "shipping_mode").agg(M.total("sales").alias("sales"))


def stg_parse_dates(spark, folder):
    """Dates as file text, garbage for pending orders and absent for low priority."""
    orders = _orders(spark, folder)
    day = F.concat_ws("/", F.month("o_orderdate"), F.day("o_orderdate"), F.year("o_orderdate"))
    text = (
        F.when(F.col("o_orderpriority") == "5-LOW", None)
        .when(F.col("o_orderstatus") == "P", "n/a")
        .otherwise(F.concat(day, F.lit(" 9:05")))
    )
    return orders.select("o_orderkey", text.alias("order_date")).withColumn(
        "order_ts", parse_minutes(F.col("order_date"))
    )


def stg_month_year(spark, folder):
    return _orders(spark, folder).select(
        "o_orderkey",
        month_start(F.col("o_orderdate")).alias("order_month"),
        F.year("o_orderdate").alias("order_year"),
    )


def stg_delay_flags(spark, folder):
    staged = stage(star.order_lines(spark, folder))
    return staged.groupBy(
        "delivery_status", "delay_days", "is_late", "is_on_time", "is_canceled", "late_risk"
    ).agg(F.count("*").alias("nb_lines"))


def fct_sales(spark, folder):
    return with_double_amounts(_sales_fact(spark, folder))


def fn_safe_ratio(spark, folder):
    """Ratios whose divisor is zero for every line without a discount."""
    lines = _sales_fact(spark, folder)
    return lines.groupBy("order_country", "discount_rate").agg(
        M.safe_ratio(F.sum("profit"), F.sum("discount")).alias("profit_per_discount")
    ).withColumn("discount_rate", F.col("discount_rate").cast("double"))


def fn_bands(spark, folder):
    """All bands on figures that differ from category to category."""
    grouped = _sales_fact(spark, folder).groupBy("department_name", "category_name").agg(
        M.flag_rate("is_late").alias("late_rate"),
        F.avg("delay_days").alias("avg_delay_days"),
        M.margin(F.sum("profit"), F.sum("sales")).alias("margin"),
        F.count_if(F.col("profit") < 0).alias("losses"),
    )
    rate, gain = F.col("late_rate"), F.col("margin")
    return grouped.withColumns(
        {
            "target_tone": M.late_target_tone(rate, 40),
            "rate_tone": M.late_rate_tone(rate),
            "delay_tone": M.delay_tone(F.col("avg_delay_days")),
            "margin_tone": M.margin_tone(gain),
            "category_tone": M.category_tone(gain),
            "score_tone": M.score_tone(100.0 - rate),
            "failure_tone": M.failure_tone(F.col("losses")),
        }
    )


# --- filters and options -------------------------------------------------------


def _filter_query(filters):
    def run(spark, folder):
        kept = _selection(spark, folder, filters)
        columns = ["order_item_id", "order_month", "market", "shipping_mode", "customer_segment", "sales"]
        return with_double_amounts(kept.select(columns))

    return run


def _explore(query, filters=Filters(), **options):
    return lambda spark, folder: query(_selection(spark, folder, filters), **options)


def _on_fact(query):
    return lambda spark, folder: query(_sales_fact(spark, folder))


# --- variants with missing or odd values ---------------------------------------


def _with_unknown_status(lines):
    """Pending orders lose their status and, with it, their flags."""
    unknown = F.col("order_status") == "P"
    names = ["delivery_status", "is_late", "is_on_time", "is_canceled"]
    return lines.withColumns({n: F.when(~unknown, F.col(n)) for n in names})


def _with_missing_dimensions(lines):
    return lines.withColumns(
        {
            "order_region": F.nullif(F.col("order_region"), F.lit("NATION_7")),
            "customer_segment": F.nullif(F.col("customer_segment"), F.lit("MACHINERY")),
        }
    )


def _with_canceled_region(lines):
    gone = F.col("order_region") == "NATION_3"
    return lines.withColumns(
        {
            "delivery_status": F.when(gone, S.CANCELED).otherwise(F.col("delivery_status")),
            "is_late": F.col("is_late") & ~gone,
            "is_on_time": F.col("is_on_time") & ~gone,
            "is_canceled": F.col("is_canceled") | gone,
        }
    )


def _with_zero_sales(lines):
    free = F.col("category_name") == "Brand#1"
    return lines.withColumn("sales", F.when(free, F.lit(0)).otherwise(F.col("sales")).cast(S.MONEY))


def _varied(query, change):
    return lambda spark, folder: query(change(_sales_fact(spark, folder)))


def _varied_exploration(query, change):
    return lambda spark, folder: query(apply_filters(change(_sales_fact(spark, folder))))


def edge_null_status_rates(spark, folder):
    """Mart and exploration late rates side by side where statuses are missing."""
    lines = _with_unknown_status(_sales_fact(spark, folder))
    return lines.groupBy("shipping_mode").agg(
        M.mart_late_rate().alias("mart_late_rate"),
        M.mart_on_time_rate().alias("mart_on_time_rate"),
        M.flag_rate("is_late").alias("late_rate"),
        M.flag_rate("is_on_time").alias("on_time_rate"),
    )


# --- quality -------------------------------------------------------------------


def _quality_tables(spark, folder):
    return {"fct_sales": _sales_fact(spark, folder), "orders": _orders(spark, folder)}


def _results(spark, folder, *tests):
    rules = packaged_contract("star").rules
    wanted = [r for r in rules if r.test in tests] if tests else rules
    return quality.run_contract(_quality_tables(spark, folder), wanted)


def _tested(*tests):
    return lambda spark, folder: _results(spark, folder, *tests).drop("rule_no")


def dq_accepted_range(spark, folder):
    """Declared ranges, then half-open ones and one without bounds."""
    declared = [r for r in packaged_contract("star").rules if r.test == "accepted_range"]
    more = [
        Rule("fct_sales", "days_real", "accepted_range", {"min": 2}),
        Rule("fct_sales", "delay_days", "accepted_range", {"max": 1}),
        Rule("fct_sales", "quantity", "accepted_range", {}),
    ]
    return quality.run_contract(_quality_tables(spark, folder), declared + more).drop("rule_no")


def dq_relationships(spark, folder):
    """Lines whose order is not among the orders that left the pending state."""
    parent = _orders(spark, folder).where(F.col("o_orderstatus") != "P")
    return R.orphan_rows(_sales_fact(spark, folder), "order_id", parent, "o_orderkey")


def dq_relationships_null_ref(spark, folder):
    """The same parent with an unknown key in it: nothing can be said to be missing."""
    orders = _orders(spark, folder).where((F.col("o_orderstatus") != "P") | (F.col("o_orderkey") == 0))
    parent = orders.select(F.nullif(F.col("o_orderkey"), F.lit(0)).alias("o_orderkey"))
    return R.orphan_rows(_sales_fact(spark, folder), "order_id", parent, "o_orderkey")


def quality_results(spark, folder):
    return _results(spark, folder)


def quality_score(spark, folder):
    return quality.quality_score(_results(spark, folder))


def quality_report(spark, folder):
    """The report written as JSON, read back and listed."""
    path = _scratch(spark, folder, "quality_report")
    document = quality.quality_report(_results(spark, folder), GENERATED_AT)
    _once(spark, folder, "quality_report", lambda: report.write_report(document, path))
    head = ["generated_at", "total_tests", "passed", "failed", "quality_score"]
    return report.read_report(spark, path).select(*head, F.posexplode("results").alias("position", "r")).select(
        *head, "position", "r.*"
    )


# --- catalog -------------------------------------------------------------------


def contract_rules(spark, folder):
    listing = catalog.rule_listing(packaged_contract("star"), _quality_tables(spark, folder))
    return listing.withColumn("values", F.array_join("values", "|"))


def contract_columns(spark, folder):
    return catalog.documented_columns(packaged_contract("star"), _quality_tables(spark, folder))


def catalog_counts(spark, folder):
    return warehouse_with_marts(spark, folder).row_counts()


def catalog_tables(spark, folder):
    house = warehouse(spark, folder)
    known = {"raw_order_lines": house.raw(), "fct_sales": house.fact()}
    return catalog.table_catalog(packaged_contract("star"), known)


def topflop_overlap(spark, folder):
    """Groups so few that the two ends of the ranking overlap."""
    return explore.category_margin_topflop(_selection(spark, folder), group="department_name")


QUERIES = {
    # sources and sinks
    "src_csv_scan": src_csv_scan,
    "src_csv_latin1": src_csv_latin1,
    "src_csv_multiline": src_csv_multiline,
    "src_fact_scan": src_fact_scan,
    "sink_fact_roundtrip": sink_fact_roundtrip,
    "column_dictionary": column_dictionary,
    "pipeline_row_counts": pipeline_row_counts,
    # staging and fact
    "stg_order_lines": stg_order_lines,
    "stg_large_amounts": stg_large_amounts,
    "stg_parse_dates": stg_parse_dates,
    "stg_month_year": stg_month_year,
    "stg_delay_flags": stg_delay_flags,
    "fct_sales": fct_sales,
    "fct_from_odd_file": fct_from_odd_file,
    "fn_safe_ratio": fn_safe_ratio,
    "fn_bands": fn_bands,
    # marts
    "mart_monthly_performance": _on_fact(marts.monthly_performance),
    "mart_shipping_mode": _on_fact(marts.shipping_mode),
    "mart_category_finance": _on_fact(marts.category_finance),
    "mart_region": _on_fact(marts.region),
    # filters and option lists
    "flt_month_range": _filter_query(MONTHS),
    "flt_dimensions": _filter_query(DIMENSIONS),
    "flt_all": _filter_query(ALL_FILTERS),
    "opt_months": _on_fact(explore.month_options),
    "opt_dimensions": _on_fact(explore.dimension_options),
    # exploration
    "header_counts": _explore(explore.header_counts),
    "late_rate_overall": _explore(explore.overall_late_rate),
    "on_time_rate_overall": _explore(explore.overall_on_time_rate),
    "avg_basket": _explore(explore.average_basket),
    "kpi_cards": _explore(explore.kpi_cards),
    "kpi_cards_filtered": _explore(explore.kpi_cards, ALL_FILTERS, late_target=50),
    "monthly_sales_profit": _explore(explore.monthly_sales_profit),
    "monthly_late_rate": _explore(explore.monthly_late_rate),
    "monthly_sales_by_segment": _explore(explore.monthly_sales_by_segment),
    "delivery_status_share": _explore(explore.delivery_status_share),
    "late_rate_by_mode": _explore(explore.late_rate_by_mode),
    "days_real_vs_scheduled": _explore(explore.days_real_vs_scheduled),
    "delay_histogram": _explore(explore.delay_histogram),
    "delay_histogram_bins": _explore(explore.delay_histogram_bins),
    "late_rate_top_regions": _explore(explore.late_rate_top_regions),
    "department_top_sales": _explore(explore.department_top_sales),
    "sales_quantiles": _explore(explore.sales_quantiles),
    "category_margin_topflop": _explore(explore.category_margin_topflop),
    "topflop_overlap": topflop_overlap,
    "discount_vs_margin": _explore(explore.discount_vs_margin),
    "sales_by_market": _explore(explore.sales_by_market),
    "region_sales_late": _explore(explore.region_sales_late),
    "country_top_sales": _explore(explore.country_top_sales),
    "market_summary": _explore(explore.market_summary),
    "segment_summary": _explore(explore.segment_summary),
    "profit_segment_market": _explore(explore.profit_segment_market),
    # missing and odd values
    "edge_null_status_rates": edge_null_status_rates,
    "edge_null_region_mart": _varied(marts.region, _with_missing_dimensions),
    "edge_null_region_sales": _varied_exploration(explore.region_sales_late, _with_missing_dimensions),
    "edge_canceled_region": _varied_exploration(
        lambda lines: explore.region_sales_late(lines, k=25), _with_canceled_region
    ),
    "edge_zero_sales_mart": _varied(marts.category_finance, _with_zero_sales),
    "edge_zero_sales_margins": _varied_exploration(explore.discount_vs_margin, _with_zero_sales),
    # quality
    "contract_rules": contract_rules,
    "contract_columns": contract_columns,
    "dq_not_null": _tested("not_null"),
    "dq_unique": _tested("unique"),
    "dq_positive": _tested("positive"),
    "dq_accepted_values": _tested("accepted_values"),
    "dq_accepted_range": dq_accepted_range,
    "dq_relationships": dq_relationships,
    "dq_relationships_null_ref": dq_relationships_null_ref,
    "quality_results": quality_results,
    "quality_score": quality_score,
    "quality_report": quality_report,
    # catalog
    "catalog_counts": catalog_counts,
    "catalog_tables": catalog_tables,
}

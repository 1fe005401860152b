"""Timings of the headline queries; prints one JSON line.

Every figure is the median of three runs after one untimed run. ``build_fact``
assembles and writes the raw lines and the fact from the star tables, ``build_marts``
writes the four marts from it; the queries read the written fact and end in a null
sink. The total is over these. ``REBUILT`` queries come beside it: what they write
along the way is written anew at each run.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlens.checks import registry  # noqa: E402
from orderlens.session import get_session  # noqa: E402
from orderlens.sources import star  # noqa: E402

HEADLINE = [
    "fct_sales",
    "mart_monthly_performance",
    "mart_shipping_mode",
    "mart_category_finance",
    "mart_region",
    "flt_all",
    "kpi_cards",
    "kpi_cards_filtered",
    "monthly_sales_profit",
    "delivery_status_share",
    "late_rate_by_mode",
    "delay_histogram_bins",
    "late_rate_top_regions",
    "department_top_sales",
    "category_margin_topflop",
    "discount_vs_margin",
    "region_sales_late",
    "country_top_sales",
    "market_summary",
    "segment_summary",
    "profit_segment_market",
    "dq_unique",
    "dq_relationships",
    "quality_results",
]
# Queries with their build steps.
REBUILT = {
    "src_csv_scan": ["raw_csv"],
    "pipeline_row_counts": ["rebuild"],
    "catalog_counts": ["marts"],
    "quality_report": ["quality_report"],
}
RUNS = 3


def timed(action):
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def to_null_sink(name, spark, folder):
    query = registry.QUERIES[name]
    return lambda: query(spark, folder).write.format("noop").mode("overwrite").save()


def rebuilt(name, spark, folder):
    run = to_null_sink(name, spark, folder)

    def action():
        registry.forget(folder, *REBUILT[name])
        run()

    return action


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "orderlens-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    house = registry.warehouse_with_marts(spark, folder)
    actions = {
        "build_fact": lambda: house.build_fact(star.order_lines(spark, folder)),
        "build_marts": house.build_marts,
        **{name: to_null_sink(name, spark, folder) for name in HEADLINE},
    }
    total = len(actions)
    actions |= {name: rebuilt(name, spark, folder) for name in REBUILT}
    seconds = {}
    for name, action in actions.items():
        action()
        seconds[name] = statistics.median(timed(action) for _ in range(RUNS))
    seconds = {name: round(value, 3) for name, value in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "total seconds, headline queries",
                "value": round(sum(list(seconds.values())[:total]), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Jobs: ``python -m orderlens transcode|build|check|explore ...`` (or spark-submit)."""

import argparse
import sys
from datetime import datetime

from orderlens.contracts import packaged_contract
from orderlens.operators.filters import Filters, apply_filters
from orderlens.plans import explore, quality
from orderlens.plans.warehouse import Warehouse
from orderlens.schema import EXPLORED_COLUMNS
from orderlens.session import get_session
from orderlens.sources import raw_csv, report
from orderlens.sources.contract import read_contract
from orderlens.sources.tables import write_table

BREAKDOWNS = {
    f.__name__: f
    for f in (
        explore.header_counts,
        explore.kpi_cards,
        explore.monthly_sales_profit,
        explore.monthly_late_rate,
        explore.monthly_sales_by_segment,
        explore.delivery_status_share,
        explore.late_rate_by_mode,
        explore.days_real_vs_scheduled,
        explore.delay_histogram,
        explore.delay_histogram_bins,
        explore.late_rate_top_regions,
        explore.department_top_sales,
        explore.category_margin_topflop,
        explore.discount_vs_margin,
        explore.sales_by_market,
        explore.region_sales_late,
        explore.country_top_sales,
        explore.market_summary,
        explore.segment_summary,
        explore.profit_segment_market,
    )
}
WITH_TARGET = {"kpi_cards", "monthly_late_rate"}
ALL_ROWS = 2**31 - 2


def transcode(spark, args):
    raw_csv.transcode(spark, args.source, args.target, args.encoding, args.multiline)


def build(spark, args):
    """Rebuild all tables; with a report, run the packaged contract on them."""
    raw = raw_csv.read_order_lines(spark, args.source, args.encoding, args.multiline)
    house = Warehouse(spark, args.warehouse).build(raw, args.strict_dates, args.wide_amounts)
    spark.createDataFrame(list(house.written.items()), "object string, nb_rows long").show(truncate=False)
    print(f"lines without an order date, not in the fact: {house.undated_lines()}")
    if args.report:
        args.contract = None
        return check(spark, args)


def check(spark, args):
    """Write the report; a failed test makes the exit code 1."""
    contract = read_contract(spark, args.contract) if args.contract else packaged_contract("order_lines")
    results = quality.run_contract(Warehouse(spark, args.warehouse).tables(), contract.rules)
    now = datetime.now().isoformat(timespec="seconds")
    report.write_report(quality.quality_report(results, now), args.report)
    written = report.read_report(spark, args.report)
    written.selectExpr("inline(results)").show(len(contract.rules), truncate=False)
    head = written.drop("results").first()
    print(head.asDict())
    return 1 if head["failed"] else 0


def explore_selection(spark, args):
    """Print, or write, breakdowns of one selection; several share one pass over its lines."""
    values = lambda given: tuple(given) if given else None
    filters = Filters(
        args.month_from, args.month_to, values(args.market), values(args.mode), values(args.segment)
    )
    selection = apply_filters(Warehouse(spark, args.warehouse).fact(), filters).select(EXPLORED_COLUMNS)
    names = sorted(BREAKDOWNS) if "all" in args.breakdown else list(dict.fromkeys(args.breakdown))
    if len(names) > 1:
        selection = explore.breakdown_cube(selection)
    if explore.is_empty(selection):
        print("no order line matches the filters")
    for name in names:
        options = {"late_target": args.late_target} if name in WITH_TARGET else {}
        result = BREAKDOWNS[name](selection, **options)
        if args.output:
            write_table(result, f"{args.output.rstrip('/')}/{name}")
        else:
            print(name)
            result.show(args.rows or ALL_ROWS, truncate=False)


def arguments(argv):
    parser = argparse.ArgumentParser(prog="orderlens")
    parser.add_argument("--data-gb", type=float, help="rough size of the input, for the number of shuffle partitions")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("transcode", help="rewrite CSV files as UTF-8")
    job.add_argument("source")
    job.add_argument("target")
    job.add_argument("--encoding", default="ISO-8859-1")
    job.add_argument("--multiline", action="store_true", help="quoted fields hold line breaks")
    job.set_defaults(run=transcode)

    job = jobs.add_parser("build", help="rebuild fact and marts from raw CSV files")
    job.add_argument("source")
    job.add_argument("warehouse")
    job.add_argument("--encoding", default="UTF-8")
    job.add_argument("--multiline", action="store_true", help="quoted fields hold line breaks")
    job.add_argument("--strict-dates", action="store_true", help="stop on a date that does not parse")
    job.add_argument("--report", help="run the packaged contract afterwards and write its report there")
    job.add_argument("--wide-amounts", action="store_true", help="amounts of 10 billion and more occur; slower")
    job.set_defaults(run=build)

    job = jobs.add_parser("check", help="run a quality contract, write its report")
    job.add_argument("warehouse")
    job.add_argument("report")
    job.add_argument("--contract", help="JSON or YAML file; default: the packaged contract")
    job.set_defaults(run=check)

    job = jobs.add_parser("explore", help="show or write breakdowns of the filtered fact")
    job.add_argument("warehouse")
    job.add_argument("breakdown", nargs="+", choices=[*sorted(BREAKDOWNS), "all"])
    job.add_argument("--month-from", metavar="YYYY-MM")
    job.add_argument("--month-to", metavar="YYYY-MM")
    job.add_argument("--market", action="append")
    job.add_argument("--mode", action="append")
    job.add_argument("--segment", action="append")
    job.add_argument("--late-target", type=int, default=explore.DEFAULT_TARGET)
    job.add_argument("--rows", type=int, help="rows to print of each; default: all")
    job.add_argument("--output", help="folder to write the breakdowns to, instead of printing them")
    job.set_defaults(run=explore_selection)
    return parser.parse_args(argv)


def main(argv=None):
    args = arguments(argv)
    return args.run(get_session(f"orderlens-{args.job}", data_gb=args.data_gb), args) or 0


if __name__ == "__main__":
    sys.exit(main())

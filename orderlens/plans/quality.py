"""Running a contract: results, score, gate and report."""

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import measures as M
from orderlens.operators import rules as R

RESULT_COLUMNS = ["table", "column", "test", "status", "failing_rows", "detail"]
_DECLARATION = "array<struct<`table`: string, `column`: string, test: string, detail: string>>"


class QualityGateError(Exception):
    """At least one declared test failed."""


def _by_rule(counts, numbers):
    """Turn one row of columns ``rule_<n>`` into rows (rule_no, failing_rows)."""
    cells = ", ".join(f"{n}, rule_{n}" for n in numbers)
    return counts.select(F.expr(f"stack({len(numbers)}, {cells}) AS (rule_no, failing_rows)"))


def _key_count(tables, rule):
    df = tables[rule.table]
    if rule.test == "unique":
        return R.duplicate_surplus(df, rule.column)
    return R.orphan_rows(df, rule.column, tables[rule.options["to"]], rule.options["field"])


def _declarations(rules):
    """The rules as one constant array, looked up by rule number."""
    shown = [
        {"table": r.table, "column": r.column, "test": r.test, "detail": R.detail(r)} for r in rules
    ]
    return F.from_json(F.lit(json.dumps(shown)), _DECLARATION)


def run_contract(tables, rules):
    """One result row per rule, numbered in declaration order.

    ``tables`` maps names to DataFrames. Nothing runs until the result is used;
    the parts are then independent stages of one job: a scan per table for all its
    row rules, and a key aggregation per uniqueness or reference rule.
    """
    parts, row_rules, unknown = [], {}, []
    for number, rule in enumerate(rules, start=1):
        if rule.test in R.ROW_TESTS:
            row_rules.setdefault(rule.table, {})[number] = rule
        elif rule.test in R.KEY_TESTS:
            count = _key_count(tables, rule).select(F.col("failing_rows").alias(f"rule_{number}"))
            parts.append(_by_rule(count, [number]))
        else:
            unknown.append(number)
    for table, numbered in row_rules.items():
        parts.append(_by_rule(R.count_breaks(tables[table], numbered), list(numbered)))
    if unknown:
        spark = next(iter(tables.values())).sparkSession
        zeros = [F.lit(0).cast("bigint").alias(f"rule_{n}") for n in unknown]
        parts.append(_by_rule(spark.range(1).select(*zeros), unknown))

    if not parts:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.range(0).selectExpr("CAST(id AS INT) AS rule_no", "id AS failing_rows"))

    known = F.col("test").isin(*R.ROW_TESTS, *R.KEY_TESTS)
    status = F.when(~known, "SKIP").when(F.col("failing_rows") == 0, "PASS").otherwise("FAIL")
    declared = F.element_at(_declarations(rules), F.col("rule_no"))
    return (
        reduce(DataFrame.unionByName, parts)
        .select("rule_no", "failing_rows", declared.alias("declared"))
        .select("rule_no", "failing_rows", "declared.*")
        .select("rule_no", *[status.alias(c) if c == "status" else c for c in RESULT_COLUMNS])
        .orderBy("rule_no")
    )


def _score(*more):
    """Totals and score; a skipped test counts in the total but not as a failure."""
    passed, failed = F.count_if(F.col("status") == "PASS"), F.count_if(F.col("status") == "FAIL")
    share = F.bround(M.percent_of(passed, F.count("*")), 1)
    return [
        F.count("*").cast("int").alias("total_tests"),
        passed.cast("int").alias("passed"),
        failed.cast("int").alias("failed"),
        F.coalesce(share, F.lit(0.0)).alias("quality_score"),
        *more,
    ]


def quality_score(results):
    return results.agg(*_score()).withColumns(
        {
            "score_tone": M.score_tone(F.col("quality_score")),
            "failed_tone": M.failure_tone(F.col("failed")),
            "gate_open": F.col("failed") == 0,
        }
    )


def quality_report(results, generated_at):
    """The whole report as one row; its array is as long as the contract."""
    listed = F.array_sort(F.collect_list(F.struct("rule_no", *RESULT_COLUMNS)))
    plain = F.transform("listed", lambda r: F.struct(*[r[c].alias(c) for c in RESULT_COLUMNS]))
    return (
        results.agg(*_score(listed.alias("listed")))
        .withColumns({"generated_at": F.lit(generated_at), "results": plain})
        .select("generated_at", "total_tests", "passed", "failed", "quality_score", "results")
    )


def enforce(results):
    """Stop the calling job when a test failed; skipped tests do not count."""
    failed = results.where(F.col("status") == "FAIL").count()
    if failed:
        raise QualityGateError(f"{failed} quality tests failed")

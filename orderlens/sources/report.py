"""Quality report as a JSON file."""

REPORT_SCHEMA = """
    generated_at string, total_tests int, passed int, failed int, quality_score double,
    results array<struct<`table`: string, `column`: string, test: string,
        status: string, failing_rows: bigint, detail: string>>
"""


def write_report(report, path):
    """The report is one row; it becomes one JSON document in ``path``."""
    report.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark, path):
    return spark.read.schema(REPORT_SCHEMA).option("multiLine", True).json(path)

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import schema as S
from orderlens.functions import texts
from orderlens.functions.timestamps import month_label, month_start, parse_minutes
from orderlens.operators.staging import fact, stage, with_double_amounts
from orderlens.sources import tables

NINE = dt.datetime(2015, 1, 5, 9, 7)


def raw_frame(spark, *rows, schema=S.RAW_TYPES):
    defaults = {
        "Order Id": 1,
        "Order Item Id": 10,
        "order date (DateOrders)": "1/5/2015 9:07",
        "shipping date (DateOrders)": "01/08/2015 09:07",
        "Days for shipping (real)": 3.0,
        "Days for shipment (scheduled)": 4.0,
        "Late_delivery_risk": 0.0,
        "Delivery Status": S.EARLY,
        "Sales": Decimal("327.75"),
        "Order Item Quantity": 1.0,
    }
    fields = [T.StructField(n, t) for n, t in schema.items()]
    data = [tuple({**defaults, **row}.get(n) for n in schema) for row in rows]
    return spark.createDataFrame(data, T.StructType(fields))


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1/5/2015 9:07", NINE),
        ("01/05/2015 09:07", NINE),
        (" 1/5/2015  9:07 ", NINE),
        ("\t1/5/2015 9:07\n", NINE),
        ("12/31/2017 23:59", dt.datetime(2017, 12, 31, 23, 59)),
        ("2/29/2016 0:00", dt.datetime(2016, 2, 29)),
        ("2/29/2015 0:00", None),
        ("13/5/2015 9:07", None),
        ("1/5/2015 24:00", None),
        ("1/5/2015 9:60", None),
        ("1/5/2015", None),
        ("1/5/2015 9:07:33", None),
        ("2015-01-05 09:07:00", None),
        ("n/a", None),
        ("", None),
        (None, None),
    ],
)
def test_date_text(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string").select(parse_minutes(F.col("s")).alias("t"))
    assert df.schema["t"].dataType == T.TimestampNTZType()
    assert df.first()["t"] == expected


def test_dates_do_not_depend_on_the_session_zone(spark):
    # 2:30 on that day does not exist in New York.
    texts = spark.createDataFrame([("3/8/2015 2:30",)], "s string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        parsed = texts.select(parse_minutes(F.col("s")).alias("t")).select("t", month_start(F.col("t")).alias("m"))
        row = parsed.select("t", "m", month_label(F.col("m")).alias("label")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == (dt.datetime(2015, 3, 8, 2, 30), dt.datetime(2015, 3, 1), "2015-03")


def test_strict_dates_stop_the_job(spark):
    good = stage(raw_frame(spark, {}, {"order date (DateOrders)": None}), strict_dates=True)
    assert [r["order_ts"] for r in good.collect()] == [NINE, None]
    bad = stage(raw_frame(spark, {"order date (DateOrders)": "soon"}), strict_dates=True)
    with pytest.raises(PySparkException):
        bad.collect()


def test_staged_columns_and_types(spark):
    staged = stage(raw_frame(spark, {}))
    assert staged.columns == S.FACT_COLUMNS and staged.schema["sales"].dataType == S.WIDE_MONEY
    assert [(f.name, f.dataType) for f in fact(staged).schema] == [(f.name, f.dataType) for f in S.FACT_SCHEMA]
    row = staged.first()
    assert row["order_month"] == dt.datetime(2015, 1, 1) and row["order_year"] == 2015
    assert row["delay_days"] == -1 and row["sales"] == Decimal("327.75")


def test_personal_columns_are_not_staged(spark):
    raw = raw_frame(spark, {}).withColumn("Customer Email", F.lit("a@b.c"))
    assert set(stage(raw).columns) == set(S.FACT_COLUMNS)


@pytest.mark.parametrize(
    "status, flags",
    [
        (S.LATE, (True, False, False)),
        (S.EARLY, (False, True, False)),
        (S.ON_TIME, (False, True, False)),
        (S.CANCELED, (False, False, True)),
        ("something else", (False, False, False)),
        (None, (None, None, None)),
    ],
)
def test_delivery_flags(spark, status, flags):
    row = stage(raw_frame(spark, {"Delivery Status": status})).first()
    assert (row["is_late"], row["is_on_time"], row["is_canceled"]) == flags


@pytest.mark.parametrize("given, expected", [(2.5, 2), (3.5, 4), (-0.5, 0), (2.4, 2), (None, None)])
def test_fractional_days_round_half_to_even(spark, given, expected):
    assert stage(raw_frame(spark, {"Days for shipping (real)": given})).first()["days_real"] == expected


AS_TEXT = {name: T.StringType() for name in S.RAW_TYPES}


def text_frame(spark, **values):
    given = {"Order Id": "1", "Order Item Id": "10", "Sales": "327.75", "Order Item Quantity": "1"}
    given |= {"Days for shipping (real)": "3", "Days for shipment (scheduled)": "4", "Late_delivery_risk": "0"}
    return raw_frame(spark, given | values, schema=AS_TEXT)


@pytest.mark.parametrize(
    "name, text",
    [
        ("Sales", "many"),
        ("Sales", " "),
        ("Sales", "1e21"),
        ("Order Item Discount Rate", "12%"),
        ("Order Item Quantity", "few"),
        ("Order Item Quantity", "3000000000"),
        ("Days for shipping (real)", "soon"),
        ("Order Id", "x1"),
        ("Order Id", "99999999999999999999"),
        ("Order Item Profit Ratio", "a"),
    ],
)
def test_a_number_that_does_not_fit_stops_the_job(spark, name, text):
    with pytest.raises(PySparkException, match="does not fit"):
        stage(text_frame(spark, **{name: text})).collect()


def test_numbers_as_text(spark):
    large = "12345678901234567890.5"
    row = stage(text_frame(spark, **{"Sales": large, "Order Id": "7.0", "Days for shipping (real)": "2.5", "Order Item Quantity": None})).first()
    assert row["sales"] == Decimal(large) and row["order_id"] == 7 and row["days_real"] == 2 and row["quantity"] is None


def test_large_amounts_are_in_the_sums(spark):
    rows = [{"Sales": Decimal(v), "Order Item Id": i} for i, v in enumerate(("12345678901.5", "10", "1"))]
    assert stage(raw_frame(spark, *rows)).agg(F.sum("sales")).first()[0] == Decimal("12345678912.5")


def test_amounts_beyond_the_fact_stop_it_or_make_it_wide(spark, tmp_path):
    staged = stage(text_frame(spark, **{"Sales": "12345678901.5", "order date (DateOrders)": "1/2/2016 10:00"}))
    with pytest.raises(PySparkException, match="sales does not fit"):
        fact(staged).collect()
    tables.write_fact(fact(staged, wide_amounts=True), str(tmp_path / "wide"))
    assert tables.read_fact(spark, str(tmp_path / "wide")).first()["sales"] == Decimal("12345678901.5")
    tables.write_fact(fact(staged).limit(0), str(tmp_path / "none"))
    assert tables.read_fact(spark, str(tmp_path / "none")).schema["sales"].dataType == S.MONEY


def test_fact_keeps_dated_lines_only(spark):
    raw = raw_frame(spark, {}, {"order date (DateOrders)": None}, {"order date (DateOrders)": "n/a"})
    assert fact(stage(raw)).count() == 1


def test_long_decimals_survive(spark):
    raw = raw_frame(spark, {"Sales": Decimal("314.64001460"), "Order Item Discount Rate": Decimal("0.050000001")})
    row = stage(raw).first()
    assert row["sales"] == Decimal("314.6400146") and row["discount_rate"] == Decimal("0.050000001")


@pytest.mark.parametrize("kind", ["int", "long"])
def test_whole_numbers_however_they_are_written(spark, kind):
    name = {"int": "Order Item Quantity", "long": "Order Id"}[kind]
    known = {"3": 3, "3.0": 3, "2.5": 2, "3.5": 4, "-1.5": -2, "1e3": 1000, " 4 ": 4, "+5": 5, "7.": 7, "\x7f8": 8, None: None}
    if kind == "long":
        known |= {"9007199254740993": 2**53 + 1, "-9223372036854775808": -(2**63)}
    column = {"int": "quantity", "long": "order_id"}[kind]
    for text, want in known.items():
        assert stage(text_frame(spark, **{name: text})).first()[column] == want, text


def code_size(df):
    """Bytes of the longest method of a plan; the JVM leaves one of over 8,000 uncompiled."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(mode))))


def test_staging_of_a_file_is_compiled(spark, tmp_path):
    text_frame(spark).write.parquet(str(tmp_path / "raw"))
    staged = stage(spark.read.parquet(str(tmp_path / "raw")))
    assert 0 < code_size(with_double_amounts(staged)) < 8000
    staged.write.parquet(str(tmp_path / "staged"))
    narrowed = fact(spark.read.parquet(str(tmp_path / "staged")))
    kinds = {f.name: f.dataType.simpleString() for f in narrowed.schema if isinstance(f.dataType, T.StringType)}
    packed = narrowed.select(*[c for c in narrowed.columns if c not in kinds], texts.joined(kinds).alias("t"))
    assert code_size(packed) < 8000


def test_no_value_of_a_file_is_cast_in_vain(spark):
    """A text with a point fails as a whole number, at the price of an exception a line."""
    staged = stage(text_frame(spark)).select("days_real", "order_id")
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"coalesce\(try_cast\(rint\(try_cast\(Days for shipping \(real\)#\d+ as double\)\)", plan, re.I) or re.search(
        r"coalesce\(cast\(rint\(cast\(Days for shipping \(real\)#\d+ as double\)\)", plan, re.I
    ), plan
    assert "Contains(Order Id" in plan, plan

import csv
import datetime as dt
import io
import random
import re
import json
import subprocess
import sys
import time
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from orderlens import schema as S
from orderlens.contracts import packaged_contract
from orderlens.functions import texts
from orderlens.operators.staging import fact, stage
from orderlens.plans.warehouse import Warehouse
from orderlens.session import initial_partitions, workspace
from orderlens.sources import contract, raw_csv, report, star, tables

ROOT = str(Path(__file__).resolve().parents[1])
HEADER = ["Order Id", "Customer Email", "Sales", "Product Name", "order date (DateOrders)", "Order Item Quantity"]


def write(path, lines, encoding="utf-8"):
    path.write_bytes("\n".join(lines).encode(encoding))
    return str(path)


def test_columns_are_found_by_name(spark, tmp_path):
    path = write(tmp_path / "a.csv", [",".join(HEADER), '7,x@y.z,12.5,"Tent, ""big""",1/5/2015 9:07,3'])
    raw = raw_csv.read_order_lines(spark, path)
    assert raw.columns == HEADER
    assert {f.dataType.simpleString() for f in raw.schema} == {"string"}
    row = raw.first()
    assert row["Product Name"] == 'Tent, "big"' and row["Sales"] == "12.5" and row["Order Item Quantity"] == "3"


def test_unpadded_and_padded_headers_and_empty_fields(spark, tmp_path):
    path = write(tmp_path / "a.csv", ["Order Id  , Sales,Product Name", "1,,", '2,1.25,Tent', '3,"",""'])
    rows = raw_csv.read_order_lines(spark, path).orderBy("Order Id").collect()
    assert [tuple(r) for r in rows] == [("1", None, None), ("2", "1.25", "Tent"), ("3", None, None)]


def test_scan_hands_on_only_selected_columns(spark, tmp_path):
    path = write(tmp_path / "a.csv", [",".join(HEADER), "7,x@y.z,12.5,Tent,1/5/2015 9:07,3"])
    plan = raw_csv.read_order_lines(spark, path).select("Sales")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Sales:string>" in plan


@pytest.mark.parametrize("line", ["1,2.5", "1,2.5,Tent,more", '1,2.5,"Tent\nbig"'])
def test_records_with_another_number_of_fields_are_refused(spark, tmp_path, line):
    path = write(tmp_path / "a.csv", ["Order Id,Sales,Product Name", "7,1,Boat", line, "8,2,Tent"])
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        raw_csv.read_order_lines(spark, path).select("Sales").collect()


def test_quoted_line_breaks(spark, tmp_path):
    lines = ["Order Id,Sales,Product Name", '1,2.5,"Tent\nbig"', '2,1,"  Boat "', "3,4,Tent"]
    path = write(tmp_path / "a.csv", lines)
    rows = raw_csv.read_order_lines(spark, path, multiline=True).collect()
    assert sorted((r["Order Id"], r["Product Name"]) for r in rows) == [("1", "Tent\nbig"), ("2", "  Boat "), ("3", "Tent")]
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        raw_csv.read_order_lines(spark, path).collect()


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
@pytest.mark.parametrize("size", [37, 400, 100_000])
def test_line_breaks_at_borders_of_ranges(spark, tmp_path, size, encoding):
    """Files divided into ranges of any size, against a plain reader; quoted text holds what may mislead."""
    draw = random.Random(size)
    pieces = ["\n", "\n\n", '"', ",", "x", "é", " ", "word", '\n"', "a,b\n1,2,3"]
    rows = [[str(i), "".join(draw.choices(pieces, k=draw.randint(0, 9))), draw.choice(["", "Tent", "Ü"])] for i in range(300)]
    rows[7][1], rows[150][1] = "long\n" * 300, "\n" * 200  # over several ranges
    (tmp_path / "in").mkdir()
    for number, end in enumerate(("\n", "\r\n")):
        text = io.StringIO(newline="")
        writer = csv.writer(text, lineterminator=end)
        writer.writerow(["Order Id", "Sales", "Product Name"])
        for k, row in enumerate(rows[number::2]):
            writer.writerow(row)
            if k % 40 == 3:
                text.write(end)  # a blank line between records
        (tmp_path / "in" / f"{number}.csv").write_bytes(text.getvalue().encode(encoding))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        name = {"utf-8": "UTF-8", "latin-1": "ISO-8859-1"}[encoding]
        found = raw_csv.read_order_lines(spark, str(tmp_path / "in"), name, multiline=True).collect()
        ranges = raw_csv.divided_records(spark, str(tmp_path / "in")).select("file", "place.range").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, found), key=lambda r: int(r[0])) == [tuple(v or None for v in row) for row in rows]
    assert ranges > 10 or size == 100_000


@pytest.mark.parametrize("name", ["UTF-8", "ISO-8859-1"])
def test_compressed_files_are_read_without_a_shuffle(spark, tmp_path, monkeypatch, name):
    """Many small files in place of few that need dividing; texts come back as they were."""
    monkeypatch.setattr(raw_csv, "RECORDS_A_FILE", 40)
    draw = random.Random(5)
    pieces = ["\n", "\n\n", '"', ",", "x", "é", " ", "word", '\n"', "a,b\n1,2,3"]
    rows = [(str(i), "".join(draw.choices(pieces, k=draw.randint(0, 9))) or None, draw.choice([None, "Tent", "Ü"])) for i in range(300)]
    given = spark.createDataFrame(rows, "`Order Id` string, Sales string, `Product Name` string").coalesce(2)
    raw_csv.write_order_lines(given, str(tmp_path / "in"), name, "gzip")
    files = list((tmp_path / "in").glob("*.csv.gz"))
    assert len(files) >= 8 and not list((tmp_path / "in").glob("*.csv"))
    found = raw_csv.read_order_lines(spark, str(tmp_path / "in"), name, multiline=True)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect()), key=lambda r: int(r[0])) == rows
    if name != "UTF-8":
        raw_csv.transcode(spark, str(tmp_path / "in"), str(tmp_path / "out"), name, True, "gzip")
        again = raw_csv.read_order_lines(spark, str(tmp_path / "out"), multiline=True)
        assert sorted(map(tuple, again.collect()), key=lambda r: int(r[0])) == rows


def test_headers_are_compared_in_divided_files(spark, tmp_path):
    write(tmp_path / "a.csv", ["Order Id,Sales", '1,"2\n5"'])
    write(tmp_path / "b.csv", ["Sales,Order Id", "2.5,1"])
    with pytest.raises(Exception, match="header differs"):
        raw_csv.read_order_lines(spark, str(tmp_path), multiline=True).collect()
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        raw_csv.read_order_lines(spark, write(tmp_path / "c.csv", ["A,B", "1,2,3"]), multiline=True).select("A").collect()


def test_transcoding_keeps_blanks_and_line_breaks(spark, tmp_path):
    lines = ["Order Id,Category Name,Product Name", '1,Baby ,"é\n ""b"" "', '2,Baby,""', "3, Baby,"]
    source = write(tmp_path / "latin.csv", lines, "latin-1")
    raw_csv.transcode(spark, source, str(tmp_path / "utf8"), multiline=True)
    direct = raw_csv.read_order_lines(spark, source, "ISO-8859-1", multiline=True).collect()
    again = raw_csv.read_order_lines(spark, str(tmp_path / "utf8"), multiline=True).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, direct))
    assert sorted(map(tuple, direct)) == [("1", "Baby ", 'é\n "b" '), ("2", "Baby", None), ("3", " Baby", None)]


def test_files_with_other_headers_are_refused(spark, tmp_path):
    write(tmp_path / "a.csv", ["Order Id,Sales", "1,2.5"])
    write(tmp_path / "b.csv", ["Sales,Order Id", "2.5,1"])
    with pytest.raises(Exception, match="CSV header does not conform"):
        raw_csv.read_order_lines(spark, str(tmp_path)).collect()


def test_latin1_is_decoded_and_rewritten_as_utf8(spark, tmp_path):
    source = write(tmp_path / "latin.csv", ["Order Id,Product Name", "1,Niñez", "2,été"], "latin-1")
    direct = raw_csv.read_order_lines(spark, source, "ISO-8859-1")
    assert {r["Product Name"] for r in direct.collect()} == {"Niñez", "été"}
    raw_csv.transcode(spark, source, str(tmp_path / "utf8"))
    again = raw_csv.read_order_lines(spark, str(tmp_path / "utf8"))
    assert again.collect() == direct.collect()


def test_transcoding_keeps_the_spelling_of_numbers(spark, tmp_path):
    source = write(tmp_path / "latin.csv", ["Order Id,Sales", "1,1.50", "02,-0.0"], "latin-1")
    raw_csv.transcode(spark, source, str(tmp_path / "utf8"))
    lines = {r[0] for r in spark.read.text(str(tmp_path / "utf8")).collect()}
    assert lines == {"Order Id,Sales", "1,1.50", "02,-0.0"}


def test_column_dictionary_is_trimmed(spark, tmp_path):
    lines = ["FIELDS,DESCRIPTION", "Sales   ,:  Amount", 'Market,":  Market : Africa , Europe "']
    rows = raw_csv.read_column_dictionary(spark, write(tmp_path / "d.csv", lines)).collect()
    assert [tuple(r) for r in rows] == [("Sales", "Amount"), ("Market", "Market : Africa , Europe")]


def test_whole_rebuild_from_a_small_file(spark, tmp_path):
    names = list(S.RAW_TYPES)
    line = {
        "Order Id": "1", "Order Item Id": "10", "order date (DateOrders)": "1/5/2015 9:07",
        "shipping date (DateOrders)": "1/8/2015 9:07", "Days for shipping (real)": "3",
        "Days for shipment (scheduled)": "2", "Delivery Status": S.LATE, "Shipping Mode": "First Class",
        "Late_delivery_risk": "1", "Market": "Europe", "Order Region": "Western Europe", "Sales": "100.5",
        "Order Profit Per Order": "10.05", "Order Item Discount Rate": "0.1", "Order Item Quantity": "2",
    }
    rows = [line, {**line, "Order Item Id": "11"}, {**line, "order date (DateOrders)": "n/a"}]
    path = write(tmp_path / "raw.csv", [",".join(names)] + [",".join(r.get(n, "") for n in names) for r in rows])
    house = Warehouse(spark, str(tmp_path / "house")).build(raw_csv.read_order_lines(spark, path))
    assert spark.table("stg_sales").count() == 3
    assert house.fact().columns == S.FACT_COLUMNS and house.fact().count() == 2
    assert house.undated_lines() == 1 and house.raw().columns == names
    month = house.mart("mart_monthly_performance").first()
    assert month["order_month"] == dt.datetime(2015, 1, 1)
    assert (month["nb_orders"], month["nb_lines"], month["sales"], month["margin_pct"]) == (1, 2, 201.0, 10.0)
    assert {r["object"]: r["nb_rows"] for r in house.row_counts().collect()} == {
        "raw_order_lines": 3, "fct_sales": 2, "mart_monthly_performance": 1, "mart_shipping_mode": 1,
        "mart_category_finance": 1, "mart_region": 1,
    }


def test_fact_roundtrip_keeps_types_and_rows(spark, make_fact, tmp_path):
    lines = make_fact({}, {"order_ts": dt.datetime(2017, 7, 1, 1, 1)}, {"market": None})
    tables.write_fact(lines, str(tmp_path / "f"))
    back = tables.read_fact(spark, str(tmp_path / "f"))
    assert back.schema.simpleString() == S.FACT_SCHEMA.simpleString()
    assert sorted(back.collect(), key=lambda r: r["order_id"]) == sorted(lines.collect(), key=lambda r: r["order_id"])
    tables.write_fact(lines.limit(1), str(tmp_path / "f"))
    assert tables.read_fact(spark, str(tmp_path / "f")).count() == 1


def test_texts_of_a_fact_come_back_whatever_they_hold(spark, make_fact, tmp_path):
    odd = ["", None, "\x1f", "\x1b", "\x1bn", "\x1bs", "\x1be\x1f\x1b", "a\x1fb\x1f", "é,\n\"\\", " "]
    lines = make_fact(*[{"market": a, "product_name": b, "payment_type": b} for a in odd for b in odd])
    tables.write_fact(lines, str(tmp_path / "f"))
    back = tables.read_fact(spark, str(tmp_path / "f"))
    assert sorted(back.collect(), key=lambda r: r["order_id"]) == sorted(lines.collect(), key=lambda r: r["order_id"])


def test_a_fact_is_shuffled_in_less_room_than_its_rows(spark, make_fact, tmp_path):
    """Texts cross the shuffle as one column beside the numbers, and files are compressed by zstd."""
    seen = []
    plain = tables._joined
    tables._joined = lambda texts: seen.append(texts) or plain(texts)
    try:
        tables.write_fact(make_fact({}, {}), str(tmp_path / "f"))
    finally:
        tables._joined = plain
    assert len(seen) == 1 and {"market", "product_name", "payment_type"} <= set(seen[0])
    assert all(".zstd." in f.name for f in (tmp_path / "f").glob("*/*.parquet"))


def test_joined_columns_come_back(spark):
    odd = ["", None, "\x1f", "\x1b", "\x1bn", "\x1bs", "\x1be\x1f\x1b", "a\x1fb\x1f", "é", " "]
    kinds = {"s": "string", "i": "int", "b": "boolean", "d": "decimal(6,2)", "t": "string"}
    rows = [(a, i, b, d, a) for a in odd for i in (None, -(2**31), 7) for b in (None, True, False) for d in (None, Decimal("-0.05"), Decimal("9999.99"))]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in kinds.items()))
    one = df.select(texts.joined(kinds).alias("x")).withColumns(texts.parted("x", kinds)).drop("x")
    assert one.dtypes == df.dtypes and sorted(map(repr, one.collect())) == sorted(map(repr, df.collect()))
    # Joined apart and chained, one part of it not there.
    chained = texts.chained(texts.joined({"s": "string"}), texts.absent(2), texts.joined({"t": "string"}))
    back = df.select(chained.alias("x")).withColumns(texts.parted("x", dict.fromkeys("sabt", "string")))
    assert sorted(map(repr, back.select("s", "a", "b", "t").collect())) == sorted(repr(Row(s=r[0], a=None, b=None, t=r[0])) for r in rows)
    assert tuple(df.limit(1).select(F.lit(None).cast("string").alias("x")).withColumns(texts.parted("x", kinds)).drop("x").first()) == (None,) * 5


def test_whole_lines_equal_those_of_single_columns(spark, tmp_path):
    """Lines with odd texts, and without part, supplier, order, customer or nation; keys come twice and are null."""
    odd = ["", None, "\x1f", "\x1bn", "a\x1fb"]
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    put("region", [(0, "\x1f"), (1, None)], "r_regionkey long, r_name string")
    put("nation", [(0, "é", 0), (1, None, 1), (2, "\x1bs", 7)], "n_nationkey long, n_name string, n_regionkey long")
    put("customer", [(i, i % 4, odd[i % 5]) for i in range(6)], "c_custkey long, c_nationkey long, c_mktsegment string")
    put("supplier", [(0, 0), (1, 1), (2, None), (2, 2)], "s_suppkey long, s_nationkey long")
    put("part", [(i % 4, odd[i], odd[-i], odd[i - 1], [1.25, None, 3.0][i % 3]) for i in range(5)], "p_partkey long, p_type string, p_brand string, p_name string, p_retailprice double")
    day = dt.datetime(1996, 1, 2)
    orders = [(i or None, i % 8, odd[i % 5], day if i % 3 else None, ["1-URGENT", None, "2-HIGH"][i % 3]) for i in range(7)] + [(3, 1, "F", day, "x")]
    put("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string")
    lines = [
        (i % 9 or None, i % 6 or None, i % 5, [1, None, 7][i % 3], [5.0, None][i % 2], [100.25, None, -3.5][i % 3], [0.07, -0.1, None][i % 3], odd[i % 5], ["F", None][i % 2])
        for i in range(90)
    ]
    put("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string")
    one, single = (star.order_lines(spark, str(tmp_path), whole=whole) for whole in (True, False))
    assert one.dtypes == single.dtypes and one.count() > 90
    assert sorted(map(repr, one.collect())) == sorted(map(repr, single.collect()))


def test_whole_lines_are_shuffled_in_less_room(spark, folder):
    """Beside the key a line has two amounts and one text when it is shuffled by order."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = star.order_lines(spark, folder, whole=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    below = re.search(r"Exchange hashpartitioning\(l_orderkey.*\n[^\n]*?Project \[(.*)\]", plan).group(1)
    assert re.match(r"l_orderkey#\d+L, sales#\d+, .* AS unit_cost#\d+, concat_ws\(.*\) AS _line_texts#\d+$", below), below
    assert not re.search("quantity|l_suppkey|p_name|l_returnflag", below)


def test_fast_gzip_holds_the_same_records(spark, tmp_path):
    lines = spark.range(20_000).select(F.col("id").cast("string").alias("Order Id"), F.sha2(F.col("id").cast("string"), 256).alias("Sales"))
    for name, fast in (("fast", True), ("small", False)):
        raw_csv.write_order_lines(lines.coalesce(1), str(tmp_path / name), compression="gzip", fast=fast)
    size = lambda name: sum(f.stat().st_size for f in (tmp_path / name).glob("*.gz"))
    assert size("fast") > size("small")
    assert sorted(raw_csv.read_order_lines(spark, str(tmp_path / "fast"), multiline=True).collect()) == sorted(lines.collect())


DOCUMENT = {
    "tables": [
        {"name": "raw", "columns": []},
        {
            "name": "t",
            "description": "  two\n words ",
            "grain": "row",
            "columns": [
                {"name": "a", "tests": ["not_null", {"accepted_range": {"min": 0}, "ignored": {}}]},
                {"name": "b"},
                {"name": "c", "tests": [{"accepted_values": {"values": ["x", 1]}}]},
            ],
        },
    ]
}


def check_contract(found):
    assert [(r.column, r.test, r.options) for r in found.rules] == [
        ("a", "not_null", {}),
        ("a", "accepted_range", {"min": 0}),
        ("c", "accepted_values", {"values": ["x", 1]}),
    ]
    assert [(d.table, d.column, d.type) for d in found.columns] == [("t", "a", ""), ("t", "b", ""), ("t", "c", "")]
    assert [(d.table, d.description, d.documented_columns) for d in found.tables] == [("raw", "", 0), ("t", "two words", 3)]


def test_contract_from_json(spark, tmp_path):
    check_contract(contract.read_contract(spark, write(tmp_path / "c.json", [json.dumps(DOCUMENT, indent=1)])))


def test_contract_from_yaml(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    check_contract(contract.read_contract(spark, write(tmp_path / "c.yml", [yaml.safe_dump(DOCUMENT, sort_keys=False)])))


def test_packaged_contract_declares_the_known_rules():
    rules = packaged_contract("order_lines").rules
    count = lambda test: sum(r.test == test for r in rules)
    assert len(rules) == 23 and len({r.column for r in rules}) == 13
    tests = ["not_null", "accepted_values", "accepted_range", "positive", "unique", "relationships"]
    assert [count(t) for t in tests] == [13, 4, 3, 2, 1, 0]


def test_report_roundtrip(spark, tmp_path):
    document = spark.range(1).select(
        F.lit("2024-01-01T00:00:00").alias("generated_at"),
        *[F.lit(n).alias(c) for c, n in (("total_tests", 1), ("passed", 0), ("failed", 1))],
        F.lit(0.0).alias("quality_score"),
        F.expr(
            "array(named_struct('table', 't', 'column', 'é', 'test', 'x', 'status', 'FAIL', "
            "'failing_rows', 3000000000, 'detail', ''))"
        ).alias("results"),
    )
    report.write_report(document, str(tmp_path / "r"))
    assert report.read_report(spark, str(tmp_path / "r")).collect() == document.collect()


def stub(master, **conf):
    context = SimpleNamespace(applicationId="app-1", master=master)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_workspace_follows_the_cluster_setting():
    session = stub("spark://host:7077", **{"spark.checkpoint.dir": "/shared/folder/"})
    assert workspace(session) == "/shared/folder/orderlens/app-1"


def test_workspace_is_never_local_on_a_cluster():
    with pytest.raises(ValueError):
        workspace(stub("yarn"))
    assert workspace(stub("local[2]")) == workspace(stub("local[2]"))


def test_look_alike_sources_get_folders_of_their_own(spark):
    from orderlens.checks.registry import _scratch

    assert len({_scratch(spark, folder, "x") for folder in ("/a/b-c", "/a/b_c", "/a/b/c")}) == 3


def test_workspace_is_gone_when_the_application_ends(tmp_path):
    code = (
        "from orderlens.session import get_session, workspace\n"
        f"s = get_session('t', 'local[1]', **{{'spark.ui.enabled': 'false', 'spark.checkpoint.dir': 'file://{tmp_path}/shared'}})\n"
        "path = workspace(s)\n"
        "s.range(3).write.parquet(path + '/x')\n"
        "print(s.read.parquet(path + '/x').count())\n"
        "s.stop()\n"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, timeout=120)
    assert done.stdout.strip().endswith("3"), done.stderr[-500:]
    for _ in range(50):
        if not list((tmp_path / "shared").glob("orderlens/*")):
            return
        time.sleep(0.2)
    raise AssertionError("scratch tables stayed")


def test_initial_partitions_follow_the_data():
    assert initial_partitions(1) == 200 and initial_partitions(100 * 1024) == 819_200


def test_rebuilt_fact_is_listed_again(spark, tmp_path):
    names = list(S.RAW_TYPES)
    row = {"Order Id": "1", "order date (DateOrders)": "1/5/2015 9:07"}
    line = ",".join(row.get(n, "") for n in names)
    one = raw_csv.read_order_lines(spark, write(tmp_path / "one.csv", [",".join(names), line]))
    two = raw_csv.read_order_lines(spark, write(tmp_path / "two.csv", [",".join(names), line, line]))
    house = Warehouse(spark, str(tmp_path / "house")).build_fact(one)
    assert house.fact() is house.fact() and house.fact().count() == 1
    assert house.build_fact(two).fact().count() == 2

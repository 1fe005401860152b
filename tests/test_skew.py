"""Hot keys: one order, part and supplier hold a third of all lines."""

import os

import pytest
from compare import TABLES, differences, oracle
from pyspark.sql import functions as F

from orderlens.checks.oracle import ORACLE_SQL
from orderlens.checks.registry import QUERIES

NAMES = [
    "fct_sales",
    "mart_monthly_performance",
    "mart_region",
    "kpi_cards",
    "market_summary",
    "category_margin_topflop",
    "dq_unique",
    "dq_relationships",
    "quality_results",
]
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture(scope="module")
def hot_folder(spark, folder, tmp_path_factory):
    hot = tmp_path_factory.mktemp("hot")
    for table in TABLES:
        if table != "lineitem":
            os.symlink(f"{folder}/{table}.parquet", hot / f"{table}.parquet")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    third = F.col("l_returnflag") == "R"
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    moved = lines.withColumns({k: F.when(third, F.lit(1).cast("bigint")).otherwise(F.col(k)) for k in keys})
    moved.repartition(8).write.parquet(f"file://{hot}/lineitem.parquet")
    return str(hot)


@pytest.fixture(scope="module")
def small_limits(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys_change_no_result(name, spark, hot_folder, small_limits):
    con = oracle(hot_folder)
    assert differences(QUERIES[name](spark, hot_folder), con, ORACLE_SQL[name]) == {}

"""Parquet tables of the warehouse."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.texts import joined, parted
from orderlens.schema import FACT_COLUMNS, FACT_SCHEMA
from orderlens.session import workspace


#: Bytes of a row group of the fact before compression: a file has a dozen, so that its sort order can skip some.
ROW_GROUP_BYTES = 32 << 20
#: Inside a file the lines are sorted by these. A line's market, mode and segment are its order's.
FACT_ORDER = ("order_year", "order_month", "market", "shipping_mode", "customer_segment", "order_id")


#: A stored column that readers do not see: the month counted from year 0. Spark compares no
#: timestamp without time zone with the bounds of row groups, but it does whole numbers.
MONTH_NUMBER = "_month_number"
#: Tables are written with it: a quarter smaller than Spark's default, for a tenth more time to write.
CODEC = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}


def write_fact(fact, path, row_group_bytes=ROW_GROUP_BYTES):
    """Replace the fact, partitioned by order year.

    The rebalance gathers each year into few well-sized files and splits a year
    that holds most of the rows over several tasks. Sorted by month, then by the three
    dimensions, each combination is one run of rows in a file: filters on any of them
    skip row groups by their bounds and dictionaries, and pages within those they
    read. Lines of one order stay together, so distinct-order counts shrink before they
    are shuffled. Texts, flags and short numbers travel as one text, which takes a third less
    in the shuffle.
    """
    month = F.col("order_month")
    kinds = {f.name: f.dataType.simpleString() for f in fact.schema if isinstance(f.dataType, _JOINED_TYPES)}
    kinds.pop("order_year", None)  # the rebalance asks for it
    columns = sorted(fact.columns, key=lambda c: _SIDE_BY_SIDE.get(c, len(_SIDE_BY_SIDE)))
    kinds = {c: kinds[c] for c in columns if c in kinds}
    (
        fact.select(*[c for c in columns if c not in kinds], _joined(kinds).alias(_TEXTS))
        .hint("rebalance", "order_year", "order_month")
        .withColumns(parted(_TEXTS, kinds))
        .drop(_TEXTS)
        .withColumn(MONTH_NUMBER, F.year(month) * 12 + F.month(month))
        .sortWithinPartitions(*FACT_ORDER)
        .write.mode("overwrite")
        .options(**CODEC)
        .option("parquet.block.size", row_group_bytes)
        .partitionBy("order_year")
        .parquet(path)
    )


_TEXTS, _joined = "_texts", joined
_JOINED_TYPES = (T.StringType, T.IntegerType, T.BooleanType)
# What lines of one order share stands together in the shuffle and compresses better, and so
# does what goes together otherwise: a status and its flags.
_SIDE_BY_SIDE = {
    name: place
    for place, name in enumerate(
        (
            "order_id", "order_ts", "order_month", "order_year", "shipping_ts", "order_item_id", "discount_rate",
            "sales", "order_total", "profit", "discount", "profit_ratio",
            "days_scheduled", "shipping_mode", "order_status", "market", "order_region", "customer_segment",
            "days_real", "delay_days", "quantity", "delivery_status", "is_late", "is_on_time", "is_canceled", "late_risk",
            "order_country", "payment_type", "department_name", "category_name", "product_name",
        )
    )
}


def read_fact(spark, path):
    """The fact with its declared columns and types; only the width of amounts is that of its files.

    Where the files have the month's number, ``order_month`` names it in its metadata, and
    ``apply_filters`` on what is returned here compares it too.
    """
    try:
        found = spark.read.parquet(path).schema
    except AnalysisException:  # a fact without lines has no files
        found = FACT_SCHEMA
    kinds = [T.StructField(f.name, found[f.name].dataType if isinstance(f.dataType, T.DecimalType) else f.dataType) for f in FACT_SCHEMA]
    if MONTH_NUMBER not in found.names:
        return spark.read.schema(T.StructType(kinds)).parquet(path).select(FACT_COLUMNS)
    kinds.append(T.StructField(MONTH_NUMBER, T.IntegerType()))
    month = F.col("order_month").alias("order_month", metadata={"number": MONTH_NUMBER})
    return spark.read.schema(T.StructType(kinds)).parquet(path).select([month if c == "order_month" else c for c in FACT_COLUMNS])


def write_table(df, path):
    df.write.mode("overwrite").options(**CODEC).parquet(path)


def read_table(spark, path):
    return spark.read.parquet(path)


# --- tables that readers see whole ------------------------------------------------

# A snapshot's folder is this and its number; Spark marks a finished write.
SNAPSHOT = "snapshot-"
FINISHED = "_SUCCESS"


def _files(spark, path):
    """Spark's file system of a path, and the path as an object of it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def snapshots(spark, path):
    """Number -> is it finished, of the snapshots of a table."""
    files, place = _files(spark, path)
    if not files.exists(place):
        return {}
    found = {}
    for status in files.listStatus(place):
        name = status.getPath().getName()
        if name.startswith(SNAPSHOT):
            done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), FINISHED)
            found[int(name[len(SNAPSHOT) :].split("-")[0])] = (name, files.exists(done))
    return found


def current(spark, path):
    """The folder of a table's latest finished snapshot; the path itself where it has none."""
    finished = [name for _, (name, done) in sorted(snapshots(spark, path).items()) if done]
    return f"{path}/{finished[-1]}" if finished else path


def replace(spark, path, write):
    """Replace a table by what ``write`` puts into the folder it is given.

    The table is written beside the old one and becomes current with the marker that
    Spark's writer leaves last: readers see the old rows or the new ones, never none,
    and a job that fails on the way leaves the old ones current. The snapshot before
    stays, for readers that have already listed its files; what is older, or was left
    unfinished by an earlier job, is deleted. One job at a time may replace a table.
    """
    before = snapshots(spark, path)
    number = max(before, default=0) + 1
    write(f"{path}/{SNAPSHOT}{number:010d}-{uuid.uuid4().hex[:8]}")
    kept = max((n for n, (_, done) in before.items() if done), default=None)
    for old, (name, _) in before.items():
        if old != kept:
            files, place = _files(spark, f"{path}/{name}")
            files.delete(place, True)


def counted(df, seen, column="*"):
    """``df`` with its rows counted while it is written; ``rows_counted(seen)`` has the number then.

    With ``column`` those that have a value there.
    """
    return df.observe(seen, F.count(column).alias("rows"))


def rows_counted(seen):
    return seen.get["rows"]


def written_aside(df):
    """A result that several later ones read, written to the scratch folder and read again.

    It is computed once, and a lost executor takes none of it along. Meant for results
    that are small beside their input; the folder goes when the driver ends.
    """
    path = f"{workspace(df.sparkSession)}/aside/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def count_rows(tables):
    """One row per named table: (object, nb_rows), every table counted in one job."""
    counts = [
        df.agg(F.count("*").alias("nb_rows")).select(F.lit(name).alias("object"), "nb_rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result

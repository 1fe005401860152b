"""Order lines assembled from a star of order, customer, part and supplier tables."""

from pyspark.sql import functions as F

from orderlens import schema as S
from orderlens.functions.texts import absent, chained, joined, parted

# Scheduled days promised by each order priority.
SCHEDULED_DAYS = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}
OTHER_SCHEDULED_DAYS = 4


# What crosses the shuffles as one text, in the order in which it is joined.
_OF_LINE = {"rate": "decimal(6,2)", "l_returnflag": "string", "l_linestatus": "string", "days_real": "int", "quantity": "int"}
_OF_PART = dict.fromkeys(("p_type", "p_brand", "p_name"), "string")
_OF_COUNTRY = {"Order Country": "string"}
_OF_ORDER = dict.fromkeys(("o_orderpriority", "o_orderstatus", "Market", "Order Region", "Customer Segment"), "string")
_LINE, _PART, _ORDER = "_line_texts", "_part_texts", "_order_texts"


def order_lines(spark, folder, whole=False):
    """Raw-shaped order lines, with real timestamps instead of date text.

    A line whose part, supplier, order, customer or nation is absent stays, without
    what they would tell.

    Every right side is a stored table or, for the order headers, a join kept at
    order grain, so the line table is shuffled at most once per key: part, supplier,
    order. No join carries a hint: Catalyst broadcasts a table whose stored size is
    under the session's threshold and otherwise sorts and merges, where adaptive
    execution splits hot keys. Amounts take their types before that, in which they are
    shorter. With ``whole``, for lines of which all columns are read, texts and small numbers
    cross the shuffles as one text; without it unread ones never leave the scan.
    """
    table = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    headers = (
        table("orders")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            "o_orderkey",
            "o_orderdate",
            "o_orderstatus",
            "o_orderpriority",
            F.col("c_mktsegment").alias("Customer Segment"),
            F.col("n_name").alias("Order Region"),
            F.col("r_name").alias("Market"),
        )
    )
    countries = table("nation").select(
        F.col("n_nationkey").alias("country_key"), F.col("n_name").alias("Order Country")
    )
    parts = table("part").select("p_partkey", "p_retailprice", *_OF_PART)
    lines = table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", *_line_measures())
    if whole:
        headers, parts = _packed(headers, _OF_ORDER, _ORDER), _packed(parts, _OF_PART, _PART)
        lines = _packed(lines, _OF_LINE, _LINE)
    lines = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(countries, F.col("s_nationkey") == F.col("country_key"), "left")
        .withColumn("unit_cost", F.col("p_retailprice").cast("decimal(18,2)"))
    )
    if whole:
        texts = chained(_LINE, F.coalesce(_PART, absent(len(_OF_PART))), joined(_OF_COUNTRY))
        lines = lines.select("l_orderkey", "sales", "unit_cost", texts.alias(_LINE))
    lines = lines.join(headers, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if whole:
        lines = lines.withColumns(parted(_LINE, _OF_LINE | _OF_PART | _OF_COUNTRY) | parted(_ORDER, _OF_ORDER))
    return lines.withColumn("days_scheduled", _days_scheduled()).withColumns(_amounts()).select(_raw_columns())


def _packed(df, kinds, name):
    """``df`` with the columns of ``kinds`` joined into one, which stands last."""
    return df.select(*[c for c in df.columns if c not in kinds], joined(kinds).alias(name))


def _line_measures():
    return [
        (F.col("l_linenumber") - 1).alias("days_real"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("sales"),
        F.abs("l_discount").cast("decimal(6,2)").alias("rate"),
    ]


def _days_scheduled():
    scheduled = F.lit(OTHER_SCHEDULED_DAYS)
    for priority, days in SCHEDULED_DAYS.items():
        scheduled = F.when(F.col("o_orderpriority") == priority, days).otherwise(scheduled)
    return scheduled


def _amounts():
    paid = (F.col("sales") * (1 - F.col("rate"))).cast(S.MONEY)
    gain = (paid - F.col("unit_cost") * F.col("quantity")).cast(S.MONEY)
    delay = F.col("days_real") - F.col("days_scheduled")
    canceled = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    status = (
        F.when(canceled, S.CANCELED)
        .when(delay > 0, S.LATE)
        .when(delay < 0, S.EARLY)
        .otherwise(S.ON_TIME)
    )
    return {
        "status": status,
        "shipped": F.col("o_orderdate") + F.make_dt_interval(F.col("days_real")),
        "order_total": paid,
        "profit": gain,
        "discount": (F.col("sales") * F.col("rate")).cast(S.MONEY),
    }


def _raw_columns():
    ratio = F.try_divide(F.col("profit").cast("double"), F.col("order_total").cast("double"))
    columns = {
        "Order Id": F.col("l_orderkey"),
        "Order Item Id": F.col("l_orderkey") * 10 + (F.col("days_real") + 1),
        "order date (DateOrders)": F.col("o_orderdate"),
        "shipping date (DateOrders)": F.col("shipped"),
        "Days for shipping (real)": F.col("days_real"),
        "Days for shipment (scheduled)": F.col("days_scheduled"),
        "Delivery Status": F.col("status"),
        "Shipping Mode": F.col("o_orderpriority"),
        "Late_delivery_risk": (F.col("status") == S.LATE).cast("int"),
        "Order Status": F.col("o_orderstatus"),
        "Market": F.col("Market"),
        "Order Region": F.col("Order Region"),
        "Order Country": F.col("Order Country"),
        "Customer Segment": F.col("Customer Segment"),
        "Department Name": F.col("p_type"),
        "Category Name": F.col("p_brand"),
        "Product Name": F.col("p_name"),
        "Type": F.col("l_returnflag"),
        "Sales": F.col("sales").cast(S.MONEY),
        "Order Item Total": F.col("order_total"),
        "Order Profit Per Order": F.col("profit"),
        "Order Item Profit Ratio": ratio,
        "Order Item Discount": F.col("discount"),
        "Order Item Discount Rate": F.col("rate").cast(S.RATE),
        "Order Item Quantity": F.col("quantity"),
    }
    return [column.alias(name) for name, column in columns.items()]


def as_file_text(raw):
    """The same lines with dates spelled as the raw file spells them."""

    def spelled(name):
        ts = F.col(f"`{name}`")
        day = F.concat_ws("/", F.month(ts), F.day(ts), F.year(ts))
        minute = F.concat(F.hour(ts), F.lit(":"), F.lpad(F.minute(ts).cast("string"), 2, "0"))
        return F.when(ts.isNotNull(), F.concat_ws(" ", day, minute))

    dates = ["order date (DateOrders)", "shipping date (DateOrders)"]
    return raw.withColumns({name: spelled(name) for name in dates})

"""Raw order lines to typed staging rows, and staging rows to the fact."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import schema as S
from orderlens.functions.timestamps import month_start, parse_minutes


def _fitting(name, *values):
    """The first of ``values`` that is there, or an error that stops the job where the column holds what none can.

    Every value stands here once: Spark computes anew what a condition and its branch share,
    and the JVM does not compile a projection that grows too long.
    """
    column = F.col(f"`{name}`")
    complaint = F.replace(F.lit(f"{name} does not fit: \x00"), F.lit("\x00"), column.cast("string"))
    return F.coalesce(*values, F.when(column.isNotNull(), F.raise_error(complaint)))


def _whole(raw, name, kind="int"):
    """Integer column; fractional input is rounded half to even."""
    column = F.col(f"`{name}`")
    exact = column.try_cast(kind)
    if isinstance(raw.schema[name].dataType, T.IntegralType):
        return _fitting(name, exact)
    rounded = F.rint(column.try_cast("double")).try_cast(kind)
    if not isinstance(raw.schema[name].dataType, T.StringType):
        return _fitting(name, rounded)
    # A cast of a text that fails costs an exception, which a line cannot afford: a double holds
    # every int, and what has a point is no whole number.
    if kind == "int":
        return _fitting(name, rounded, exact)
    return _fitting(name, F.when(~column.contains("."), exact), rounded)


def _time(raw, name, strict):
    if isinstance(raw.schema[name].dataType, T.StringType):
        return parse_minutes(F.col(f"`{name}`"), strict)
    return F.col(f"`{name}`").cast("timestamp_ntz")


def _typed(name):
    kind = S.RAW_TYPES[name]
    if isinstance(kind, T.StringType):
        return F.col(f"`{name}`").cast(kind)
    return _fitting(name, F.col(f"`{name}`").try_cast(kind))


def stage(raw, strict_dates=False):
    """Rename, prune and type the raw columns, then derive month, delay and flags.

    Names, e-mails, addresses and other personal fields of the raw file are not
    selected, so they never leave the scan. Dates are parsed once in the first
    projection and derived from in the second. A number that does not parse, or is
    too large for its column, stops the job; no amount turns into NULL.
    """
    typed = raw.select(
        _whole(raw, "Order Id", "long").alias("order_id"),
        _whole(raw, "Order Item Id", "long").alias("order_item_id"),
        _time(raw, "order date (DateOrders)", strict_dates).alias("order_ts"),
        _time(raw, "shipping date (DateOrders)", strict_dates).alias("shipping_ts"),
        _whole(raw, "Days for shipping (real)").alias("days_real"),
        _whole(raw, "Days for shipment (scheduled)").alias("days_scheduled"),
        _typed("Delivery Status").alias("delivery_status"),
        _typed("Shipping Mode").alias("shipping_mode"),
        _whole(raw, "Late_delivery_risk").alias("late_risk"),
        _typed("Order Status").alias("order_status"),
        _typed("Market").alias("market"),
        _typed("Order Region").alias("order_region"),
        _typed("Order Country").alias("order_country"),
        _typed("Customer Segment").alias("customer_segment"),
        _typed("Department Name").alias("department_name"),
        _typed("Category Name").alias("category_name"),
        _typed("Product Name").alias("product_name"),
        _typed("Type").alias("payment_type"),
        _typed("Sales").alias("sales"),
        _typed("Order Item Total").alias("order_total"),
        _typed("Order Profit Per Order").alias("profit"),
        _typed("Order Item Profit Ratio").alias("profit_ratio"),
        _typed("Order Item Discount").alias("discount"),
        _typed("Order Item Discount Rate").alias("discount_rate"),
        _whole(raw, "Order Item Quantity").alias("quantity"),
    )
    status = F.col("delivery_status")
    derived = {
        "order_month": month_start(F.col("order_ts")),
        "order_year": F.year("order_ts"),
        "delay_days": F.col("days_real") - F.col("days_scheduled"),
        "is_late": status == S.LATE,
        "is_on_time": status.isin(S.ON_TIME, S.EARLY),
        "is_canceled": status == S.CANCELED,
    }
    return typed.withColumns(derived).select(S.FACT_COLUMNS)


def fact(staged, wide_amounts=False):
    """Staged lines that have an order date, in the types of the fact.

    An amount with more than ten digits before the point stops the job, unless
    ``wide_amounts`` keeps the wider types of staging.
    """
    dated = staged.where(F.col("order_ts").isNotNull())
    if wide_amounts:
        return dated
    narrow = {f.name: f.dataType for f in S.FACT_SCHEMA if isinstance(f.dataType, T.DecimalType)}
    return dated.withColumns({name: _fitting(name, F.col(name).try_cast(kind)) for name, kind in narrow.items()})


def with_double_amounts(df):
    """Hand decimal amounts out as doubles, for consumers outside Spark."""
    amounts = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in amounts})

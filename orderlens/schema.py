"""Column names and types shared by every layer."""

from pyspark.sql import types as T

# Money keeps eight decimals: every digit of the source files survives. Staging allows
# twenty digits before the point. The fact keeps ten, unless asked for all: then a value
# is one long in files and rows, and a sum has ten digits more. Totals are exact and do
# not depend on how rows were partitioned.
WIDE_MONEY = T.DecimalType(28, 8)
WIDE_RATE = T.DecimalType(28, 12)
MONEY = T.DecimalType(18, 8)
RATE = T.DecimalType(18, 12)

# --- fixed values: columns of the raw order-line file used by staging ----------
# The types are those of staging; files are read as text and typed there.
# Whole-number fields are doubles so that "3.0" or "2.5" still parse; staging rounds
# them half to even.
RAW_TYPES = {
    "Order Id": T.LongType(),
    "Order Item Id": T.LongType(),
    "order date (DateOrders)": T.StringType(),
    "shipping date (DateOrders)": T.StringType(),
    "Days for shipping (real)": T.DoubleType(),
    "Days for shipment (scheduled)": T.DoubleType(),
    "Delivery Status": T.StringType(),
    "Shipping Mode": T.StringType(),
    "Late_delivery_risk": T.DoubleType(),
    "Order Status": T.StringType(),
    "Market": T.StringType(),
    "Order Region": T.StringType(),
    "Order Country": T.StringType(),
    "Customer Segment": T.StringType(),
    "Department Name": T.StringType(),
    "Category Name": T.StringType(),
    "Product Name": T.StringType(),
    "Type": T.StringType(),
    "Sales": WIDE_MONEY,
    "Order Item Total": WIDE_MONEY,
    "Order Profit Per Order": WIDE_MONEY,
    "Order Item Profit Ratio": T.DoubleType(),
    "Order Item Discount": WIDE_MONEY,
    "Order Item Discount Rate": WIDE_RATE,
    "Order Item Quantity": T.DoubleType(),
}

# --- fixed values: delivery statuses -------------------------------------------
LATE = "Late delivery"
EARLY = "Advance shipping"
ON_TIME = "Shipping on time"
CANCELED = "Shipping canceled"

FACT_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("order_item_id", T.LongType()),
        T.StructField("order_ts", T.TimestampNTZType()),
        T.StructField("shipping_ts", T.TimestampNTZType()),
        T.StructField("order_month", T.TimestampNTZType()),
        T.StructField("order_year", T.IntegerType()),
        T.StructField("days_real", T.IntegerType()),
        T.StructField("days_scheduled", T.IntegerType()),
        T.StructField("delay_days", T.IntegerType()),
        T.StructField("delivery_status", T.StringType()),
        T.StructField("shipping_mode", T.StringType()),
        T.StructField("late_risk", T.IntegerType()),
        T.StructField("is_late", T.BooleanType()),
        T.StructField("is_on_time", T.BooleanType()),
        T.StructField("is_canceled", T.BooleanType()),
        T.StructField("order_status", T.StringType()),
        T.StructField("market", T.StringType()),
        T.StructField("order_region", T.StringType()),
        T.StructField("order_country", T.StringType()),
        T.StructField("customer_segment", T.StringType()),
        T.StructField("department_name", T.StringType()),
        T.StructField("category_name", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("sales", MONEY),
        T.StructField("order_total", MONEY),
        T.StructField("profit", MONEY),
        T.StructField("profit_ratio", T.DoubleType()),
        T.StructField("discount", MONEY),
        T.StructField("discount_rate", RATE),
        T.StructField("quantity", T.IntegerType()),
    ]
)
FACT_COLUMNS = FACT_SCHEMA.fieldNames()

# Columns the exploration queries may touch: the fact without timestamps,
# product, payment type and the two amounts no breakdown reads.
_NOT_EXPLORED = {
    "order_ts",
    "shipping_ts",
    "product_name",
    "payment_type",
    "order_total",
    "discount",
}
EXPLORED_COLUMNS = [c for c in FACT_COLUMNS if c not in _NOT_EXPLORED]

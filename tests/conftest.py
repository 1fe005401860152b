import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from orderlens.schema import CANCELED, EARLY, FACT_COLUMNS, FACT_SCHEMA, LATE, ON_TIME  # noqa: E402
from orderlens.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "orderlens-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def make_fact(spark):
    """Build fact rows from a few columns; the rest gets plausible defaults."""

    def build(*rows):
        full = []
        for number, given in enumerate(rows, start=1):
            row = {
                "order_id": number,
                "order_item_id": number,
                "order_ts": dt.datetime(2016, 3, 5, 9, 7),
                "shipping_ts": dt.datetime(2016, 3, 8, 9, 7),
                "days_real": 3,
                "days_scheduled": 2,
                "delivery_status": LATE,
                "shipping_mode": "First Class",
                "late_risk": 1,
                "order_status": "COMPLETE",
                "market": "Europe",
                "order_region": "Western Europe",
                "order_country": "France",
                "customer_segment": "Consumer",
                "department_name": "Outdoors",
                "category_name": "Tents",
                "product_name": "Tent",
                "payment_type": "DEBIT",
                "sales": 100,
                "order_total": 90,
                "profit": 9,
                "profit_ratio": 0.1,
                "discount": 10,
                "discount_rate": "0.1",
                "quantity": 1,
            }
            row.update(given)
            ts, status = row["order_ts"], row["delivery_status"]
            row["order_month"] = ts and ts.replace(day=1, hour=0, minute=0)
            row["order_year"] = ts and ts.year
            row["delay_days"] = row["days_real"] - row["days_scheduled"]
            row["is_late"] = None if status is None else status == LATE
            row["is_on_time"] = None if status is None else status in (ON_TIME, EARLY)
            row["is_canceled"] = None if status is None else status == CANCELED
            for name in ("sales", "order_total", "profit", "discount", "discount_rate"):
                row[name] = None if row[name] is None else Decimal(str(row[name]))
            full.append(tuple(row[c] for c in FACT_COLUMNS))
        return spark.createDataFrame(full, FACT_SCHEMA)

    return build


@pytest.fixture(scope="session")
def house(spark, folder):
    from orderlens.checks.registry import warehouse_with_marts

    return warehouse_with_marts(spark, folder)

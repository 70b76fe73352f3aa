"""Hand-made inputs."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.operators.retention import latest_n_per_group

ORDERS = (
    "order_key bigint, customer_key bigint, status_code string, total_price decimal(15,2), "
    "order_date date"
)
LINES = (
    "order_key bigint, part_key bigint, supplier_key bigint, line_number int, "
    "extended_price decimal(15,2), discount decimal(15,2), ship_date date, commit_date date, "
    "receipt_date date, return_flag string, line_status string"
)
CUSTOMERS = "customer_key bigint, market_segment string"


def day(text: str | None) -> dt.date | None:
    return None if text is None else dt.date.fromisoformat(text)


def orders(spark, *rows):
    """Rows of (order, customer, day)."""
    return spark.createDataFrame([(o, c, "O", Decimal(1), day(d)) for o, c, d in rows], ORDERS)


def lines(spark, *rows):
    """Rows of (order, line, commit, ship, receipt[, price, discount])."""
    full = []
    for o, n, c, s, r, *money in rows:
        price, rate = money or ("100.00", "0.10")
        full.append(
            (o, 5, 6, n, Decimal(price), Decimal(rate), day(s), day(c), day(r), "N", "O")
        )
    return spark.createDataFrame(full, LINES)


def customers(spark, *rows):
    return spark.createDataFrame(list(rows), CUSTOMERS)


def keyed(line_items: DataFrame) -> DataFrame:
    """One row per order line, where the test data repeats a line number."""
    order = ["ship_date", "part_key", "supplier_key", "extended_price", "discount"]
    return latest_n_per_group(
        line_items, ["order_key", "line_number"], [F.asc(c) for c in order], keep=1
    )

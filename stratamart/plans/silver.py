"""Order-level totals and shipment lines with normalized dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.functions import greatest_strict, least_strict, median_of_three

# Fixed value: days after shipping at which a receipt counts as late by default.
RECEIPT_GRACE_DAYS = 7


def int_orders_enriched(orders: DataFrame, line_items: DataFrame) -> DataFrame:
    """Raw price and discount-rate totals per order that has lines.

    Lines are totalled per order before the join, inside the map tasks first,
    so the join sees one row per order however many lines a single one has.
    The second totalling only matters where an order is listed twice (its key is
    checked to be unique before this layer), and keeps the join's partitioning.
    """
    totals = line_items.groupBy("order_key").agg(
        F.sum("extended_price").alias("gross"), F.sum("discount").alias("rates")
    )
    joined = orders.select("order_key", "customer_key", "order_date").join(totals, "order_key")
    return joined.groupBy(
        F.col("order_key").alias("order_id"),
        F.col("order_date").cast("date").alias("order_date"),
        F.col("customer_key").alias("customer_id"),
    ).agg(
        F.sum("gross").cast("decimal(25,2)").alias("gross_item_sales_amount"),
        F.sum("rates").cast("decimal(25,2)").alias("total_discount"),
    )


def least_greatest_dates(lines: DataFrame) -> DataFrame:
    """Put the three raw dates in order: earliest, middle, latest."""
    raw = F.col("commit_date_raw"), F.col("ship_date_raw"), F.col("receipt_date_raw")
    return lines.withColumns(
        {
            "commit_date": least_strict(*raw),
            "ship_date": median_of_three(*raw),
            "receipt_date": greatest_strict(*raw),
        }
    )


def with_lags(lines: DataFrame) -> DataFrame:
    """Days between the ordered dates and the two default lateness flags."""
    ship, commit, receipt = F.col("ship_date"), F.col("commit_date"), F.col("receipt_date")
    return lines.withColumns(
        {
            "ship_minus_commit_days": F.datediff(ship, commit),
            "receipt_minus_ship_days": F.datediff(receipt, ship),
            "is_ship_late": ship > commit,
            "is_receipt_late_default": receipt > F.date_add(ship, RECEIPT_GRACE_DAYS),
        }
    )


def int_shipment_events(
    orders: DataFrame, line_items: DataFrame, customers: DataFrame
) -> DataFrame:
    """One row per order line with its dates in order.

    The customer's segment is looked up per order, not per line: the lines are
    shuffled once, on the order key, and the lookup moves three columns of the
    much shorter orders table.
    """
    segments = customers.select("customer_key", "market_segment")
    orders = orders.select(
        "order_key", "customer_key", F.col("order_date").cast("date").alias("order_date")
    ).join(segments, "customer_key", "left")
    lines = line_items.select(
        "order_key",
        "line_number",
        "part_key",
        "supplier_key",
        F.col("commit_date").cast("date").alias("commit_date_raw"),
        F.col("ship_date").cast("date").alias("ship_date_raw"),
        F.col("receipt_date").cast("date").alias("receipt_date_raw"),
    )
    joined = lines.join(orders, "order_key")
    return with_lags(least_greatest_dates(joined)).select(
        "order_key",
        "line_number",
        "part_key",
        "supplier_key",
        "customer_key",
        "market_segment",
        "order_date",
        "commit_date",
        "ship_date",
        "receipt_date",
        "commit_date_raw",
        "ship_date_raw",
        "receipt_date_raw",
        "ship_minus_commit_days",
        "receipt_minus_ship_days",
        "is_ship_late",
        "is_receipt_late_default",
    )

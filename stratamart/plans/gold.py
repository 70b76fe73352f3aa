"""Star schema: dimensions, policies, facts and the daily metric."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions import discount_amount, discounted_amount, joined_key, surrogate_key
from stratamart.operators.merge import EPOCH, cutoff_value, since
from stratamart.operators.small_join import small_left_join
from stratamart.operators.spine import date_bounds, date_spine
from stratamart.operators.storage import FactLayout
from stratamart.operators.unpivot import unpivot_shipments

# Staged orders, in months as well: an increment opens only the recent ones.
ORDERS_LAYOUT = FactLayout(
    key="order_key", day="order_date", month="order_month", line=("order_key",)
)
ORDER_ITEM_LAYOUT = FactLayout(key="order_item_key", day="order_date", month="order_month")
SHIPMENT_LAYOUT = FactLayout(key="shipment_event_key", day="event_date", month="event_month")

# Days to fulfil by market segment, and for any other segment.
SEGMENT_DAYS = {
    "AUTOMOBILE": 5,
    "BUILDING": 7,
    "FURNITURE": 10,
    "HOUSEHOLD": 7,
    "MACHINERY": 14,
}
OTHER_SEGMENT_DAYS = 7

# Event type, position, allowed days since the event before it.
STATUS_POLICY = [("COMMIT", 1, None), ("SHIP", 2, 3), ("RECEIPT", 3, 7)]


# Dimensions


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        surrogate_key("customer_key").alias("customer_sk"),
        "customer_key",
        "customer_name",
        "market_segment",
        "nation_key",
        "account_balance",
        "phone",
        "address",
    )


def dim_part(parts: DataFrame) -> DataFrame:
    return parts.select(
        surrogate_key("part_key").alias("part_sk"),
        "part_key",
        "part_name",
        "manufacturer",
        "brand",
        "part_type",
        "part_size",
        "container",
        "retail_price",
    )


def dim_supplier(suppliers: DataFrame) -> DataFrame:
    return suppliers.select(
        surrogate_key("supplier_key").alias("supplier_sk"),
        "supplier_key",
        "supplier_name",
        "nation_key",
        "account_balance",
        "phone",
        "address",
    )


def dim_date(orders: DataFrame, line_items: DataFrame) -> DataFrame:
    """Days from the first order to the last known line-item date; weeks start on Sunday = 0."""
    day = F.col("date_day")
    return date_spine(date_bounds(orders, line_items)).select(
        "date_day",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        (F.dayofweek(day) - 1).alias("day_of_week"),
        F.trunc(day, "month").alias("month_start"),
    )


def distinct_segments(customers: DataFrame) -> DataFrame:
    return customers.select("market_segment").filter("market_segment is not null").distinct()


def dim_sla_policy(customers: DataFrame, policy_version: str = "v1") -> DataFrame:
    days = F.lit(None)
    for segment, target in SEGMENT_DAYS.items():
        days = F.when(F.col("market_segment") == segment, target).otherwise(days)
    return distinct_segments(customers).select(
        surrogate_key("market_segment").alias("sla_policy_sk"),
        "market_segment",
        F.coalesce(days, F.lit(OTHER_SEGMENT_DAYS)).cast("int").alias("sla_target_days"),
        F.lit(policy_version).alias("policy_version"),
    )


def dim_status_policy(spark: SparkSession, policy_version: str = "v1") -> DataFrame:
    """The three event types; an inline relation, so Spark knows its size."""
    rows = ", ".join(
        f"('{event}', {order}, cast({'null' if days is None else days} as int), :version)"
        for event, order, days in STATUS_POLICY
    )
    return spark.sql(
        "select * from values "
        f"{rows} as t(event_type, event_order, sla_target_days, policy_version)",
        args={"version": policy_version},
    )


def dimension_keys() -> list[Column]:
    """Keys of the customer, part and supplier dimensions, from their natural keys."""
    return [
        surrogate_key(f"{name}_key").alias(f"{name}_sk")
        for name in ("customer", "part", "supplier")
    ]


# Order items and the daily metric


def int_order_items(orders: DataFrame, line_items: DataFrame) -> DataFrame:
    lines = line_items.select(
        "order_key", "line_number", "part_key", "supplier_key", "extended_price", "discount"
    )
    return (
        orders.select("order_key", "customer_key", "order_date")
        .join(lines, "order_key")
        .select(
            joined_key("order_key", "line_number").alias("order_item_key"),
            "part_key",
            "supplier_key",
            "line_number",
            "extended_price",
            "discount",
            "order_key",
            "customer_key",
            "order_date",
            discounted_amount("extended_price", "discount").alias("discounted_amount"),
        )
    )


def order_item_rows(order_items: DataFrame) -> DataFrame:
    """What the order-item fact is made from, without the columns it derives."""
    return order_items.select(
        "order_key",
        "line_number",
        F.col("order_date").cast("date").alias("order_date"),
        "customer_key",
        "part_key",
        "supplier_key",
        "extended_price",
        "discount",
    )


def order_item_columns(rows: DataFrame) -> DataFrame:
    """The fact's columns; dimension keys are computed, so no dimension is joined."""
    return rows.select(
        joined_key("order_key", "line_number").alias("order_item_key"),
        "order_key",
        "line_number",
        "order_date",
        "customer_key",
        "part_key",
        "supplier_key",
        *dimension_keys(),
        "extended_price",
        "discount",
        discounted_amount("extended_price", "discount").alias("net_item_sales_amount"),
        discount_amount("extended_price", "discount").alias("item_discount_amount"),
    )


def fct_order_items(order_items: DataFrame) -> DataFrame:
    return order_item_columns(order_item_rows(order_items))


def order_items_increment(
    order_items: DataFrame | Callable[[dt.date | None], DataFrame],
    target: DataFrame,
    *,
    lookback_days: int = 7,
    month: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Fact rows to merge: those not older than the target's last day minus the allowance.

    Older late rows are left out, and an empty target admits none. Instead of
    all order items a function may be given that makes those since a day.
    """
    start = cutoff_value(
        target, "order_date", lookback_days=lookback_days, month=month, path=path
    )
    recent = order_items(start) if callable(order_items) else order_items
    return since(fct_order_items(recent), "order_date", start)


def recent_order_items(
    orders: DataFrame, line_items: DataFrame, start: dt.date | None
) -> DataFrame:
    """Order items of the orders since a day.

    The day selects folders of orders stored by month. The lines have no order
    day; a join that cannot broadcast the recent orders filters the scan of
    lines by a Bloom filter of their keys (``RECENT_KEYS``) before it moves them.
    """
    recent = since(orders, "order_date", start)
    if start is not None and ORDERS_LAYOUT.month in orders.columns:
        recent = recent.filter(F.col(ORDERS_LAYOUT.month) >= F.lit(start.replace(day=1)))
    return int_order_items(recent, line_items)


# Spark's own runtime filter, for lines of any size and up to a gigabyte of recent orders.
RECENT_KEYS = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
}


def int_order_items_summary(fact: DataFrame) -> DataFrame:
    """Per order day: number of items, net amount, discount amount."""
    return fact.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("items_cnt"),
        F.sum("net_item_sales_amount").alias("gross_item_sales_amount"),
        F.sum("item_discount_amount").alias("item_discount_amount"),
    )


def fct_orders(summary: DataFrame) -> DataFrame:
    return summary.select(
        "order_date", "items_cnt", "gross_item_sales_amount", "item_discount_amount"
    )


# Shipment events


LINE = ["order_key", "line_number"]
LINE_COLUMNS = [
    *LINE,
    "part_key",
    "supplier_key",
    "customer_key",
    "market_segment",
]


def shipment_event_rows(
    shipments: DataFrame, sla_policy: DataFrame, *, with_keys: bool = False
) -> DataFrame:
    """Three events per line with the segment's target, which is looked up per line.

    ``with_keys`` also hashes the dimension keys per line, before there are
    three events of it: right for reading, but wider rows for a shuffle.
    """
    segments = sla_policy.select(
        "market_segment", F.col("sla_target_days").alias("segment_sla_target_days")
    )
    keys = dimension_keys() if with_keys else []
    dates = ["commit_date", "ship_date", "receipt_date"]
    lags = ["ship_minus_commit_days", "receipt_minus_ship_days"]
    lines = small_left_join(
        shipments.select(*LINE_COLUMNS, *keys, *dates, *lags), segments, "market_segment"
    )
    carried = [c for c in lines.columns if c not in dates + lags]
    return unpivot_shipments(lines, carried)


def shipment_event_columns(rows: DataFrame, status_policy: DataFrame | None = None) -> DataFrame:
    """The fact's columns: keys, the status policy and the lateness flag."""
    policy = dim_status_policy(rows.sparkSession) if status_policy is None else status_policy
    policy = policy.select(
        "event_type", "event_order", F.col("sla_target_days").alias("status_sla_target_days")
    )
    if status_policy is None:
        events = rows.join(F.broadcast(policy), "event_type", "left")
    else:
        events = small_left_join(rows, policy, "event_type")
    has_keys = "customer_sk" in rows.columns
    lag, allowed = F.col("days_since_prior_event"), F.col("status_sla_target_days")
    return events.select(
        joined_key("order_key", "line_number", "event_type").alias("shipment_event_key"),
        *LINE_COLUMNS,
        *(["customer_sk", "part_sk", "supplier_sk"] if has_keys else dimension_keys()),
        "event_type",
        "event_date",
        "days_since_prior_event",
        "event_order",
        "status_sla_target_days",
        "segment_sla_target_days",
        (lag > allowed).alias("is_late_against_status_policy"),
    )


def fct_shipment_events(
    shipments: DataFrame, sla_policy: DataFrame, status_policy: DataFrame | None = None
) -> DataFrame:
    """Three events per line with the policy targets and the lateness flag."""
    rows = shipment_event_rows(shipments, sla_policy, with_keys=True)
    return shipment_event_columns(rows, status_policy)


def shipment_refresh_keys(
    target: DataFrame,
    *,
    new_from: DataFrame | None = None,
    lookback_days: int = 7,
    month: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Lines of the target with a recent event, or with an impossible lag.

    ``new_from`` adds the lines of a shipment table that the target has never
    seen. Both sides are made distinct inside the map tasks first.
    """
    start = cutoff_value(
        target, "event_date", lookback_days=lookback_days, when_empty=EPOCH, month=month, path=path
    )
    due = (F.col("event_date") >= F.lit(start)) | (F.col("days_since_prior_event") < 0)
    keys = target.filter(due).select(*LINE).distinct()
    if new_from is not None:
        seen = target.select(*LINE).distinct()
        keys = keys.unionByName(new_from.select(*LINE).distinct().join(seen, LINE, "left_anti"))
    return keys


def shipments_to_refresh(shipments: DataFrame, keys: DataFrame) -> DataFrame:
    """Shipment lines to rebuild.

    Hand in stored keys: an aggregate right below the join would keep adaptive
    execution from splitting a line that has very many copies.
    """
    return shipments.join(keys, LINE, "left_semi")

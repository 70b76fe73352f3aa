"""Declared checks of every layer, as data."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stratamart.operators.quality import (
    Check,
    accepted_values,
    at_least,
    check_metrics,
    expression,
    no_rows_where,
    not_null,
    relationship,
    row_count_at_least,
    unique,
    unique_combination,
)

# Accepted codes.
ORDER_STATUSES = ("O", "F", "P")
MARKET_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
EVENT_TYPES = ("COMMIT", "SHIP", "RECEIPT")
DAILY_COLUMNS = ("order_date", "items_cnt", "gross_item_sales_amount", "item_discount_amount")

SOURCE_CHECKS: list[Check] = [
    *unique("orders", "o_orderkey"),
    *not_null("orders", "o_orderkey", "o_custkey"),
    *relationship("orders", "o_custkey", "customer", "c_custkey"),
    *not_null("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
    *relationship("lineitem", "l_orderkey", "orders", "o_orderkey"),
    *relationship("lineitem", "l_partkey", "part", "p_partkey"),
    *relationship("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    *unique_combination("lineitem", "l_orderkey", "l_linenumber"),
    *unique("customer", "c_custkey"),
    *not_null("customer", "c_custkey", "c_mktsegment"),
    *unique("part", "p_partkey"),
    *not_null("part", "p_partkey", "p_brand"),
    *unique("supplier", "s_suppkey"),
    *not_null("supplier", "s_suppkey"),
]

STAGING_CHECKS: list[Check] = [
    *not_null("stg_tpch_orders", "order_key", "customer_key", "status_code", "order_date"),
    *unique("stg_tpch_orders", "order_key"),
    *relationship("stg_tpch_orders", "customer_key", "stg_tpch_customers", "customer_key"),
    *accepted_values("stg_tpch_orders", "status_code", *ORDER_STATUSES),
    *unique_combination("stg_tpch_line_items", "order_key", "line_number"),
    *not_null("stg_tpch_line_items", "order_key", "part_key", "supplier_key"),
    *not_null("stg_tpch_line_items", "ship_date", "commit_date", "receipt_date"),
    *relationship("stg_tpch_line_items", "order_key", "stg_tpch_orders", "order_key"),
    *relationship("stg_tpch_line_items", "part_key", "stg_tpch_parts", "part_key"),
    *relationship("stg_tpch_line_items", "supplier_key", "stg_tpch_suppliers", "supplier_key"),
    *not_null("stg_tpch_customers", "customer_key", "market_segment"),
    *unique("stg_tpch_customers", "customer_key"),
    *not_null("stg_tpch_parts", "part_key", "brand"),
    *unique("stg_tpch_parts", "part_key"),
    *not_null("stg_tpch_suppliers", "supplier_key"),
    *unique("stg_tpch_suppliers", "supplier_key"),
]

BRONZE_CHECKS = SOURCE_CHECKS + STAGING_CHECKS

SILVER_CHECKS: list[Check] = [
    *not_null("int_orders_enriched", "order_id", "order_date", "customer_id"),
    *unique("int_orders_enriched", "order_id"),
    *unique_combination("int_shipment_events", "order_key", "line_number"),
    *expression("int_shipment_events", "receipt_date >= ship_date", "ship_date >= commit_date"),
    *not_null("int_shipment_events", "order_key", "line_number", "customer_key", "part_key"),
    *not_null("int_shipment_events", "supplier_key", "order_date", "commit_date"),
    *not_null("int_shipment_events", "ship_date", "receipt_date"),
]

GOLD_CHECKS: list[Check] = [
    *unique_combination("int_order_items", "order_key", "line_number"),
    *not_null("int_order_items", "order_item_key", "order_key", "supplier_key"),
    *not_null("int_order_items", "order_date", "discounted_amount"),
    *unique("int_order_items", "order_item_key"),
    *relationship("int_order_items", "order_key", "stg_tpch_orders", "order_key"),
    *relationship("int_order_items", "supplier_key", "stg_tpch_suppliers", "supplier_key"),
    *not_null("int_order_items_summary", *DAILY_COLUMNS),
    *not_null("fct_orders", *DAILY_COLUMNS),
    *not_null("dim_customer", "customer_sk", "customer_key", "market_segment"),
    *unique("dim_customer", "customer_sk", "customer_key"),
    *accepted_values("dim_customer", "market_segment", *MARKET_SEGMENTS),
    *not_null("dim_part", "part_sk", "part_key", "brand"),
    *unique("dim_part", "part_sk", "part_key"),
    *not_null("dim_supplier", "supplier_sk", "supplier_key"),
    *unique("dim_supplier", "supplier_sk", "supplier_key"),
    *not_null("dim_date", "date_day"),
    *unique("dim_date", "date_day"),
    *expression("dim_sla_policy", "sla_target_days > 0"),
    *not_null("dim_sla_policy", "sla_policy_sk", "market_segment", "sla_target_days"),
    *unique("dim_sla_policy", "sla_policy_sk", "market_segment"),
    *not_null("dim_status_policy", "event_type", "event_order"),
    *unique("dim_status_policy", "event_type"),
    *accepted_values("dim_status_policy", "event_type", *EVENT_TYPES),
    *expression("fct_order_items", "net_item_sales_amount >= 0", "item_discount_amount >= 0"),
    *not_null("fct_order_items", "order_item_key", "order_date"),
    *not_null("fct_order_items", "customer_sk", "part_sk", "supplier_sk"),
    *unique("fct_order_items", "order_item_key"),
    *relationship("fct_order_items", "order_date", "dim_date", "date_day"),
    *relationship("fct_order_items", "customer_sk", "dim_customer", "customer_sk"),
    *relationship("fct_order_items", "part_sk", "dim_part", "part_sk"),
    *relationship("fct_order_items", "supplier_sk", "dim_supplier", "supplier_sk"),
    *expression(
        "fct_shipment_events",
        "event_date is not null",
        "days_since_prior_event is null or days_since_prior_event >= 0",
    ),
    *not_null("fct_shipment_events", "shipment_event_key", "event_type", "event_date"),
    *not_null("fct_shipment_events", "customer_sk", "part_sk", "supplier_sk"),
    *unique("fct_shipment_events", "shipment_event_key"),
    *accepted_values("fct_shipment_events", "event_type", *EVENT_TYPES),
    *relationship("fct_shipment_events", "event_date", "dim_date", "date_day"),
    *relationship("fct_shipment_events", "customer_sk", "dim_customer", "customer_sk"),
    *relationship("fct_shipment_events", "part_sk", "dim_part", "part_sk"),
    *relationship("fct_shipment_events", "supplier_sk", "dim_supplier", "supplier_sk"),
]

ORDERS_DATE_VALID = no_rows_where(
    "fct_orders",
    "order_date from 1990 to today",
    "to_date(order_date) > :as_of or to_date(order_date) < date'1990-01-01'",
)
ORDERS_DISCOUNT = no_rows_where(
    "fct_orders",
    "no negative amount",
    "item_discount_amount < 0 or gross_item_sales_amount < 0",
)
SINGULAR_CHECKS: list[Check] = [*ORDERS_DATE_VALID, *ORDERS_DISCOUNT]

LAYER_CHECKS = {
    "bronze": BRONZE_CHECKS,
    "silver": SILVER_CHECKS,
    "gold": GOLD_CHECKS + SINGULAR_CHECKS,
}
DATA_TESTS = BRONZE_CHECKS + SILVER_CHECKS + GOLD_CHECKS

DAILY_METRICS: list[Check] = [
    *row_count_at_least("fct_orders", 1),
    *not_null("fct_orders", *DAILY_COLUMNS),
    *at_least("fct_orders", 0, *DAILY_COLUMNS[1:]),
]


def of_kind(kind: str, checks: list[Check] = DATA_TESTS) -> list[Check]:
    return [c for c in checks if c.kind == kind]


def run_suite(daily: DataFrame, suite: str = "daily_metrics") -> DataFrame:
    """The daily-metric expectations, all in one aggregate over the batch."""
    return check_metrics({"fct_orders": daily}, DAILY_METRICS, suite)

"""Declared columns and types of every built table, and access to built tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratamart.plans.gold import fct_orders
from stratamart.plans.snapshots import SNAPSHOTS

# The tables by layer.
LAYERS: dict[str, dict[str, str]] = {
    "bronze": {
        "stg_tpch_orders": "order_key bigint, customer_key bigint, status_code string, "
        "total_price decimal(15,2), order_date date",
        "stg_tpch_line_items": "order_key bigint, part_key bigint, supplier_key bigint, "
        "line_number int, extended_price decimal(15,2), discount decimal(15,2), ship_date date, "
        "commit_date date, receipt_date date, return_flag string, line_status string",
        "stg_tpch_customers": "customer_key bigint, customer_name string, market_segment string, "
        "nation_key int, account_balance decimal(15,2), phone string, address string, "
        "comment string",
        "stg_tpch_parts": "part_key bigint, part_name string, manufacturer string, brand string, "
        "part_type string, part_size int, container string, retail_price decimal(15,2), "
        "comment string",
        "stg_tpch_suppliers": "supplier_key bigint, supplier_name string, nation_key int, "
        "account_balance decimal(15,2), phone string, address string, comment string",
    },
    "silver": {
        "int_orders_enriched": "order_id bigint, order_date date, customer_id bigint, "
        "gross_item_sales_amount decimal(25,2), total_discount decimal(25,2)",
        "int_shipment_events": "order_key bigint, line_number int, part_key bigint, "
        "supplier_key bigint, customer_key bigint, market_segment string, order_date date, "
        "commit_date date, ship_date date, receipt_date date, commit_date_raw date, "
        "ship_date_raw date, receipt_date_raw date, ship_minus_commit_days int, "
        "receipt_minus_ship_days int, is_ship_late boolean, is_receipt_late_default boolean",
    },
    "gold": {
        "int_order_items": "order_item_key string, part_key bigint, supplier_key bigint, "
        "line_number int, extended_price decimal(15,2), discount decimal(15,2), "
        "order_key bigint, customer_key bigint, order_date date, discounted_amount decimal(18,4)",
        "int_order_items_summary": "order_date date, items_cnt bigint, "
        "gross_item_sales_amount decimal(28,4), item_discount_amount decimal(28,4)",
        "dim_customer": "customer_sk string, customer_key bigint, customer_name string, "
        "market_segment string, nation_key int, account_balance decimal(15,2), phone string, "
        "address string",
        "dim_part": "part_sk string, part_key bigint, part_name string, manufacturer string, "
        "brand string, part_type string, part_size int, container string, "
        "retail_price decimal(15,2)",
        "dim_supplier": "supplier_sk string, supplier_key bigint, supplier_name string, "
        "nation_key int, account_balance decimal(15,2), phone string, address string",
        "dim_date": "date_day date, year int, month int, day int, day_of_week int, "
        "month_start date",
        "dim_sla_policy": "sla_policy_sk string, market_segment string, sla_target_days int, "
        "policy_version string",
        "dim_status_policy": "event_type string, event_order int, sla_target_days int, "
        "policy_version string",
        "fct_order_items": "order_item_key string, order_key bigint, line_number int, "
        "order_date date, customer_key bigint, part_key bigint, supplier_key bigint, "
        "customer_sk string, part_sk string, supplier_sk string, extended_price decimal(15,2), "
        "discount decimal(15,2), net_item_sales_amount decimal(18,4), "
        "item_discount_amount decimal(18,4)",
        "fct_shipment_events": "shipment_event_key string, order_key bigint, line_number int, "
        "part_key bigint, supplier_key bigint, customer_key bigint, market_segment string, "
        "customer_sk string, part_sk string, supplier_sk string, event_type string, "
        "event_date date, days_since_prior_event int, event_order int, "
        "status_sla_target_days int, segment_sla_target_days int, "
        "is_late_against_status_policy boolean",
    },
}
DECLARED = {name: ddl for tables in LAYERS.values() for name, ddl in tables.items()}


class SchemaMismatch(TypeError):
    """A table to be written does not have its declared columns."""


def as_declared(name: str, df: DataFrame) -> DataFrame:
    """The table itself, after comparing its columns and types with the declaration."""
    declared = [
        (field.name, field.dataType.simpleString())
        for field in T.StructType.fromDDL(DECLARED[name]).fields
    ]
    if declared != df.dtypes:
        differing = sorted(set(declared) ^ set(df.dtypes)) or ["order of columns"]
        raise SchemaMismatch(f"{name}: {differing}")
    return df


def register_views(spark: SparkSession, out_dir: str) -> list[str]:
    """Make every built table and history available to SQL under its own name.

    The facts keep their month column, so SQL can restrict the folders read.
    """
    tables = {
        name: spark.read.parquet(f"{out_dir}/{layer}/{name}")
        for layer, declared in LAYERS.items()
        for name in declared
    }
    tables["fct_orders"] = fct_orders(tables["int_order_items_summary"])
    for snapshot in SNAPSHOTS.values():
        stored = spark.read.parquet(f"{out_dir}/snapshots/{snapshot.name}")
        tables[snapshot.name] = stored.drop("closed_on")
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)

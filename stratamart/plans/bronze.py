"""Staging: source columns under their business names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Staged name of every source column.
ORDERS = {
    "o_orderkey": "order_key",
    "o_custkey": "customer_key",
    "o_orderstatus": "status_code",
    "o_totalprice": "total_price",
    "o_orderdate": "order_date",
}
CUSTOMERS = {
    "c_custkey": "customer_key",
    "c_name": "customer_name",
    "c_mktsegment": "market_segment",
    "c_nationkey": "nation_key",
    "c_acctbal": "account_balance",
    "c_phone": "phone",
    "c_address": "address",
    "c_comment": "comment",
}
LINE_ITEMS = {
    "l_orderkey": "order_key",
    "l_partkey": "part_key",
    "l_suppkey": "supplier_key",
    "l_linenumber": "line_number",
    "l_extendedprice": "extended_price",
    "l_discount": "discount",
    "l_shipdate": "ship_date",
    "l_commitdate": "commit_date",
    "l_receiptdate": "receipt_date",
    "l_returnflag": "return_flag",
    "l_linestatus": "line_status",
}
PARTS = {
    "p_partkey": "part_key",
    "p_name": "part_name",
    "p_mfgr": "manufacturer",
    "p_brand": "brand",
    "p_type": "part_type",
    "p_size": "part_size",
    "p_container": "container",
    "p_retailprice": "retail_price",
    "p_comment": "comment",
}
SUPPLIERS = {
    "s_suppkey": "supplier_key",
    "s_name": "supplier_name",
    "s_nationkey": "nation_key",
    "s_acctbal": "account_balance",
    "s_phone": "phone",
    "s_address": "address",
    "s_comment": "comment",
}

STAGED = {
    "stg_tpch_orders": ("orders", ORDERS),
    "stg_tpch_line_items": ("lineitem", LINE_ITEMS),
    "stg_tpch_customers": ("customer", CUSTOMERS),
    "stg_tpch_parts": ("part", PARTS),
    "stg_tpch_suppliers": ("supplier", SUPPLIERS),
}


def staged(source: DataFrame, names: dict[str, str]) -> DataFrame:
    return source.select(*[F.col(old).alias(new) for old, new in names.items()])


def stage_all(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The five staging tables."""
    return {name: staged(sources[src], names) for name, (src, names) in STAGED.items()}

"""The models as SQL relations, written independently of the Spark code.

``select`` puts the relations a statement mentions, directly or through other
relations, in front of it as common table expressions.
"""

from __future__ import annotations

import re

RELATIONS: dict[str, str] = {
    "src_orders": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice,
               CAST(o_orderdate AS DATE) AS o_orderdate
        FROM orders""",
    "src_lineitem": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               CAST(l_extendedprice AS DECIMAL(15,2)) AS l_extendedprice,
               CAST(l_discount AS DECIMAL(15,2)) AS l_discount,
               CAST(l_shipdate AS DATE) AS l_shipdate,
               CAST(l_shipdate AS DATE)
                 + CAST((l_orderkey * 7 + l_linenumber * 3) % 61 - 30 AS INTEGER) AS l_commitdate,
               CAST(l_shipdate AS DATE)
                 + CAST((l_orderkey * 11 + l_linenumber * 5) % 30 - 5 AS INTEGER) AS l_receiptdate,
               l_returnflag, l_linestatus
        FROM lineitem""",
    "src_customer": """
        SELECT c_custkey, c_name, c_mktsegment, c_nationkey,
               CAST(c_acctbal AS DECIMAL(15,2)) AS c_acctbal,
               CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey % 9000 + 1000 AS VARCHAR)
                 AS c_phone,
               'Addr ' || CAST(c_custkey AS VARCHAR) AS c_address,
               CAST(NULL AS VARCHAR) AS c_comment
        FROM customer""",
    "src_part": """
        SELECT p_partkey, p_name,
               'Manufacturer#' || CAST(p_partkey % 5 + 1 AS VARCHAR) AS p_mfgr,
               p_brand, p_type, p_size,
               'BOX ' || CAST(p_partkey % 4 AS VARCHAR) AS p_container,
               CAST(p_retailprice AS DECIMAL(15,2)) AS p_retailprice,
               CAST(NULL AS VARCHAR) AS p_comment
        FROM part""",
    "src_supplier": """
        SELECT s_suppkey, s_name, s_nationkey,
               CAST(s_acctbal AS DECIMAL(15,2)) AS s_acctbal,
               CAST(s_nationkey AS VARCHAR) || '-' || CAST(s_suppkey % 9000 + 1000 AS VARCHAR)
                 AS s_phone,
               'Addr ' || CAST(s_suppkey AS VARCHAR) AS s_address,
               CAST(NULL AS VARCHAR) AS s_comment
        FROM supplier""",
    "stg_tpch_orders": """
        SELECT o_orderkey AS order_key, o_custkey AS customer_key,
               o_orderstatus AS status_code, o_totalprice AS total_price,
               o_orderdate AS order_date
        FROM src_orders""",
    "stg_tpch_line_items": """
        SELECT l_orderkey AS order_key, l_partkey AS part_key, l_suppkey AS supplier_key,
               l_linenumber AS line_number, l_extendedprice AS extended_price,
               l_discount AS discount, l_shipdate AS ship_date, l_commitdate AS commit_date,
               l_receiptdate AS receipt_date, l_returnflag AS return_flag,
               l_linestatus AS line_status
        FROM src_lineitem""",
    "stg_tpch_customers": """
        SELECT c_custkey AS customer_key, c_name AS customer_name,
               c_mktsegment AS market_segment, c_nationkey AS nation_key,
               c_acctbal AS account_balance, c_phone AS phone, c_address AS address,
               c_comment AS comment
        FROM src_customer""",
    "stg_tpch_parts": """
        SELECT p_partkey AS part_key, p_name AS part_name, p_mfgr AS manufacturer,
               p_brand AS brand, p_type AS part_type, p_size AS part_size,
               p_container AS container, p_retailprice AS retail_price, p_comment AS comment
        FROM src_part""",
    "stg_tpch_suppliers": """
        SELECT s_suppkey AS supplier_key, s_name AS supplier_name, s_nationkey AS nation_key,
               s_acctbal AS account_balance, s_phone AS phone, s_address AS address,
               s_comment AS comment
        FROM src_supplier""",
    # Lines whose number includes the ship day, where the test data repeats a line number.
    "dated_line_items": """
        SELECT * REPLACE (CAST(line_number + 10 * date_diff('day', DATE '1970-01-01', ship_date)
                               AS INTEGER) AS line_number)
        FROM stg_tpch_line_items""",
    "int_orders_enriched": """
        SELECT o.order_key AS order_id, o.order_date, o.customer_key AS customer_id,
               sum(l.extended_price) AS gross_item_sales_amount,
               sum(l.discount) AS total_discount
        FROM stg_tpch_orders o JOIN stg_tpch_line_items l ON l.order_key = o.order_key
        GROUP BY 1, 2, 3""",
    "dim_customer": """
        SELECT md5(coalesce(CAST(customer_key AS VARCHAR), '_null_')) AS customer_sk,
               customer_key, customer_name, market_segment, nation_key, account_balance,
               phone, address
        FROM stg_tpch_customers""",
    "dim_part": """
        SELECT md5(coalesce(CAST(part_key AS VARCHAR), '_null_')) AS part_sk,
               part_key, part_name, manufacturer, brand, part_type, part_size, container,
               retail_price
        FROM stg_tpch_parts""",
    "dim_supplier": """
        SELECT md5(coalesce(CAST(supplier_key AS VARCHAR), '_null_')) AS supplier_sk,
               supplier_key, supplier_name, nation_key, account_balance, phone, address
        FROM stg_tpch_suppliers""",
    "date_bounds": """
        SELECT (SELECT min(order_date) FROM stg_tpch_orders) AS start_date,
               (SELECT max(coalesce(receipt_date, ship_date, commit_date))
                FROM stg_tpch_line_items) AS end_date""",
    "date_spine": """
        SELECT CAST(unnest(generate_series(CAST(start_date AS TIMESTAMP),
                                           CAST(end_date AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
               AS date_day
        FROM date_bounds""",
    "dim_date": """
        SELECT date_day,
               CAST(year(date_day) AS INTEGER) AS year,
               CAST(month(date_day) AS INTEGER) AS month,
               CAST(day(date_day) AS INTEGER) AS day,
               CAST(dayofweek(date_day) AS INTEGER) AS day_of_week,
               CAST(date_trunc('month', date_day) AS DATE) AS month_start
        FROM date_spine""",
    "dim_sla_policy": """
        SELECT md5(market_segment) AS sla_policy_sk, market_segment,
               coalesce(days, 7) AS sla_target_days, 'v1' AS policy_version
        FROM (SELECT market_segment FROM stg_tpch_customers
              WHERE market_segment IS NOT NULL GROUP BY 1)
        LEFT JOIN (VALUES ('AUTOMOBILE', 5), ('BUILDING', 7), ('FURNITURE', 10),
                          ('HOUSEHOLD', 7), ('MACHINERY', 14)) AS t(segment, days)
          ON segment = market_segment""",
    "dim_status_policy": """
        SELECT * FROM (VALUES ('COMMIT', 1, CAST(NULL AS INTEGER), 'v1'),
                              ('SHIP', 2, 3, 'v1'), ('RECEIPT', 3, 7, 'v1'))
               AS t(event_type, event_order, sla_target_days, policy_version)""",
}


def order_items(line_items: str) -> str:
    return f"""
        SELECT CAST(l.order_key AS VARCHAR) || '-' || CAST(l.line_number AS VARCHAR)
                 AS order_item_key,
               l.part_key, l.supplier_key, l.line_number, l.extended_price, l.discount,
               o.order_key, o.customer_key, o.order_date,
               CAST(l.extended_price * (1 - l.discount) AS DECIMAL(18,4)) AS discounted_amount
        FROM stg_tpch_orders o JOIN {line_items} l ON o.order_key = l.order_key"""


def order_item_fact(items: str) -> str:
    return f"""
        SELECT order_item_key, order_key, line_number, order_date, customer_key, part_key,
               supplier_key,
               md5(coalesce(CAST(customer_key AS VARCHAR), '_null_')) AS customer_sk,
               md5(coalesce(CAST(part_key AS VARCHAR), '_null_')) AS part_sk,
               md5(coalesce(CAST(supplier_key AS VARCHAR), '_null_')) AS supplier_sk,
               extended_price, discount, discounted_amount AS net_item_sales_amount,
               CAST(extended_price * discount AS DECIMAL(18,4)) AS item_discount_amount
        FROM {items}"""


def shipment_lines(line_items: str) -> str:
    """Dates by sorting a list; the test data has no unknown dates."""
    return f"""
        SELECT l.order_key, l.line_number, l.part_key, l.supplier_key, o.customer_key,
               k.market_segment, o.order_date,
               l.dates[1] AS commit_date, l.dates[2] AS ship_date, l.dates[3] AS receipt_date,
               l.commit_date AS commit_date_raw, l.ship_date AS ship_date_raw,
               l.receipt_date AS receipt_date_raw,
               CAST(l.dates[2] - l.dates[1] AS INTEGER) AS ship_minus_commit_days,
               CAST(l.dates[3] - l.dates[2] AS INTEGER) AS receipt_minus_ship_days,
               l.dates[2] > l.dates[1] AS is_ship_late,
               l.dates[3] - l.dates[2] > 7 AS is_receipt_late_default
        FROM (SELECT *, list_sort([commit_date, ship_date, receipt_date]) AS dates
              FROM {line_items}) l
        JOIN stg_tpch_orders o ON o.order_key = l.order_key
        LEFT JOIN stg_tpch_customers k ON k.customer_key = o.customer_key"""


def unpivoted(lines: str) -> str:
    columns = [
        ("COMMIT", "commit_date", "CAST(NULL AS INTEGER)"),
        ("SHIP", "ship_date", "ship_minus_commit_days"),
        ("RECEIPT", "receipt_date", "receipt_minus_ship_days"),
    ]
    return " UNION ALL ".join(
        f"""
        SELECT CAST(order_key AS VARCHAR) || '-' || CAST(line_number AS VARCHAR) || '-{name}'
                 AS shipment_event_key,
               order_key, line_number, part_key, supplier_key, customer_key, market_segment,
               order_date, '{name}' AS event_type, {day} AS event_date,
               {lag} AS days_since_prior_event
        FROM {lines}"""
        for name, day, lag in columns
    )


def shipment_fact(events: str) -> str:
    return f"""
        SELECT e.shipment_event_key, e.order_key, e.line_number, e.part_key, e.supplier_key,
               e.customer_key, e.market_segment,
               md5(coalesce(CAST(e.customer_key AS VARCHAR), '_null_')) AS customer_sk,
               md5(coalesce(CAST(e.part_key AS VARCHAR), '_null_')) AS part_sk,
               md5(coalesce(CAST(e.supplier_key AS VARCHAR), '_null_')) AS supplier_sk,
               e.event_type, e.event_date, e.days_since_prior_event, p.event_order,
               p.sla_target_days AS status_sla_target_days,
               s.sla_target_days AS segment_sla_target_days,
               e.days_since_prior_event > p.sla_target_days AS is_late_against_status_policy
        FROM {events} e
        LEFT JOIN dim_status_policy p ON p.event_type = e.event_type
        LEFT JOIN dim_sla_policy s ON s.market_segment = e.market_segment"""


RELATIONS |= {
    "int_order_items": order_items("stg_tpch_line_items"),
    "dated_order_items": order_items("dated_line_items"),
    "fct_order_items": order_item_fact("int_order_items"),
    "dated_fct_order_items": order_item_fact("dated_order_items"),
    "int_order_items_summary": """
        SELECT order_date, count(*) AS items_cnt,
               sum(net_item_sales_amount) AS gross_item_sales_amount,
               sum(item_discount_amount) AS item_discount_amount
        FROM fct_order_items GROUP BY 1""",
    "fct_orders": "SELECT * FROM int_order_items_summary",
    "int_shipment_events": shipment_lines("stg_tpch_line_items"),
    "dated_shipments": shipment_lines("dated_line_items"),
    "shipment_rows": unpivoted("int_shipment_events"),
    "dated_shipment_rows": unpivoted("dated_shipments"),
    "fct_shipment_events": shipment_fact("shipment_rows"),
    "dated_fct_shipment_events": shipment_fact("dated_shipment_rows"),
}


def select(statement: str, extra: dict[str, str] | None = None) -> str:
    """The statement preceded by every relation it depends on."""
    known = RELATIONS | (extra or {})
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_0-9]+\b", text)):
            if word in known and word not in needed:
                visit(known[word])
                needed[word] = None

    visit(statement)
    if not needed:
        return statement
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in needed) + "\n" + statement

"""One SQL statement per named query."""

from __future__ import annotations

from oracle.metrics import metrics
from oracle.relations import select
from stratamart.catalog import KNOWN_TO_FAIL
from stratamart.operators.quality import with_severity
from stratamart.plans import checks

DAILY = """SELECT order_date, items_cnt,
       CAST(gross_item_sales_amount AS DOUBLE) AS gross_item_sales_amount,
       CAST(item_discount_amount AS DOUBLE) AS item_discount_amount FROM {}"""

ORDER_ITEM_FACT = """SELECT order_item_key, order_key, line_number, order_date, customer_key,
       part_key, supplier_key, customer_sk, part_sk, supplier_sk,
       CAST(extended_price AS DOUBLE) AS extended_price, CAST(discount AS DOUBLE) AS discount,
       CAST(net_item_sales_amount AS DOUBLE) AS net_item_sales_amount,
       CAST(item_discount_amount AS DOUBLE) AS item_discount_amount FROM {}"""

SHIPMENT_FACT = """SELECT shipment_event_key, order_key, line_number, part_key, supplier_key,
       customer_key, market_segment, customer_sk, part_sk, supplier_sk, event_type, event_date,
       days_since_prior_event, event_order, status_sla_target_days, segment_sla_target_days,
       {} FROM {}"""

# Order-item merge: the fact as loaded up to a day before discounts were booked.
ORDER_ITEM_MERGE = {
    "loaded": """SELECT * REPLACE (CAST(extended_price AS DECIMAL(18,4)) AS net_item_sales_amount)
        FROM dated_fct_order_items WHERE order_date <= DATE '2001-06-30'""",
    "arriving": """SELECT * FROM dated_fct_order_items
        WHERE order_date >= (SELECT max(order_date) - 7 FROM loaded)""",
}

# Shipment refresh: the fact as loaded before lateness was judged.
SHIPMENT_MERGE = {
    "due_lines": """SELECT DISTINCT order_key, line_number FROM dated_fct_shipment_events
        WHERE event_date >= (SELECT coalesce(max(event_date), DATE '1900-01-01') - 7
                             FROM dated_fct_shipment_events)
           OR days_since_prior_event < 0""",
}

REFRESH_KEYS = """SELECT DISTINCT order_key, line_number FROM fct_shipment_events
    WHERE event_date >= (SELECT coalesce(max(event_date), DATE '1900-01-01') - 7
                         FROM fct_shipment_events)
       OR days_since_prior_event < 0"""

FIRST, SECOND = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-02-01 00:00:00'"


def _versions(columns: str, key: str, start: str, end: str | None, source: str) -> str:
    closed = "CAST(NULL AS TIMESTAMP)" if end is None else end
    return f"""SELECT {columns}, {start} AS valid_from, {closed} AS valid_to,
       md5(CAST({key} AS VARCHAR) || '-' || CAST({start} AS VARCHAR)) AS version_id
FROM {source}"""


CUSTOMER_COLUMNS = "customer_key, customer_name, market_segment, address, phone, nation_key"
CUSTOMER_HISTORY = {
    "customer_versions": "\nUNION ALL\n".join(
        [
            # In debt and still a customer: closed, and opened with the new segment.
            _versions(
                CUSTOMER_COLUMNS,
                "customer_key",
                FIRST,
                SECOND,
                "dim_customer WHERE account_balance < 0",
            ),
            _versions(
                CUSTOMER_COLUMNS.replace(
                    "market_segment", "market_segment || '_X' AS market_segment"
                ),
                "customer_key",
                SECOND,
                None,
                "dim_customer WHERE account_balance < 0",
            ),
            # Unchanged, changed in an unchecked column only, or gone: still open.
            _versions(
                CUSTOMER_COLUMNS,
                "customer_key",
                FIRST,
                None,
                "dim_customer WHERE account_balance >= 0",
            ),
            # Joined.
            _versions(
                CUSTOMER_COLUMNS,
                "customer_key",
                SECOND,
                None,
                "(SELECT * REPLACE (customer_key + 100000000 AS customer_key) FROM dim_customer"
                " WHERE account_balance > 9800)",
            ),
        ]
    )
}

PART_COLUMNS = (
    "part_key, part_name, manufacturer, brand, part_type, part_size, container, "
    "CAST(retail_price AS DOUBLE) AS retail_price"
)
PART_HISTORY = "\nUNION ALL\n".join(
    [
        _versions(
            PART_COLUMNS,
            "part_key",
            FIRST,
            SECOND,
            "dim_part WHERE part_size > 25 OR part_size <= 5",
        ),
        _versions(
            PART_COLUMNS,
            "part_key",
            FIRST,
            None,
            "dim_part WHERE part_size > 5 AND part_size <= 25",
        ),
        _versions(
            PART_COLUMNS,
            "part_key",
            SECOND,
            None,
            "(SELECT * REPLACE (retail_price + 1 AS retail_price) FROM dim_part"
            " WHERE part_size > 25)",
        ),
        _versions(
            PART_COLUMNS,
            "part_key",
            SECOND,
            None,
            "(SELECT * REPLACE (CAST(NULL AS VARCHAR) AS container) FROM dim_part"
            " WHERE part_size <= 5)",
        ),
    ]
)

SLA_COLUMNS = "market_segment, sla_target_days, policy_version"
SLA_HISTORY = "\nUNION ALL\n".join(
    [
        _versions(
            SLA_COLUMNS,
            "market_segment",
            FIRST,
            SECOND,
            "dim_sla_policy WHERE sla_target_days >= 10",
        ),
        _versions(
            SLA_COLUMNS, "market_segment", FIRST, None, "dim_sla_policy WHERE sla_target_days < 10"
        ),
        _versions(
            SLA_COLUMNS.replace("sla_target_days", "sla_target_days + 1 AS sla_target_days"),
            "market_segment",
            SECOND,
            None,
            "dim_sla_policy WHERE sla_target_days >= 10",
        ),
    ]
)

STATUS_COLUMNS = "event_type, event_order, sla_target_days, policy_version"
STATUS_HISTORY = {
    "status_versions": "\nUNION ALL\n".join(
        [
            _versions(
                STATUS_COLUMNS,
                "event_type",
                FIRST,
                SECOND,
                "dim_status_policy WHERE event_type = 'SHIP'",
            ),
            _versions(
                STATUS_COLUMNS,
                "event_type",
                FIRST,
                None,
                "dim_status_policy WHERE event_type <> 'SHIP'",
            ),
            _versions(
                STATUS_COLUMNS.replace("sla_target_days", "5 AS sla_target_days"),
                "event_type",
                SECOND,
                None,
                "dim_status_policy WHERE event_type = 'SHIP'",
            ),
        ]
    )
}


def _checked(kind: str) -> str:
    return select(metrics(checks.of_kind(kind), "data_tests"))


def _expected(kind: str) -> str:
    return select(metrics(checks.of_kind(kind, checks.DAILY_METRICS), "daily_metrics"))


def _build() -> str:
    waived = {check: "warn" for check in KNOWN_TO_FAIL}
    return select(
        "\nUNION ALL\n".join(
            metrics(with_severity(declared, waived), layer, "DATE '2026-01-01'")
            for layer, declared in checks.LAYER_CHECKS.items()
        )
    )


ORACLES: dict[str, str] = {
    "stg_orders": select(
        "SELECT * REPLACE (CAST(total_price AS DOUBLE) AS total_price) FROM stg_tpch_orders"
    ),
    "stg_customers": select(
        "SELECT * REPLACE (CAST(account_balance AS DOUBLE) AS account_balance)"
        " FROM stg_tpch_customers"
    ),
    "stg_line_items": select(
        "SELECT * REPLACE (CAST(extended_price AS DOUBLE) AS extended_price,"
        " CAST(discount AS DOUBLE) AS discount) FROM stg_tpch_line_items"
    ),
    "stg_parts": select(
        "SELECT * REPLACE (CAST(retail_price AS DOUBLE) AS retail_price) FROM stg_tpch_parts"
    ),
    "stg_suppliers": select(
        "SELECT * REPLACE (CAST(account_balance AS DOUBLE) AS account_balance)"
        " FROM stg_tpch_suppliers"
    ),
    "source_freshness": select(
        """SELECT 'orders' AS source, 'o_orderdate' AS loaded_at_field,
                  CAST(max(o_orderdate) AS TIMESTAMP) AS max_loaded_at FROM src_orders
           UNION ALL
           SELECT 'lineitem', 'l_shipdate', CAST(max(l_shipdate) AS TIMESTAMP)
           FROM src_lineitem"""
    ),
    "discounted_amount": select(
        """SELECT order_key, line_number,
                  CAST(CAST(extended_price * (1 - discount) AS DECIMAL(18,4)) AS DOUBLE)
                    AS discounted_amount
           FROM stg_tpch_line_items"""
    ),
    "surrogate_key": select(
        """SELECT order_key, line_number, md5(CAST(part_key AS VARCHAR)) AS part_sk,
                  md5(CAST(order_key AS VARCHAR) || '-' || CAST(line_number AS VARCHAR)) AS line_sk
           FROM stg_tpch_line_items"""
    ),
    "order_item_key": select(
        """SELECT order_key, line_number,
                  CAST(order_key AS VARCHAR) || '-' || CAST(line_number AS VARCHAR)
                    AS order_item_key
           FROM stg_tpch_line_items"""
    ),
    "shipment_event_key": select("SELECT shipment_event_key, event_type FROM shipment_rows"),
    "least_greatest_dates": select(
        """SELECT order_key, line_number, least(commit_date, ship_date, receipt_date)
                    AS commit_date,
                  greatest(commit_date, ship_date, receipt_date) AS receipt_date
           FROM stg_tpch_line_items
           WHERE commit_date IS NOT NULL AND ship_date IS NOT NULL AND receipt_date IS NOT NULL"""
    ),
    "median_date": select(
        """SELECT order_key, line_number, commit_date AS commit_date_raw,
                  ship_date AS ship_date_raw, receipt_date AS receipt_date_raw,
                  list_sort([commit_date, ship_date, receipt_date])[2] AS ship_date
           FROM stg_tpch_line_items"""
    ),
    "ship_lags": select(
        """SELECT order_key, line_number,
                  CAST(d[2] - d[1] AS INTEGER) AS ship_minus_commit_days,
                  CAST(d[3] - d[2] AS INTEGER) AS receipt_minus_ship_days,
                  d[2] > d[1] AS is_ship_late, d[3] > d[2] + 7 AS is_receipt_late_default
           FROM (SELECT order_key, line_number,
                        list_sort([commit_date, ship_date, receipt_date]) AS d
                 FROM stg_tpch_line_items)"""
    ),
    "date_bounds": select("SELECT * FROM date_bounds"),
    "date_spine": select("SELECT * FROM date_spine"),
    "dim_date": select("SELECT * FROM dim_date"),
    "distinct_segments": select("SELECT market_segment FROM dim_sla_policy"),
    "dim_sla_policy": select("SELECT * FROM dim_sla_policy"),
    "dim_status_policy": select(
        """SELECT p.event_type, p.event_order, p.sla_target_days, p.policy_version,
                  count(*) AS n_events,
                  count(*) FILTER (WHERE f.is_late_against_status_policy) AS n_late
           FROM fct_shipment_events f JOIN dim_status_policy p ON p.event_type = f.event_type
           GROUP BY 1, 2, 3, 4"""
    ),
    "dim_customer": select(
        "SELECT * REPLACE (CAST(account_balance AS DOUBLE) AS account_balance) FROM dim_customer"
    ),
    "dim_part": select(
        "SELECT * REPLACE (CAST(retail_price AS DOUBLE) AS retail_price) FROM dim_part"
    ),
    "dim_supplier": select(
        "SELECT * REPLACE (CAST(account_balance AS DOUBLE) AS account_balance) FROM dim_supplier"
    ),
    "int_orders_enriched": select(
        """SELECT order_id, order_date, customer_id,
                  CAST(gross_item_sales_amount AS DOUBLE) AS gross_item_sales_amount,
                  CAST(total_discount AS DOUBLE) AS total_discount
           FROM int_orders_enriched"""
    ),
    "int_shipment_events": select("SELECT * FROM int_shipment_events"),
    "int_order_items": select(
        """SELECT * REPLACE (CAST(extended_price AS DOUBLE) AS extended_price,
                  CAST(discount AS DOUBLE) AS discount,
                  CAST(discounted_amount AS DOUBLE) AS discounted_amount)
           FROM int_order_items"""
    ),
    "fct_order_items": select(ORDER_ITEM_FACT.format("fct_order_items")),
    "int_order_items_summary": select(DAILY.format("int_order_items_summary")),
    "fct_orders": select(DAILY.format("fct_orders")),
    "events_unpivot": select(
        """SELECT shipment_event_key, order_key, line_number, order_date, event_type, event_date,
                  days_since_prior_event FROM shipment_rows"""
    ),
    "fct_shipment_events": select("SELECT * FROM fct_shipment_events"),
    "incr_cutoff_order_items": select(
        """SELECT max(order_date) - 7 AS cutoff_date FROM fct_order_items
           WHERE order_date <= DATE '2001-06-30'"""
    ),
    "incr_cutoff_shipments": select(
        """SELECT coalesce(max(event_date), DATE '1900-01-01') - 7 AS cutoff_date
           FROM fct_shipment_events"""
    ),
    "incr_filter_order_items": select(
        ORDER_ITEM_FACT.format("fct_order_items")
        + """ WHERE order_date >= (SELECT max(order_date) - 7 FROM fct_order_items
                                   WHERE order_date <= DATE '2001-06-30')"""
    ),
    "incr_refresh_keys": select(REFRESH_KEYS),
    "incr_semi_join": select(
        """SELECT * FROM int_shipment_events b WHERE EXISTS (
             SELECT 1 FROM refresh_keys r
             WHERE r.order_key = b.order_key AND r.line_number = b.line_number)""",
        {"refresh_keys": REFRESH_KEYS},
    ),
    "merge_order_items": select(
        ORDER_ITEM_FACT.format("arriving")
        + " UNION ALL "
        + ORDER_ITEM_FACT.format("loaded")
        + """ WHERE NOT EXISTS (
             SELECT 1 FROM arriving a
             WHERE (a.order_key, a.line_number, a.part_key, a.supplier_key)
                 = (loaded.order_key, loaded.line_number, loaded.part_key, loaded.supplier_key))""",
        ORDER_ITEM_MERGE,
    ),
    "merge_shipment_events": select(
        SHIPMENT_FACT.format(
            "CASE WHEN d.order_key IS NOT NULL THEN is_late_against_status_policy END"
            " AS is_late_against_status_policy",
            "dated_fct_shipment_events LEFT JOIN due_lines d USING (order_key, line_number)",
        ),
        SHIPMENT_MERGE,
    ),
    "backfill_window": select(
        ORDER_ITEM_FACT.format("fct_order_items")
        + " WHERE order_date >= DATE '2000-01-01' AND order_date < DATE '2000-04-01'"
    ),
    "table_rebuild": select(
        """SELECT order_id, order_date, customer_id,
                  CAST(gross_item_sales_amount AS DOUBLE) AS gross_item_sales_amount,
                  CAST(total_discount AS DOUBLE) AS total_discount
           FROM int_orders_enriched"""
    ),
    "clustered_write": select(
        "SELECT *, CAST(date_trunc('month', order_date) AS DATE) AS order_month FROM ("
        + ORDER_ITEM_FACT.format("fct_order_items")
        + ")"
    ),
    "export_daily_metrics": select(
        """SELECT CAST(order_date AS VARCHAR) AS order_date,
                  CAST(items_cnt AS VARCHAR) AS items_cnt,
                  CAST(gross_item_sales_amount AS VARCHAR) AS gross_item_sales_amount,
                  CAST(item_discount_amount AS VARCHAR) AS item_discount_amount
           FROM fct_orders"""
    ),
    "export_roundtrip": select(DAILY.format("fct_orders")),
    "snap_customer": select("SELECT * FROM customer_versions", CUSTOMER_HISTORY),
    "snap_part": select(PART_HISTORY),
    "snap_sla_policy": select(SLA_HISTORY),
    "snap_status_policy": select(
        """SELECT v.*, count(*) AS n_events,
                  count(*) FILTER (WHERE f.days_since_prior_event > v.sla_target_days) AS n_late
           FROM fct_shipment_events f JOIN status_versions v ON v.event_type = f.event_type
           GROUP BY ALL""",
        STATUS_HISTORY,
    ),
    "snap_as_of": select(
        """SELECT * FROM customer_versions
           WHERE valid_from <= TIMESTAMP '2024-01-15 00:00:00'
             AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-01-15 00:00:00')""",
        CUSTOMER_HISTORY,
    ),
    "check_not_null": _checked("not_null"),
    "check_unique": _checked("unique"),
    "check_unique_combination": _checked("unique_combination"),
    "check_accepted_values": _checked("accepted_values"),
    "check_relationships": _checked("relationships"),
    "check_expression": _checked("expression_is_true"),
    "check_orders_date_valid": select(
        DAILY.format("fct_orders")
        + " WHERE order_date > DATE '2001-06-30' OR order_date < DATE '1990-01-01'"
    ),
    "check_orders_discount": select(metrics(checks.ORDERS_DISCOUNT, "data_tests")),
    "expect_row_count": _expected("row_count_at_least"),
    "expect_not_null": _expected("not_null"),
    "expect_between": _expected("at_least"),
    "run_suite": select(metrics(checks.DAILY_METRICS, "daily_metrics")),
    "validation_results": select(
        "SELECT *, '20240101-000000' AS run_id, TIMESTAMP '2024-01-01 00:00:00' AS run_ts FROM ("
        + metrics(checks.DAILY_METRICS, "daily_metrics")
        + ")"
    ),
    "latest_n_per_group": """
        SELECT event_type, ts, event_id, user_id, value FROM (
          SELECT *, row_number() OVER (PARTITION BY event_type
                                       ORDER BY ts DESC, event_id DESC) AS age
          FROM events) WHERE age <= 5""",
    "build_layers": _build(),
}

from decimal import Decimal

from pyspark.sql import functions as F

import builders as b
from plans_util import plan
from stratamart.operators.small_join import small_left_join
from stratamart.plans import gold, silver


def shipments(spark):
    return silver.int_shipment_events(
        b.orders(spark, (1, 10, "2024-01-01"), (2, 11, "2024-01-02"), (3, 12, "2024-01-03")),
        b.lines(
            spark,
            (1, 1, "2024-01-10", "2024-01-13", "2024-01-20"),
            (1, 2, "2024-01-10", "2024-01-14", "2024-01-22"),
            (2, 1, "2024-01-10", None, "2024-01-20"),
            (9, 1, "2024-01-10", "2024-01-11", "2024-01-12"),
        ),
        b.customers(spark, (10, "BUILDING"), (12, "OTHER"), (13, None)),
    )


def test_shipments_keep_lines_with_orders_and_miss_unknown_customers(spark):
    rows = {(r.order_key, r.line_number): r for r in shipments(spark).collect()}
    assert set(rows) == {(1, 1), (1, 2), (2, 1)}
    assert rows[1, 1].market_segment == "BUILDING" and rows[2, 1].market_segment is None
    unknown = rows[2, 1]
    assert (unknown.commit_date, unknown.receipt_date) == (None, None)
    assert unknown.ship_date == b.day("2024-01-20")
    assert unknown.ship_date_raw is None and unknown.is_ship_late is None


def test_lines_meet_orders_in_one_join(spark, small):
    from stratamart.catalog import shipments as over, staging

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(over(staging(spark, small)), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Lines are exchanged once, on the order key; customers meet the orders.
    assert text.count("Exchange hashpartitioning(order_key") == 2
    assert text.count("Exchange hashpartitioning(customer_key") == 2
    assert "l_extendedprice" not in text


def test_lateness_is_strict_and_unknown_for_commit(spark):
    policy = gold.dim_sla_policy(b.customers(spark, (10, "BUILDING"), (12, "OTHER"), (13, None)))
    events = gold.fct_shipment_events(shipments(spark), policy)
    rows = {r.shipment_event_key: r for r in events.collect()}
    assert len(rows) == 9
    late = lambda k: rows[k].is_late_against_status_policy
    assert late("1-1-COMMIT") is None
    # Three and seven days are in time, four and eight are late.
    assert (late("1-1-SHIP"), late("1-1-RECEIPT")) == (False, False)
    assert (late("1-2-SHIP"), late("1-2-RECEIPT")) == (True, True)
    assert late("2-1-SHIP") is None
    assert rows["1-1-SHIP"].segment_sla_target_days == 7
    assert rows["2-1-SHIP"].segment_sla_target_days is None
    assert [rows[f"1-1-{e}"].event_order for e in ("COMMIT", "SHIP", "RECEIPT")] == [1, 2, 3]


def test_default_receipt_flag_equals_the_policy_flag(spark, small):
    from stratamart.catalog import shipment_events, shipments as over, staging

    t = staging(spark, small)
    by_default = over(t).agg(F.count_if("is_receipt_late_default")).first()[0]
    by_policy = (
        shipment_events(t)
        .filter("event_type = 'RECEIPT'")
        .agg(F.count_if("is_late_against_status_policy"))
        .first()[0]
    )
    assert by_default == by_policy > 0


def test_sla_policy_covers_other_segments_but_not_null(spark):
    rows = gold.dim_sla_policy(
        b.customers(spark, (1, "AUTOMOBILE"), (2, "AUTOMOBILE"), (3, "PETS"), (4, None)), "v9"
    ).collect()
    assert sorted((r.market_segment, r.sla_target_days, r.policy_version) for r in rows) == [
        ("AUTOMOBILE", 5, "v9"),
        ("PETS", 7, "v9"),
    ]


def test_status_policy_is_an_inline_relation(spark):
    policy = gold.dim_status_policy(spark, "it's v2")
    assert [tuple(r) for r in policy.collect()] == [
        ("COMMIT", 1, None, "it's v2"),
        ("SHIP", 2, 3, "it's v2"),
        ("RECEIPT", 3, 7, "it's v2"),
    ]
    assert "LocalTableScan" in plan(policy, "simple")


def test_order_totals_with_repeated_orders(spark):
    orders = b.orders(spark, (1, 10, "2024-01-01"), (1, 10, "2024-01-01"), (2, 10, "2024-01-01"))
    lines = b.lines(
        spark,
        (1, 1, None, None, None, "10.00", "0.10"),
        (1, 2, None, None, None, "5.50", "0.05"),
        (3, 1, None, None, None, "1.00", "0.01"),
    )
    rows = silver.int_orders_enriched(orders, lines).collect()
    assert [(r.order_id, r.gross_item_sales_amount, r.total_discount) for r in rows] == [
        (1, Decimal("31.00"), Decimal("0.30"))
    ]


def test_daily_metric_sums_net_amounts(spark):
    orders = b.orders(spark, (1, 10, "2024-01-01"), (2, 10, "2024-01-01"))
    lines = b.lines(
        spark,
        (1, 1, None, None, None, "10.00", "0.10"),
        (2, 1, None, None, None, "20.00", "0.00"),
    )
    fact = gold.fct_order_items(gold.int_order_items(orders, lines))
    row = gold.fct_orders(gold.int_order_items_summary(fact)).first()
    assert (row.items_cnt, row.gross_item_sales_amount, row.item_discount_amount) == (
        2,
        Decimal("29.0000"),
        Decimal("1.0000"),
    )


def test_small_join_gives_the_same_rows_beyond_its_bound(spark):
    large = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    small = spark.createDataFrame([("hot", 1), ("7", 2), ("none", 3)], "k string, v int")
    within = small_left_join(large, small, "k")
    beyond = small_left_join(large, small, "k", max_rows=2)
    assert "Broadcast" in plan(within, "simple")
    assert "_salt" in plan(beyond, "simple") and "_salt" not in beyond.columns
    assert sorted(map(tuple, within.collect()), key=str) == sorted(
        map(tuple, beyond.collect()), key=str
    )


def test_unpivot_scans_its_input_once(spark, small):
    from stratamart.catalog import shipment_events, staging

    text = plan(shipment_events(staging(spark, small)), "simple")
    assert text.count("lineitem.parquet") == 1
    assert "Generate explode" in text and "Union" not in text
    # For reading, keys are hashed per line, below the unpivot.
    assert text.index("Generate explode") < text.index("md5(")


def test_full_builds_shuffle_narrow_rows(spark, small):
    from stratamart.catalog import shipments as over, staging
    from stratamart.operators.storage import clustered

    t = staging(spark, small)
    items = gold.int_order_items(t["stg_tpch_orders"], t["stg_tpch_line_items"])
    policy = gold.dim_sla_policy(t["stg_tpch_customers"])
    for rows, layout, derive in (
        (gold.order_item_rows(items), gold.ORDER_ITEM_LAYOUT, gold.order_item_columns),
        (
            gold.shipment_event_rows(over(t), policy),
            gold.SHIPMENT_LAYOUT,
            gold.shipment_event_columns,
        ),
    ):
        text = plan(clustered(rows, layout, derive), "simple")
        exchange = text.index("REBALANCE_PARTITIONS_BY_COL")
        # Hashes and text keys are above the exchange only.
        assert "md5(" in text[:exchange] and "md5(" not in text[exchange:]
        assert "concat(" in text[:exchange] and "concat(" not in text[exchange:]


def test_clustered_and_lazy_facts_are_the_same(spark, small, folder):
    from stratamart.catalog import shipments as over, staging
    from stratamart.operators.storage import write_clustered

    t = staging(spark, small)
    policy = gold.dim_sla_policy(t["stg_tpch_customers"])
    stored = write_clustered(
        gold.shipment_event_rows(over(t), policy),
        folder,
        gold.SHIPMENT_LAYOUT,
        lambda rows: gold.shipment_event_columns(rows, gold.dim_status_policy(spark)),
    ).drop("event_month")
    lazy = gold.fct_shipment_events(over(t), policy)
    assert stored.columns == lazy.columns
    assert stored.exceptAll(lazy).count() == 0 == lazy.exceptAll(stored).count()

"""Known totals of the test tables at two scales."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from builders import keyed
from stratamart.catalog import daily, staging
from stratamart.plans import gold, silver

GOLDEN = {
    "0.001": {
        "daily": (1084, 6000, 301270840.1572, 16093917.1528),
        "enriched": (1473, 317364757.31),
        "keyed_items": (4599, 230052389.881, 12256543.199),
        "shipments": (4599, 4433, 2636),
        "flags": {
            ("COMMIT", None): 4599,
            ("SHIP", False): 1013,
            ("SHIP", True): 3586,
            ("RECEIPT", False): 1963,
            ("RECEIPT", True): 2636,
        },
        "calendar": (dt.date(1995, 1, 1), dt.date(2001, 11, 20), 2516),
        "outside_calendar": (16, 4),
        "refresh_keys": 2,
    },
    "0.01": {
        "daily": (2399, 60000, 3024008727.8907, 159247543.7393),
        "enriched": (14743, 3183256271.63),
        "keyed_items": (45832, 2310633317.6518, 121677026.7282),
        "shipments": (45832, 44302, 26408),
        "flags": {
            ("COMMIT", None): 45832,
            ("SHIP", False): 10171,
            ("SHIP", True): 35661,
            ("RECEIPT", False): 19424,
            ("RECEIPT", True): 26408,
        },
        "calendar": (dt.date(1995, 1, 1), dt.date(2001, 11, 28), 2524),
        "outside_calendar": (169, 4),
        "refresh_keys": 18,
    },
}


@pytest.fixture(params=GOLDEN)
def case(request, spark):
    return staging(spark, f"/root/testdata/sf{request.param}"), GOLDEN[request.param]


def test_daily_metric(case):
    t, golden = case
    row = daily(t).agg(
        F.count("*"),
        F.sum("items_cnt"),
        F.sum("gross_item_sales_amount").cast("double"),
        F.sum("item_discount_amount").cast("double"),
    )
    assert tuple(row.first()) == golden["daily"]


def test_orders(case):
    t, golden = case
    totals = silver.int_orders_enriched(t["stg_tpch_orders"], t["stg_tpch_line_items"])
    row = totals.agg(F.count("*"), F.sum("gross_item_sales_amount").cast("double"))
    assert tuple(row.first()) == golden["enriched"]


def test_keyed_items(case):
    t, golden = case
    items = gold.int_order_items(t["stg_tpch_orders"], keyed(t["stg_tpch_line_items"]))
    row = gold.fct_order_items(items).agg(
        F.count("*"),
        F.sum("net_item_sales_amount").cast("double"),
        F.sum("item_discount_amount").cast("double"),
    )
    assert tuple(row.first()) == golden["keyed_items"]


def test_shipments(case):
    t, golden = case
    shipped = silver.int_shipment_events(
        t["stg_tpch_orders"], keyed(t["stg_tpch_line_items"]), t["stg_tpch_customers"]
    ).cache()
    totals = shipped.agg(
        F.count("*"), F.count_if("is_ship_late"), F.count_if("is_receipt_late_default")
    )
    assert tuple(totals.first()) == golden["shipments"]

    events = gold.fct_shipment_events(shipped, gold.dim_sla_policy(t["stg_tpch_customers"]))
    counts = events.groupBy("event_type", "is_late_against_status_policy").count().collect()
    flags = {(r.event_type, r.is_late_against_status_policy): r["count"] for r in counts}
    assert flags == golden["flags"]
    assert gold.shipment_refresh_keys(events).count() == golden["refresh_keys"]

    calendar = gold.dim_date(t["stg_tpch_orders"], t["stg_tpch_line_items"])
    span = calendar.agg(F.min("date_day"), F.max("date_day"), F.count("*")).first()
    assert tuple(span) == golden["calendar"]
    outside = events.agg(
        F.count_if(F.col("event_date") < F.lit(span[0])),
        F.count_if(F.col("event_date") > F.lit(span[1])),
    )
    assert tuple(outside.first()) == golden["outside_calendar"]
    shipped.unpersist()


def test_policies(case):
    t, _ = case
    customers = t["stg_tpch_customers"]
    assert gold.dim_sla_policy(customers).count() == 5
    assert gold.dim_status_policy(customers.sparkSession).count() == 3

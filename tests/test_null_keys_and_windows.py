"""NULL merge keys, and windows on a first build."""

import datetime as dt

import pytest

from stratamart.catalog import staging
from stratamart.operators.merge import merge_upsert
from stratamart.plans import gold
from stratamart.plans.build import build_order_items


def test_null_keys_are_inserted(spark):
    schema = "k int, v string"
    target = spark.createDataFrame([(1, "old"), (None, "old null")], schema)
    source = spark.createDataFrame([(1, "new"), (None, "a"), (None, "b")], schema)
    found = merge_upsert(target, source, ["k"]).collect()
    assert sorted((r.k or 0, r.v) for r in found) == [
        (0, "a"),
        (0, "b"),
        (0, "old null"),
        (1, "new"),
    ]


def test_a_window_limits_a_first_build(spark, small, folder):
    t = staging(spark, small)
    items = gold.int_order_items(t["stg_tpch_orders"], t["stg_tpch_line_items"])
    window = (dt.date(2000, 1, 1), dt.date(2000, 2, 1))
    fact = build_order_items(spark, f"{folder}/fact", items, window=window)
    days = [r.order_date for r in fact.select("order_date").distinct().collect()]
    assert days and all(window[0] <= day < window[1] for day in days)
    with pytest.raises(ValueError):
        build_order_items(spark, f"{folder}/fact", items, window=window, full_refresh=True)

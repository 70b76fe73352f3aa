"""One key with a third of all rows must not end up in one task."""

import pytest
from pyspark.sql import functions as F

from stratamart.operators import storage
from stratamart.operators.quality import check_metrics, relationship, unique
from stratamart.plans import gold, silver

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.shuffle.partitions": "64",
}


@pytest.fixture
def scaled_down(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


N = 120_000


@pytest.fixture
def tables(spark):
    """A third of the lines belongs to order 0, a third of the orders to customer 0."""
    hot = F.col("id") % 3 == 0
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int"))
    lines = spark.range(0, N, 1, 16).select(
        F.when(hot, 0).otherwise(F.col("id") % 30_000).alias("order_key"),
        (F.col("id") % 900).alias("part_key"),
        (F.col("id") % 90).alias("supplier_key"),
        F.col("id").cast("int").alias("line_number"),
        F.lit(10).cast("decimal(15,2)").alias("extended_price"),
        F.lit(0.1).cast("decimal(15,2)").alias("discount"),
        day.alias("ship_date"),
        day.alias("commit_date"),
        day.alias("receipt_date"),
    )
    orders = spark.range(0, 30_000, 1, 16).select(
        F.col("id").alias("order_key"),
        F.when(hot, 0).otherwise(F.col("id") % 3_000).alias("customer_key"),
        day.alias("order_date"),
    )
    customers = spark.range(3_000).select(
        F.col("id").alias("customer_key"), F.lit("BUILDING").alias("market_segment")
    )
    return orders, lines, customers


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_order_is_split_in_joins(spark, scaled_down, tables):
    orders, lines, customers = tables
    items = gold.int_order_items(orders, lines)
    assert len(items.collect()) == N
    assert "skew=true" in executed(items)
    shipped = silver.int_shipment_events(orders, lines, customers)
    assert len(shipped.collect()) == N
    assert "skew=true" in executed(shipped)


def test_hot_order_is_totalled_before_the_shuffle(spark, scaled_down, tables):
    orders, lines, _ = tables
    totals = silver.int_orders_enriched(orders, lines)
    rows = totals.collect()
    used = lines.select("order_key").distinct().count()
    assert len(rows) == used
    assert max(r.gross_item_sales_amount for r in rows) >= 10 * N // 3
    text = executed(totals)
    join = text.index("SortMergeJoin")
    assert "partial_sum(" in text[join:] and "partial_sum(" in text[:join]


def test_one_day_of_events_is_written_as_several_files(
    spark, scaled_down, tables, folder, monkeypatch
):
    monkeypatch.setattr(storage, "FILE_BYTES", "64k")
    orders, lines, customers = tables
    one_day = F.least("ship_date", F.lit("2024-01-01").cast("date"))
    lines = lines.withColumns(dict.fromkeys(["ship_date", "commit_date", "receipt_date"], one_day))
    stored = storage.write_clustered(
        gold.shipment_event_rows(
            silver.int_shipment_events(orders, lines, customers), gold.dim_sla_policy(customers)
        ),
        folder,
        gold.SHIPMENT_LAYOUT,
        gold.shipment_event_columns,
    )
    counts = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert sum(counts) == 3 * N and len(counts) > 4 and max(counts) < N


def test_hot_key_in_checks(spark, scaled_down, tables):
    """Reference and uniqueness checks see one row per key and task after the shuffle."""
    orders, lines, _ = tables
    declared = [*relationship("l", "order_key", "o", "order_key"), *unique("l", "order_key")]
    metrics = check_metrics({"l": lines, "o": orders}, declared, "s")
    found = {r.check_name: (r.n_rows, r.n_bad) for r in metrics.collect()}
    repeated = lines.groupBy("order_key").count().filter("count > 1").count()
    assert found == {"relationships": (N, 0), "unique": (N, repeated)}
    assert "Join" not in executed(metrics)


def test_hot_line_is_split_when_refreshed(spark, scaled_down, tables, folder):
    """A third of the shipment lines are copies of one line that is due."""
    orders, lines, customers = tables
    shipped = silver.int_shipment_events(orders, lines, customers).withColumn(
        "line_number", F.when(F.col("order_key") == 0, 1).otherwise(F.col("line_number"))
    )
    shipped = storage.rebuild_table(shipped, f"{folder}/shipped")
    keys = gold.shipment_refresh_keys(
        gold.fct_shipment_events(shipped, gold.dim_sla_policy(customers)), lookback_days=100
    )
    due = gold.shipments_to_refresh(shipped, storage.rebuild_table(keys, f"{folder}/keys"))
    assert len(due.collect()) == N
    assert "skew=true" in executed(due)

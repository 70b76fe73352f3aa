"""Named queries over a folder of source tables.

Every query reads the whole tables below the folder it is given. Money is
returned as double so results can be compared across engines; inside the
models it stays decimal.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping
from dataclasses import replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions import discounted_amount, joined_key, surrogate_key
from stratamart.operators.history import Snapshot, as_of, run_snapshot
from stratamart.operators.merge import EPOCH, cutoff, merge_fact
from stratamart.operators.quality import (
    METRIC_COLUMNS,
    SMALL_TASKS,
    Check,
    check_metrics,
    violations,
)
from stratamart.operators.retention import latest_n_per_group
from stratamart.operators.spine import date_bounds, date_spine
from stratamart.operators.storage import (
    ByRow,
    FactLayout,
    drop_scratch,
    passes_over,
    rebuild_table,
    scratch_path,
    settings,
    write_clustered,
)
from stratamart.operators.unpivot import unpivot_shipments
from stratamart.plans import checks, gold, silver, snapshots
from stratamart.plans.bronze import STAGED, stage_all, staged
from stratamart.plans.build import build_layers, sized_session, stored_bytes
from stratamart.plans.export import export_daily_metrics, publish_daily_metrics, store_results
from stratamart.sources import (
    LOADED_AT,
    read_daily_metrics_csv,
    read_source,
    read_sources,
    source_freshness,
)

Query = Callable[[SparkSession, str], DataFrame]

# Scenario days of the incremental queries: state of the target, replayed
# range, day on which the daily metric is judged, times of the two history runs.
LOADED_TO = dt.date(2001, 6, 30)
REPLAY = (dt.date(2000, 1, 1), dt.date(2000, 4, 1))
JUDGED_ON = dt.date(2001, 6, 30)
BUILT_ON = dt.date(2026, 1, 1)
FIRST_RUN = dt.datetime(2024, 1, 1)
SECOND_RUN = dt.datetime(2024, 2, 1)
BETWEEN_RUNS = dt.datetime(2024, 1, 15)


def presented(df: DataFrame) -> DataFrame:
    """Decimals as double."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# Inputs


class Staging(Mapping[str, DataFrame]):
    """The staging tables of a folder; only those asked for are opened."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            source, names = STAGED[name]
            stored = read_source(self._spark, self._folder, source, stand_ins=True)
            self._opened[name] = staged(stored, names)
        return self._opened[name]

    def __iter__(self) -> Iterator[str]:
        return iter(STAGED)

    def __len__(self) -> int:
        return len(STAGED)


def staging(spark: SparkSession, folder: str) -> Staging:
    return Staging(spark, folder)


def unbroadcast(df: DataFrame) -> DataFrame:
    """A whole table that grows with the input: Spark would broadcast it by its size on storage, many times smaller."""
    return df.hint("merge")


def sized(query: Query) -> Query:
    """A query that runs its jobs itself, with session settings for the size of its folder."""

    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        with sized_session(spark, folder):
            return query(spark, folder)

    return run


def stored(model: DataFrame, name: str) -> DataFrame:
    """A model as the layered build has it: written once, then read where needed."""
    return rebuild_table(model, scratch_path(model.sparkSession, name))


# The test data repeats line numbers of an order; a ship day tells such lines apart, together
# with part and supplier. Merges use all of these as the key, so that no line is left out.
MERGED_LINE = ("order_key", "line_number", "part_key", "supplier_key")


def dated_lines(line_items: DataFrame) -> DataFrame:
    """Order lines whose line number includes the ship day."""
    day = F.datediff("ship_date", F.lit("1970-01-01").cast("date"))
    return line_items.withColumn("line_number", (F.col("line_number") + 10 * day).cast("int"))


def merge_layout(layout: FactLayout, *more: str) -> FactLayout:
    return replace(layout, key=(*MERGED_LINE, *more), line=MERGED_LINE)


def order_items(t: Mapping[str, DataFrame]) -> DataFrame:
    return gold.fct_order_items(
        gold.int_order_items(t["stg_tpch_orders"], t["stg_tpch_line_items"])
    )


def daily(t: Mapping[str, DataFrame]) -> DataFrame:
    return gold.fct_orders(gold.int_order_items_summary(order_items(t)))


def shipments(t: Mapping[str, DataFrame]) -> DataFrame:
    return silver.int_shipment_events(
        t["stg_tpch_orders"], t["stg_tpch_line_items"], t["stg_tpch_customers"]
    )


def shipment_events(t: Mapping[str, DataFrame]) -> DataFrame:
    return gold.fct_shipment_events(shipments(t), gold.dim_sla_policy(t["stg_tpch_customers"]))


def raw_dates(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["stg_tpch_line_items"].select(
        "order_key",
        "line_number",
        F.col("commit_date").alias("commit_date_raw"),
        F.col("ship_date").alias("ship_date_raw"),
        F.col("receipt_date").alias("receipt_date_raw"),
    )


def all_tables(
    spark: SparkSession, folder: str, *, store_joins: bool = False
) -> dict[str, DataFrame]:
    """Every checked table, derived from the sources.

    ``store_joins`` writes the two joined models once, for callers that read
    the tables derived from them many times.
    """
    sources = read_sources(spark, folder, stand_ins=True)
    t = stage_all(sources)
    orders, lines, customers = (
        t["stg_tpch_orders"],
        t["stg_tpch_line_items"],
        t["stg_tpch_customers"],
    )
    items = gold.int_order_items(orders, lines)
    shipped = shipments(t)
    if store_joins:
        items = stored(items, "int-order-items")
        shipped = stored(shipped, "int-shipment-events")
    fact = gold.fct_order_items(items)
    policy = gold.dim_sla_policy(customers)
    summary = gold.int_order_items_summary(fact)
    return {
        **sources,
        **t,
        "int_orders_enriched": silver.int_orders_enriched(orders, lines),
        "int_shipment_events": shipped,
        "int_order_items": items,
        "int_order_items_summary": summary,
        "fct_orders": gold.fct_orders(summary),
        "fct_order_items": fact,
        "fct_shipment_events": gold.fct_shipment_events(shipped, policy),
        "dim_customer": gold.dim_customer(customers),
        "dim_part": gold.dim_part(t["stg_tpch_parts"]),
        "dim_supplier": gold.dim_supplier(t["stg_tpch_suppliers"]),
        "dim_date": gold.dim_date(orders, lines),
        "dim_sla_policy": policy,
        "dim_status_policy": gold.dim_status_policy(spark),
    }


# Staging and expressions


def _staged(name: str) -> Query:
    return lambda spark, folder: presented(staging(spark, folder)[name])


def freshness(spark: SparkSession, folder: str) -> DataFrame:
    return source_freshness(
        {name: read_source(spark, folder, name, stand_ins=True) for name in LOADED_AT}
    )


def line_amounts(spark: SparkSession, folder: str) -> DataFrame:
    return presented(
        staging(spark, folder)["stg_tpch_line_items"].select(
            "order_key",
            "line_number",
            discounted_amount("extended_price", "discount").alias("discounted_amount"),
        )
    )


def line_surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return staging(spark, folder)["stg_tpch_line_items"].select(
        "order_key",
        "line_number",
        surrogate_key("part_key").alias("part_sk"),
        surrogate_key("order_key", "line_number").alias("line_sk"),
    )


def order_item_keys(spark: SparkSession, folder: str) -> DataFrame:
    return staging(spark, folder)["stg_tpch_line_items"].select(
        "order_key",
        "line_number",
        joined_key("order_key", "line_number").alias("order_item_key"),
    )


def ordered_dates(spark: SparkSession, folder: str) -> DataFrame:
    return silver.least_greatest_dates(raw_dates(staging(spark, folder))).select(
        "order_key", "line_number", "commit_date", "receipt_date"
    )


def median_dates(spark: SparkSession, folder: str) -> DataFrame:
    return silver.least_greatest_dates(raw_dates(staging(spark, folder))).select(
        "order_key",
        "line_number",
        "commit_date_raw",
        "ship_date_raw",
        "receipt_date_raw",
        "ship_date",
    )


def ship_lags(spark: SparkSession, folder: str) -> DataFrame:
    return silver.with_lags(
        silver.least_greatest_dates(raw_dates(staging(spark, folder)))
    ).select(
        "order_key",
        "line_number",
        "ship_minus_commit_days",
        "receipt_minus_ship_days",
        "is_ship_late",
        "is_receipt_late_default",
    )


# Models


def _model(build: Callable[[Mapping[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, folder: presented(build(staging(spark, folder)))


def unpivoted(t: Mapping[str, DataFrame]) -> DataFrame:
    events = unpivot_shipments(shipments(t), ["order_key", "line_number", "order_date"])
    key = joined_key("order_key", "line_number", "event_type")
    return events.select(key.alias("shipment_event_key"), *events.columns)


def status_policy_usage(t: Mapping[str, DataFrame]) -> DataFrame:
    """The status policy with the number of events judged by it and found late."""
    events = shipment_events(t).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if("is_late_against_status_policy").alias("n_late"),
    )
    policy = gold.dim_status_policy(events.sparkSession)
    return events.join(F.broadcast(policy), "event_type").select(
        "event_type", "event_order", "sla_target_days", "policy_version", "n_events", "n_late"
    )


# Incremental loads


def _loaded(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("order_date") <= F.lit(LOADED_TO))


def order_items_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    return cutoff(_loaded(order_items(staging(spark, folder))), "order_date")


def shipments_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    return cutoff(shipment_events(staging(spark, folder)), "event_date", when_empty=EPOCH)


def order_items_since(spark: SparkSession, folder: str) -> DataFrame:
    t = staging(spark, folder)
    items = gold.int_order_items(t["stg_tpch_orders"], t["stg_tpch_line_items"])
    return presented(gold.order_items_increment(items, _loaded(order_items(t))))


def refresh_keys(spark: SparkSession, folder: str) -> DataFrame:
    t = staging(spark, folder)
    shipped = stored(shipments(t), "int-shipment-events")
    policy = gold.dim_sla_policy(t["stg_tpch_customers"])
    return gold.shipment_refresh_keys(gold.fct_shipment_events(shipped, policy))


def refreshed_lines(spark: SparkSession, folder: str) -> DataFrame:
    t = staging(spark, folder)
    shipped = stored(shipments(t), "int-shipment-events")
    policy = gold.dim_sla_policy(t["stg_tpch_customers"])
    keys = gold.shipment_refresh_keys(gold.fct_shipment_events(shipped, policy))
    return gold.shipments_to_refresh(shipped, stored(keys, "refresh-keys"))


@sized
def merged_order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Merge the increment into a stored fact that was loaded before discounts were booked."""
    t = staging(spark, folder)
    orders, lines = t["stg_tpch_orders"], dated_lines(t["stg_tpch_line_items"])

    def undiscounted(rows: DataFrame) -> DataFrame:
        price = F.col("extended_price").cast("decimal(18,4)")
        return gold.order_item_columns(rows).withColumn("net_item_sales_amount", price)

    layout = merge_layout(gold.ORDER_ITEM_LAYOUT)
    path = scratch_path(spark, "fct-order-items")
    loaded = _loaded(gold.order_item_rows(gold.int_order_items(unbroadcast(orders), lines)))
    target = write_clustered(loaded, path, layout, ByRow(undiscounted))
    increment = gold.order_items_increment(
        lambda start: gold.recent_order_items(orders, lines, start),
        target,
        month=layout.month,
        path=path,
    )
    with settings(spark, gold.RECENT_KEYS):
        merged = merge_fact(spark, path, increment, layout)
    return presented(merged.drop(layout.month))


@sized
def merged_shipment_events(spark: SparkSession, folder: str) -> DataFrame:
    """Refresh recent lines of a stored fact that was loaded before lateness was judged."""
    t = staging(spark, folder)
    shipped = silver.int_shipment_events(
        t["stg_tpch_orders"], dated_lines(t["stg_tpch_line_items"]), t["stg_tpch_customers"]
    )
    lines_path = scratch_path(spark, "int-shipment-events")
    lines = rebuild_table(shipped, lines_path)
    policy = gold.dim_sla_policy(t["stg_tpch_customers"])

    def unjudged(rows: DataFrame) -> DataFrame:
        return gold.shipment_event_columns(rows).withColumn(
            "is_late_against_status_policy", F.lit(None).cast("boolean")
        )

    layout = merge_layout(gold.SHIPMENT_LAYOUT, "event_type")
    path = scratch_path(spark, "fct-shipment-events")
    first = replace(layout, passes=passes_over(stored_bytes(spark, lines_path)))
    target = write_clustered(gold.shipment_event_rows(lines, policy), path, first, unjudged)
    keys = gold.shipment_refresh_keys(target, month=layout.month, path=path)
    keys_path, rows_path = scratch_path(spark, "refresh-keys"), scratch_path(spark, "refreshed")
    due = gold.shipments_to_refresh(lines, rebuild_table(keys, keys_path))
    rows = rebuild_table(gold.fct_shipment_events(due, policy), rows_path)
    # Only the rows are needed from here on, a small part of the lines.
    for used in (lines_path, keys_path):
        drop_scratch(spark, used)
    merged = merge_fact(spark, path, rows, layout)
    drop_scratch(spark, rows_path)
    return merged.drop(layout.month)


def replayed_order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Fact rows of a range of order days; the range is applied in the scan of orders."""
    orders = read_source(
        spark, folder, "orders", stand_ins=True, window=("o_orderdate", *REPLAY)
    )
    lines = read_source(spark, folder, "lineitem", stand_ins=True)
    t = {
        name: staged(df, STAGED[name][1])
        for name, df in (("stg_tpch_orders", orders), ("stg_tpch_line_items", lines))
    }
    return presented(order_items(t))


# Sinks


def rebuilt_orders_enriched(spark: SparkSession, folder: str) -> DataFrame:
    t = staging(spark, folder)
    model = silver.int_orders_enriched(t["stg_tpch_orders"], t["stg_tpch_line_items"])
    return presented(stored(model, "int-orders-enriched"))


@sized
def clustered_order_items(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "clustered")
    t = staging(spark, folder)
    items = gold.int_order_items(unbroadcast(t["stg_tpch_orders"]), t["stg_tpch_line_items"])
    return presented(
        write_clustered(
            gold.order_item_rows(items), path, gold.ORDER_ITEM_LAYOUT, ByRow(gold.order_item_columns)
        )
    )


def exported_daily_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The exported CSV as text."""
    path = scratch_path(spark, "daily-csv")
    export_daily_metrics(daily(staging(spark, folder)), path)
    columns = ", ".join(f"{c} string" for c in checks.DAILY_COLUMNS)
    return spark.read.schema(columns).option("header", True).csv(path)


def reread_daily_metrics(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "daily-csv")
    export_daily_metrics(daily(staging(spark, folder)), path)
    return presented(read_daily_metrics_csv(spark, path))


# Histories


def _history(
    spark: SparkSession, snapshot: Snapshot, first: DataFrame, second: DataFrame
) -> DataFrame:
    path = scratch_path(spark, f"snapshots-{snapshot.name}")
    run_snapshot(spark, path, first, snapshot, FIRST_RUN)
    return run_snapshot(spark, path, second, snapshot, SECOND_RUN).drop("closed_on")


def _corrected_history(
    spark: SparkSession, snapshot: Snapshot, first: DataFrame, second: DataFrame, wrong: DataFrame
) -> DataFrame:
    """The second run is repeated, as its first attempt had other data."""
    path = scratch_path(spark, f"snapshots-{snapshot.name}")
    run_snapshot(spark, path, first, snapshot, FIRST_RUN)
    run_snapshot(spark, path, wrong, snapshot, SECOND_RUN)
    return run_snapshot(spark, path, second, snapshot, SECOND_RUN)


def stored_customer_history(spark: SparkSession, folder: str) -> DataFrame:
    """Second run: indebted customers change segment, customers with a small
    balance move to another nation (not checked), the richest leave, others join.
    A first attempt at it took the rich for indebted instead."""
    customers = gold.dim_customer(staging(spark, folder)["stg_tpch_customers"])
    balance = F.col("account_balance")
    later = (
        customers.filter(balance <= 9900)
        .withColumn(
            "market_segment",
            F.when(balance < 0, F.concat("market_segment", F.lit("_X"))).otherwise(
                F.col("market_segment")
            ),
        )
        .withColumn(
            "nation_key",
            F.when(balance.between(0, 1000), F.col("nation_key") + 100).otherwise(
                F.col("nation_key")
            ),
        )
    )
    joining = customers.filter(balance > 9800).withColumn(
        "customer_key", F.col("customer_key") + 100_000_000
    )
    wrong = customers.withColumn(
        "market_segment",
        F.when(balance > 5000, F.concat("market_segment", F.lit("_X"))).otherwise(
            F.col("market_segment")
        ),
    )
    return _corrected_history(
        spark, snapshots.SNAP_CUSTOMER, customers, later.unionByName(joining), wrong
    )


def customer_history(spark: SparkSession, folder: str) -> DataFrame:
    return stored_customer_history(spark, folder).drop("closed_on")


def part_history(spark: SparkSession, folder: str) -> DataFrame:
    """Second run: large parts cost one more, small parts lose their container."""
    parts = gold.dim_part(staging(spark, folder)["stg_tpch_parts"])
    size = F.col("part_size")
    later = parts.withColumn(
        "retail_price",
        F.when(size > 25, F.col("retail_price") + 1)
        .otherwise(F.col("retail_price"))
        .cast("decimal(15,2)"),
    ).withColumn("container", F.when(size > 5, F.col("container")))
    return presented(_history(spark, snapshots.SNAP_PART, parts, later))


def sla_history(spark: SparkSession, folder: str) -> DataFrame:
    """Second run: long targets get one more day."""
    policy = gold.dim_sla_policy(staging(spark, folder)["stg_tpch_customers"])
    days = F.col("sla_target_days")
    later = policy.withColumn("sla_target_days", F.when(days >= 10, days + 1).otherwise(days))
    return _history(spark, snapshots.SNAP_SLA_POLICY, policy, later)


def status_history(spark: SparkSession, folder: str) -> DataFrame:
    """Second run: shipping may take five days. Events are judged by every version."""
    policy = gold.dim_status_policy(spark)
    later = policy.withColumn(
        "sla_target_days",
        F.when(F.col("event_type") == "SHIP", 5).otherwise(F.col("sla_target_days")),
    )
    versions = _history(spark, snapshots.SNAP_STATUS_POLICY, policy, later)
    lags = (
        shipment_events(staging(spark, folder))
        .groupBy("event_type", "days_since_prior_event")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    late = F.col("days_since_prior_event") > F.col("sla_target_days")
    return (
        lags.join(versions, "event_type")
        .groupBy(*versions.columns)
        .agg(
            F.sum("n").alias("n_events"),
            F.coalesce(F.sum(F.when(late, F.col("n"))), F.lit(0)).alias("n_late"),
        )
    )


def customers_between_runs(spark: SparkSession, folder: str) -> DataFrame:
    return as_of(stored_customer_history(spark, folder), BETWEEN_RUNS).drop("closed_on")


# Checks


def _checked(kind: str, *, store_joins: bool = False) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        tables = all_tables(spark, folder, store_joins=store_joins)
        with settings(spark, SMALL_TASKS):
            return stored(check_metrics(tables, checks.of_kind(kind), "data_tests"), "metrics")

    return sized(run)


def _expected(kind: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        chosen = checks.of_kind(kind, checks.DAILY_METRICS)
        batch = daily(staging(spark, folder))
        return check_metrics({"fct_orders": batch}, chosen, "daily_metrics")

    return run


def days_out_of_range(spark: SparkSession, folder: str) -> DataFrame:
    batch = daily(staging(spark, folder))
    return presented(violations(batch, checks.ORDERS_DATE_VALID[0], as_of=JUDGED_ON))


def negative_amounts(spark: SparkSession, folder: str) -> DataFrame:
    batch = daily(staging(spark, folder))
    return check_metrics({"fct_orders": batch}, checks.ORDERS_DISCOUNT, "data_tests")


def daily_suite(spark: SparkSession, folder: str) -> DataFrame:
    """The suite over the exported batch, with its outcome stored."""
    return publish_daily_metrics(
        daily(staging(spark, folder)),
        scratch_path(spark, "daily-csv"),
        scratch_path(spark, "results"),
        FIRST_RUN,
    )


def stored_results(spark: SparkSession, folder: str) -> DataFrame:
    metrics = checks.run_suite(daily(staging(spark, folder)))
    kept = store_results(metrics, scratch_path(spark, "results"), FIRST_RUN)
    return kept.select(*METRIC_COLUMNS, "run_id", "run_ts")


def newest_events(spark: SparkSession, folder: str) -> DataFrame:
    events = spark.read.parquet(f"{folder.rstrip('/')}/events.parquet")
    newest = latest_n_per_group(events, ["event_type"], [F.desc("ts"), F.desc("event_id")])
    return newest.select("event_type", "ts", "event_id", "user_id", "value")


# Checks the test data is known to break: repeated line numbers and shipment
# events outside the calendar.
KNOWN_TO_FAIL: list[Check] = [
    *checks.of_kind("unique_combination"),
    *[
        c
        for c in checks.of_kind("unique")
        if c.columns in (("order_item_key",), ("shipment_event_key",))
    ],
    *[c for c in checks.of_kind("relationships") if c.parent == ("dim_date", "date_day")],
]


def layered_build(spark: SparkSession, folder: str) -> DataFrame:
    return build_layers(
        spark,
        folder,
        scratch_path(spark, "layers"),
        FIRST_RUN,
        as_of=BUILT_ON,
        sources=read_sources(spark, folder, stand_ins=True),
        severities={check: "warn" for check in KNOWN_TO_FAIL},
    )


QUERIES: dict[str, Query] = {
    "stg_orders": _staged("stg_tpch_orders"),
    "stg_customers": _staged("stg_tpch_customers"),
    "stg_line_items": _staged("stg_tpch_line_items"),
    "stg_parts": _staged("stg_tpch_parts"),
    "stg_suppliers": _staged("stg_tpch_suppliers"),
    "source_freshness": freshness,
    "discounted_amount": line_amounts,
    "surrogate_key": line_surrogate_keys,
    "order_item_key": order_item_keys,
    "shipment_event_key": _model(
        lambda t: unpivoted(t).select("shipment_event_key", "event_type")
    ),
    "least_greatest_dates": ordered_dates,
    "median_date": median_dates,
    "ship_lags": ship_lags,
    "date_bounds": _model(
        lambda t: date_bounds(t["stg_tpch_orders"], t["stg_tpch_line_items"])
    ),
    "date_spine": _model(
        lambda t: date_spine(date_bounds(t["stg_tpch_orders"], t["stg_tpch_line_items"]))
    ),
    "dim_date": _model(lambda t: gold.dim_date(t["stg_tpch_orders"], t["stg_tpch_line_items"])),
    "distinct_segments": _model(lambda t: gold.distinct_segments(t["stg_tpch_customers"])),
    "dim_sla_policy": _model(lambda t: gold.dim_sla_policy(t["stg_tpch_customers"])),
    "dim_status_policy": _model(status_policy_usage),
    "dim_customer": _model(lambda t: gold.dim_customer(t["stg_tpch_customers"])),
    "dim_part": _model(lambda t: gold.dim_part(t["stg_tpch_parts"])),
    "dim_supplier": _model(lambda t: gold.dim_supplier(t["stg_tpch_suppliers"])),
    "int_orders_enriched": _model(
        lambda t: silver.int_orders_enriched(t["stg_tpch_orders"], t["stg_tpch_line_items"])
    ),
    "int_shipment_events": _model(shipments),
    "int_order_items": _model(
        lambda t: gold.int_order_items(t["stg_tpch_orders"], t["stg_tpch_line_items"])
    ),
    "fct_order_items": _model(order_items),
    "int_order_items_summary": _model(lambda t: gold.int_order_items_summary(order_items(t))),
    "fct_orders": _model(daily),
    "events_unpivot": _model(unpivoted),
    "fct_shipment_events": _model(shipment_events),
    "incr_cutoff_order_items": order_items_cutoff,
    "incr_cutoff_shipments": shipments_cutoff,
    "incr_filter_order_items": order_items_since,
    "incr_refresh_keys": refresh_keys,
    "incr_semi_join": refreshed_lines,
    "merge_order_items": merged_order_items,
    "merge_shipment_events": merged_shipment_events,
    "backfill_window": replayed_order_items,
    "table_rebuild": rebuilt_orders_enriched,
    "clustered_write": clustered_order_items,
    "export_daily_metrics": exported_daily_metrics,
    "export_roundtrip": reread_daily_metrics,
    "snap_customer": customer_history,
    "snap_part": part_history,
    "snap_sla_policy": sla_history,
    "snap_status_policy": status_history,
    "snap_as_of": customers_between_runs,
    "check_not_null": _checked("not_null", store_joins=True),
    "check_unique": _checked("unique"),
    "check_unique_combination": _checked("unique_combination"),
    "check_accepted_values": _checked("accepted_values"),
    "check_relationships": _checked("relationships"),
    "check_expression": _checked("expression_is_true"),
    "check_orders_date_valid": days_out_of_range,
    "check_orders_discount": negative_amounts,
    "expect_row_count": _expected("row_count_at_least"),
    "expect_not_null": _expected("not_null"),
    "expect_between": _expected("at_least"),
    "run_suite": daily_suite,
    "validation_results": stored_results,
    "latest_n_per_group": newest_events,
    "build_layers": layered_build,
}

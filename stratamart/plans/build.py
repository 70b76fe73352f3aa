"""Building all layers with a gate of checks after each."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions import between_window
from stratamart.operators.history import run_snapshot
from stratamart.operators.line_months import build_table
from stratamart.operators.merge import LOOKBACK_DAYS, merge_fact
from stratamart.operators.quality import (
    METRIC_COLUMNS,
    SMALL_TASKS_OF_STORED,
    Check,
    check_metrics,
    enforce,
    with_severity,
)
from stratamart.operators.storage import (
    RELEASING,
    ByRow,
    FactLayout,
    drop_scratch,
    load_if_exists,
    passes_over,
    read_fact,
    rebuild_table,
    scratch_path,
    settings,
    write_clustered,
)
from stratamart.plans import gold, silver
from stratamart.plans.bronze import stage_all
from stratamart.plans.checks import LAYER_CHECKS
from stratamart.plans.export import read_results, run_name, store_results
from stratamart.plans.schemas import as_declared
from stratamart.plans.snapshots import SNAPSHOTS
from stratamart.sources import read_sources

CONCURRENT_WRITES = 8
ADAPTIVE = "spark.sql.adaptive.enabled"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
SHUFFLE_BYTES = 8 * 1024 * 1024  # of stored source rows; a task holds many times that
MAX_SHUFFLE_PARTITIONS = 40_000
GATE_BYTES = 256 * 1024 * 1024  # of a stored layer, whose keys a gate counts in one pass

STORED_BY_MONTH = {"stg_tpch_orders": gold.ORDERS_LAYOUT}

Window = tuple[dt.date | None, dt.date | None]


def stored_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of the Parquet files under a folder, from their listing alone."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def sized_session(spark: SparkSession, folder: str) -> AbstractContextManager[None]:
    """Session settings for the size of the input, for the time of a build.

    Shuffle partitions follow the stored bytes (a higher setting of the session
    stays; adaptive execution merges small ones). Their upper limit keeps the
    driver's table of map outputs small; beyond it partitions grow and spill.
    What a job has shuffled is removed when the job ends.
    """
    needed = math.ceil(stored_bytes(spark, folder) / SHUFFLE_BYTES)
    current = int(spark.conf.get(SHUFFLE_PARTITIONS))
    wanted = max(current, min(needed, MAX_SHUFFLE_PARTITIONS))
    return settings(spark, {SHUFFLE_PARTITIONS: str(wanted), **RELEASING})


def rebuild_all(
    spark: SparkSession, tables: Mapping[str, DataFrame], folder: str
) -> dict[str, DataFrame]:
    """Write independent tables side by side and return them as stored.

    Those in ``STORED_BY_MONTH`` have their month as a further column.
    """
    in_session = inheritable_thread_target(spark)

    def write(item: tuple[str, DataFrame]) -> tuple[str, DataFrame]:
        name, table = item
        table, path = as_declared(name, table), f"{folder}/{name}"
        layout = STORED_BY_MONTH.get(name)
        if layout is not None:
            return name, write_clustered(table, path, layout)
        return name, rebuild_table(table, path)

    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        return dict(pool.map(in_session(write), tables.items()))


def build_order_items(
    spark: SparkSession,
    path: str,
    order_items: DataFrame,
    *,
    recent: Callable[[dt.date | None], DataFrame] | None = None,
    full_refresh: bool = False,
    window: Window | None = None,
    lookback_days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Create the order-item fact, or merge the recent rows into it.

    A window limits either to its order days; it excludes a full refresh.
    ``recent`` gives the order items since a day, for an increment that does
    not read all of ``order_items``.
    """
    layout = gold.ORDER_ITEM_LAYOUT
    full = as_declared("fct_order_items", gold.fct_order_items(order_items))
    target = _target(spark, path, layout, full)
    _refuse_both(full_refresh, window)
    if target is None or full_refresh:
        if window is not None:
            order_items = order_items.filter(between_window(F.col("order_date"), *window))
        narrow = gold.order_item_rows(order_items)
        fact = write_clustered(narrow, path, layout, ByRow(gold.order_item_columns))
        build_table(spark, path, layout, full.schema)
        return fact
    if window is not None:
        rows = full.filter(between_window(F.col("order_date"), *window))
    else:
        rows = gold.order_items_increment(
            recent or order_items,
            target,
            lookback_days=lookback_days,
            month=layout.month,
            path=path,
        )
    with settings(spark, gold.RECENT_KEYS):
        return merge_fact(spark, path, rows, layout)


def build_shipment_events(
    spark: SparkSession,
    path: str,
    shipments: DataFrame,
    sla_policy: DataFrame,
    status_policy: DataFrame,
    *,
    full_refresh: bool = False,
    window: Window | None = None,
    include_new_keys: bool = False,
    lookback_days: int = LOOKBACK_DAYS,
    passes: int = 1,
) -> DataFrame:
    """Create the shipment-event fact, or refresh whole lines of it.

    A fact is created in so many ``passes`` over the shipments.
    """
    layout = gold.SHIPMENT_LAYOUT
    full = gold.fct_shipment_events(shipments, sla_policy, status_policy)
    full = as_declared("fct_shipment_events", full)
    target = _target(spark, path, layout, full)
    _refuse_both(full_refresh, window)
    if target is None or full_refresh:
        if window is not None:
            shipments = shipments.filter(between_window(F.col("order_date"), *window))
        fact = write_clustered(
            gold.shipment_event_rows(shipments, sla_policy),
            path,
            replace(layout, passes=passes),
            lambda rows: gold.shipment_event_columns(rows, status_policy),
        )
        build_table(spark, path, layout, full.schema)
        return fact
    if window is not None:
        lines = shipments.filter(between_window(F.col("order_date"), *window))
        rows = gold.fct_shipment_events(lines, sla_policy, status_policy)
        return merge_fact(spark, path, rows, layout)
    keys = gold.shipment_refresh_keys(
        target,
        new_from=shipments if include_new_keys else None,
        lookback_days=lookback_days,
        month=layout.month,
        path=path,
    )
    keys_path = scratch_path(spark, "refresh-keys")
    try:
        lines = gold.shipments_to_refresh(shipments, rebuild_table(keys, keys_path))
        rows = gold.fct_shipment_events(lines, sla_policy, status_policy)
        return merge_fact(spark, path, rows, layout)
    finally:
        drop_scratch(spark, keys_path)


def _refuse_both(full_refresh: bool, window: Window | None) -> None:
    if full_refresh and window is not None:
        raise ValueError("a full refresh has no window: leave one of the two out")


def _target(
    spark: SparkSession, path: str, layout: FactLayout, like: DataFrame
) -> DataFrame | None:
    if load_if_exists(spark, path, like.schema) is None:
        return None
    return read_fact(spark, path, layout, like.schema)


def build_layers(
    spark: SparkSession,
    src_dir: str,
    out_dir: str,
    run_ts: dt.datetime,
    *,
    as_of: dt.date | None = None,
    sources: Mapping[str, DataFrame] | None = None,
    severities: Mapping[Check, str] | None = None,
    full_refresh: bool = False,
    window: Window | None = None,
    include_new_keys: bool = False,
    lookback_days: int = LOOKBACK_DAYS,
    sla_policy_version: str = "v1",
    status_policy_version: str = "v1",
) -> DataFrame:
    """Build bronze, silver, gold and the histories; stop at the first failing gate.

    Returns the stored check metrics of the run. ``severities`` replaces the
    severity of single checks: a check at ``warn`` is reported but does not
    stop the build. A session without adaptive execution is refused. ``window`` replays a range of order dates into the facts.
    """
    if spark.conf.get(ADAPTIVE).lower() != "true":
        # Hot keys and the sizes of files are left to it.
        raise RuntimeError(f"a build needs {ADAPTIVE}=true")
    results_path = f"{out_dir}/validation_results"
    tables: dict[str, DataFrame] = dict(sources or read_sources(spark, src_dir))

    def gate(layer: str) -> None:
        checks = with_severity(LAYER_CHECKS[layer], severities or {})
        # The sources, which the first gate checks too, are not ours to be read several times.
        size = 0 if layer == "bronze" else stored_bytes(spark, f"{out_dir}/{layer}")
        with settings(spark, SMALL_TASKS_OF_STORED):
            metrics = check_metrics(
                tables, checks, layer, as_of=as_of, passes=passes_over(size, GATE_BYTES)
            )
            stored = store_results(metrics, results_path, run_ts)
        enforce(stored.filter(F.col("suite") == layer))

    with sized_session(spark, src_dir):
        tables |= rebuild_all(spark, stage_all(tables), f"{out_dir}/bronze")
        gate("bronze")

        orders, lines = tables["stg_tpch_orders"], tables["stg_tpch_line_items"]
        customers = tables["stg_tpch_customers"]
        tables |= rebuild_all(
            spark,
            {
                "int_orders_enriched": silver.int_orders_enriched(orders, lines),
                "int_shipment_events": silver.int_shipment_events(orders, lines, customers),
            },
            f"{out_dir}/silver",
        )
        gate("silver")

        tables |= rebuild_all(
            spark,
            {
                "dim_customer": gold.dim_customer(customers),
                "dim_part": gold.dim_part(tables["stg_tpch_parts"]),
                "dim_supplier": gold.dim_supplier(tables["stg_tpch_suppliers"]),
                "dim_date": gold.dim_date(orders, lines),
                "dim_sla_policy": gold.dim_sla_policy(customers, sla_policy_version),
                "dim_status_policy": gold.dim_status_policy(spark, status_policy_version),
            },
            f"{out_dir}/gold",
        )
        # Stored because five checks and a first build read it: one join instead of six.
        # An increment does not: it joins the recent orders alone.
        tables |= rebuild_all(
            spark,
            {"int_order_items": gold.int_order_items(orders, lines)},
            f"{out_dir}/gold",
        )
        tables["fct_order_items"] = build_order_items(
            spark,
            f"{out_dir}/gold/fct_order_items",
            tables["int_order_items"],
            recent=lambda start: gold.recent_order_items(orders, lines, start),
            full_refresh=full_refresh,
            window=window,
            lookback_days=lookback_days,
        )
        tables["fct_shipment_events"] = build_shipment_events(
            spark,
            f"{out_dir}/gold/fct_shipment_events",
            tables["int_shipment_events"],
            tables["dim_sla_policy"],
            tables["dim_status_policy"],
            full_refresh=full_refresh,
            window=window,
            include_new_keys=include_new_keys,
            lookback_days=lookback_days,
            passes=passes_over(stored_bytes(spark, f"{out_dir}/silver/int_shipment_events")),
        )
        daily = gold.int_order_items_summary(tables["fct_order_items"])
        tables |= rebuild_all(
            spark, {"int_order_items_summary": daily}, f"{out_dir}/gold"
        )
        tables["fct_orders"] = gold.fct_orders(tables["int_order_items_summary"])
        gate("gold")

        for dimension, snapshot in SNAPSHOTS.items():
            run_snapshot(
                spark,
                f"{out_dir}/snapshots/{snapshot.name}",
                tables[dimension],
                snapshot,
                run_ts,
            )
    stored = read_results(spark, results_path)
    return stored.filter(F.col("run_id") == run_name(run_ts)).select(*METRIC_COLUMNS)

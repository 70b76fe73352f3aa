"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (folder of tables), BENCH_CPUS (local cores),
BENCH_QUERIES (comma-separated names), BENCH_RUNS (timed runs per query; the
fastest counts). Results are computed in full and discarded by the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from stratamart.catalog import QUERIES

HEADLINE = [
    "stg_orders",
    "stg_line_items",
    "int_orders_enriched",
    "int_shipment_events",
    "int_order_items",
    "fct_order_items",
    "fct_orders",
    "fct_shipment_events",
    "dim_customer",
    "dim_date",
    "dim_sla_policy",
    "incr_filter_order_items",
    "incr_refresh_keys",
    "incr_semi_join",
    "backfill_window",
    "merge_order_items",
    "merge_shipment_events",
    "clustered_write",
    "export_roundtrip",
    "snap_customer",
    "snap_part",
    "check_not_null",
    "check_unique",
    "check_relationships",
    "run_suite",
    "latest_n_per_group",
    "build_layers",
]


def timed(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed(spark, "fct_orders", folder)  # starts the JVM's compilers and the file cache
    seconds = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        seconds[name] = round(min(timed(spark, name, folder) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()

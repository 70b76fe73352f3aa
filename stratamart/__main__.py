"""Jobs for spark-submit: build the layers, publish the daily metric, prune results."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from stratamart.operators.merge import LOOKBACK_DAYS
from stratamart.plans.build import build_layers
from stratamart.plans.export import prune_results, publish_daily_metrics
from stratamart.plans.gold import fct_orders


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="stratamart")
    jobs = parser.add_subparsers(dest="job", required=True)
    now = dt.datetime.now().replace(microsecond=0)

    build = jobs.add_parser("build", help="build all layers with their gates")
    build.add_argument("--src", required=True, help="folder of the source tables")
    build.add_argument("--out", required=True, help="folder of the built tables")
    build.add_argument("--run-ts", type=dt.datetime.fromisoformat, default=now)
    build.add_argument("--start-date", type=dt.date.fromisoformat)
    build.add_argument("--end-date", type=dt.date.fromisoformat)
    build.add_argument("--full-refresh", action="store_true")
    build.add_argument("--include-new-keys", action="store_true")
    build.add_argument("--lookback-days", type=int, default=LOOKBACK_DAYS)
    build.add_argument("--sla-policy-version", default="v1")
    build.add_argument("--status-policy-version", default="v1")

    daily = jobs.add_parser("daily-metrics", help="export and validate the daily metric")
    daily.add_argument("--out", required=True, help="folder of the built tables")
    daily.add_argument("--csv", required=True, help="folder of the exported CSV")
    daily.add_argument("--run-ts", type=dt.datetime.fromisoformat, default=now)

    prune = jobs.add_parser("prune-results", help="keep the newest validation runs")
    prune.add_argument("--out", required=True, help="folder of the built tables")
    prune.add_argument("--keep", type=int, default=5)
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    results = f"{args.out}/validation_results"
    if args.job == "build":
        window = None
        if args.start_date or args.end_date:
            window = (args.start_date, args.end_date)
        build_layers(
            spark,
            args.src,
            args.out,
            args.run_ts,
            window=window,
            full_refresh=args.full_refresh,
            include_new_keys=args.include_new_keys,
            lookback_days=args.lookback_days,
            sla_policy_version=args.sla_policy_version,
            status_policy_version=args.status_policy_version,
        )
    elif args.job == "daily-metrics":
        summary = spark.read.parquet(f"{args.out}/gold/int_order_items_summary")
        publish_daily_metrics(fct_orders(summary), args.csv, results, args.run_ts)
    else:
        prune_results(spark, results, args.keep)


if __name__ == "__main__":
    run(SparkSession.builder.appName("stratamart").getOrCreate(), arguments())

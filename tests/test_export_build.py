import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plans_util import plan
from stratamart.__main__ import arguments, run
from stratamart.catalog import BUILT_ON, KNOWN_TO_FAIL, daily, staging
from stratamart.operators import folders
from stratamart.operators.quality import GateFailed
from stratamart.operators.retention import latest_n_per_group
from stratamart.plans import checks, gold
from stratamart.plans.bronze import STAGED
from stratamart.plans.build import build_layers, build_order_items, build_shipment_events
from stratamart.plans.export import (
    export_daily_metrics,
    newest_runs,
    prune_results,
    publish_daily_metrics,
    read_results,
    store_results,
)
from stratamart.plans.schemas import SchemaMismatch, as_declared, register_views
from stratamart.sources import read_daily_metrics_csv, read_sources

RUN = dt.datetime(2024, 1, 1)


def test_export_is_ordered_and_reads_back(spark, small, folder):
    batch = daily(staging(spark, small))
    export_daily_metrics(batch, f"{folder}/csv")
    files = sorted(spark.read.text(f"{folder}/csv").inputFiles())
    days = []
    for file in files:
        lines = [r.value for r in spark.read.text(file).collect()]
        assert lines[0].split(",") == list(checks.DAILY_COLUMNS)
        days += [line.split(",")[0] for line in lines[1:]]
    assert len(days) == 1084 and days == sorted(days, reverse=True)
    back = read_daily_metrics_csv(spark, f"{folder}/csv")
    assert back.exceptAll(batch).count() == 0 and batch.exceptAll(back).count() == 0


def test_results_are_kept_per_run(spark, small, folder):
    metrics = checks.run_suite(daily(staging(spark, small)))
    for days in range(4):
        store_results(metrics, folder, RUN + dt.timedelta(days=days))
    again = store_results(metrics, folder, RUN)
    assert again.count() == 8 and read_results(spark, folder).count() == 32
    newest = newest_runs(read_results(spark, folder), keep=2)
    assert {r.run_id for r in newest.collect()} == {"20240103-000000", "20240104-000000"}
    assert prune_results(spark, folder, keep=3).count() == 24
    assert read_results(spark, folder).select("run_id").distinct().count() == 3


def test_pruning_leaves_kept_runs_alone_and_can_be_repeated(spark, small, folder, monkeypatch):
    metrics = checks.run_suite(daily(staging(spark, small)))
    for days in range(4):
        store_results(metrics, folder, RUN + dt.timedelta(days=days))
    other = metrics.withColumn("suite", F.lit("by hand: 1/2"))
    store_results(other, folder, RUN)
    store_results(other, folder, RUN + dt.timedelta(days=9))

    def files():
        return {str(f): f.stat().st_mtime_ns for f in Path(folder).rglob("*.parquet")}

    before, removed = files(), []
    remove = folders.remove

    def failing(session, path):
        if removed:
            raise OSError("storage is away")
        removed.append(path)
        remove(session, path)

    monkeypatch.setattr(folders, "remove", failing)
    with pytest.raises(OSError, match="away"):
        prune_results(spark, folder, keep=1)
    monkeypatch.setattr(folders, "remove", remove)
    assert len(removed) == 1
    left = prune_results(spark, folder, keep=1).select("suite", "run_id").distinct().collect()
    assert {tuple(r) for r in left} == {
        ("daily_metrics", "20240104-000000"),
        ("by hand: 1/2", "20240110-000000"),
    }
    after = files()
    assert len(after) == 2 and after.items() <= before.items()


def test_a_build_without_adaptive_execution_is_refused(spark, small, folder):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="adaptive"):
            build_layers(spark, small, folder, RUN)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert list(Path(folder).iterdir()) == []


def test_failing_batch_is_stored_and_raises(spark, small, folder):
    batch = daily(staging(spark, small)).withColumn("items_cnt", F.lit(-1).cast("bigint"))
    with pytest.raises(GateFailed, match="at_least"):
        publish_daily_metrics(batch, f"{folder}/csv", f"{folder}/results", RUN)
    assert read_results(spark, f"{folder}/results").filter("not passed").count() == 1


@pytest.mark.parametrize("keep", [1, 5, 100, 1500])
def test_newest_rows_of_each_group(spark, small, keep):
    events = spark.read.parquet(f"{small}/events.parquet")
    newest = [F.desc("ts"), F.desc("event_id")]
    found = latest_n_per_group(events, ["event_type"], newest, keep)
    rank = F.row_number().over(W.partitionBy("event_type").orderBy(*newest))
    expected = events.withColumn("r", rank).filter(F.col("r") <= keep).drop("r")
    assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0
    text = plan(found, "simple")
    if keep <= 1000:
        assert "WindowGroupLimit" in text[text.index("Exchange hashpartitioning") :]
    assert text.count("Exchange hashpartitioning") == (1 if keep <= 16 else 3)


def clean_sources(spark, small):
    """Sources without repeated line numbers."""
    sources = read_sources(spark, small, stand_ins=True)
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount"]
    rank = F.row_number().over(W.partitionBy("l_orderkey", "l_linenumber").orderBy(*order))
    lines = sources["lineitem"].withColumn("r", rank).filter("r = 1").drop("r")
    return sources | {"lineitem": lines}


OUTSIDE_CALENDAR = {c: "warn" for c in KNOWN_TO_FAIL if c.kind == "relationships"}


def test_failing_gate_stops_the_later_layers(spark, small, folder):
    with pytest.raises(GateFailed, match="unique_combination"):
        build_layers(
            spark, small, folder, RUN, sources=read_sources(spark, small, stand_ins=True)
        )
    stored = read_results(spark, f"{folder}/validation_results")
    assert {r.suite for r in stored.select("suite").distinct().collect()} == {"bronze"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/silver/int_orders_enriched")


def test_build_then_incremental_build(spark, small, folder):
    sources = clean_sources(spark, small)
    options = dict(as_of=BUILT_ON, sources=sources, severities=OUTSIDE_CALENDAR)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    first = build_layers(spark, small, folder, RUN, **options)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    failed = {(r.target, r.check_name): r.n_bad for r in first.filter("not passed").collect()}
    assert failed == {("fct_shipment_events", "relationships"): 20}
    assert first.count() == 133

    spark.read.parquet(f"{folder}/gold/fct_order_items").write.parquet(f"{folder}/kept/items")
    spark.read.parquet(f"{folder}/gold/fct_shipment_events").write.parquet(f"{folder}/kept/events")
    fact = spark.read.parquet(f"{folder}/kept/items")
    events = spark.read.parquet(f"{folder}/kept/events")
    assert (fact.count(), events.count()) == (4599, 3 * 4599)

    # A second run over the same sources changes nothing.
    build_layers(spark, small, folder, RUN + dt.timedelta(days=1), **options)
    for table, name in ((fact, "fct_order_items"), (events, "fct_shipment_events")):
        now = spark.read.parquet(f"{folder}/gold/{name}")
        assert now.exceptAll(table).count() == 0 and table.exceptAll(now).count() == 0
    history = spark.read.parquet(f"{folder}/snapshots/snap_dim_customer")
    assert history.count() == history.filter("valid_to is null").count() == 150

    # Prices change everywhere; a replayed range takes them in, and no other day.
    window = (dt.date(2000, 1, 1), dt.date(2000, 4, 1))
    staged = {n: spark.read.parquet(f"{folder}/bronze/{n}") for n in STAGED}
    lines = staged["stg_tpch_line_items"].withColumn("discount", F.lit(0).cast("decimal(15,2)"))
    items = gold.int_order_items(staged["stg_tpch_orders"], lines)
    now = build_order_items(spark, f"{folder}/gold/fct_order_items", items, window=window)
    changed = now.exceptAll(fact).agg(F.min("order_date"), F.max("order_date")).first()
    assert window[0] <= changed[0] and changed[1] < window[1]
    inside = now.filter(F.col("order_date").between(window[0], dt.date(2000, 3, 31)))
    assert inside.filter("discount <> 0").count() == 0 and now.count() == 4599

    # Whole lines of the range are refreshed in the shipment fact.
    path = f"{folder}/gold/fct_shipment_events"
    shipped = spark.read.parquet(f"{folder}/silver/int_shipment_events")
    policies = [spark.read.parquet(f"{folder}/gold/dim_{p}_policy") for p in ("sla", "status")]
    later = policies[1].withColumn("sla_target_days", F.col("sla_target_days") + 1)
    now = build_shipment_events(spark, path, shipped, policies[0], later, window=window)
    changed = now.exceptAll(events).select("order_key", "line_number").distinct()
    replayed = shipped.filter(F.col("order_date").between(window[0], dt.date(2000, 3, 31)))
    replayed = replayed.select("order_key", "line_number")
    assert changed.exceptAll(replayed).count() == 0 == replayed.exceptAll(changed).count()
    assert now.count() == 3 * 4599


def test_jobs(spark, small, folder):
    sources = clean_sources(spark, small)
    orders = sources["orders"]
    last = orders.agg(F.max("o_orderdate")).first()[0]
    # Keep the calendar wide enough for every event, so that all gates pass.
    early = orders.limit(1).select(
        F.lit(-1).cast("bigint").alias("o_orderkey"),
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.lit(dt.date(1994, 1, 1)).alias("o_orderdate"),
    )
    receipt = F.least("l_receiptdate", F.lit(last))
    lines = sources["lineitem"].withColumn("l_receiptdate", receipt).withColumn(
        "l_commitdate", F.least("l_commitdate", receipt)
    ).withColumn("l_shipdate", F.least("l_shipdate", receipt))
    for name, table in (sources | {"orders": orders.unionByName(early), "lineitem": lines}).items():
        table.write.parquet(f"{folder}/src/{name}.parquet")
    out = f"{folder}/out"
    run(spark, arguments(["build", "--src", f"{folder}/src", "--out", out,
                          "--run-ts", "2024-01-01T00:00:00", "--sla-policy-version", "v2"]))
    run(spark, arguments(["daily-metrics", "--out", out, "--csv", f"{folder}/csv",
                          "--run-ts", "2024-01-02T00:00:00"]))
    results = read_results(spark, f"{out}/validation_results")
    assert results.count() == 133 + 8 and results.filter("not passed").count() == 0
    names = register_views(spark, out)
    assert {r[0] for r in spark.sql("select policy_version from dim_sla_policy").collect()} == {"v2"}
    assert len(names) == 5 + 2 + 10 + 1 + 4
    late = spark.sql(
        """select d.year, count_if(f.is_late_against_status_policy) as late
           from fct_shipment_events f
           join dim_date d on d.date_day = f.event_date
           join snap_dim_customer c on c.customer_key = f.customer_key and c.valid_to is null
           group by d.year"""
    )
    assert sum(r.late for r in late.collect()) > 0
    assert spark.table("fct_orders").agg(F.sum("items_cnt")).first()[0] == 4599
    for name in names:
        spark.catalog.dropTempView(name)
    run(spark, arguments(["prune-results", "--out", out, "--keep", "0"]))
    assert read_results(spark, f"{out}/validation_results").count() == 0


def test_undeclared_columns_are_refused(spark, small):
    policy = gold.dim_status_policy(spark)
    assert as_declared("dim_status_policy", policy) is policy
    with pytest.raises(SchemaMismatch, match="event_order"):
        as_declared("dim_status_policy", policy.withColumn("event_order", F.lit("1")))
    with pytest.raises(SchemaMismatch, match="order of columns"):
        as_declared("dim_status_policy", policy.select(*reversed(policy.columns)))

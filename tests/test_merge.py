import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import builders as b
from plans_util import plan
from stratamart.operators import folders, line_months, merge, storage
from stratamart.operators.merge import (
    DuplicateMergeKeys,
    cutoff,
    cutoff_value,
    merge_fact,
    merge_upsert,
    require_unique,
)
from stratamart.operators.storage import FactLayout, read_fact, write_clustered
from stratamart.plans import gold, silver

LAYOUT = FactLayout(key="k", day="d", month="m", line=("o",), cluster_key="o")
SCHEMA = "k string, o bigint, d date, v int"


def rows(spark, *items):
    return spark.createDataFrame([(k, o, b.day(d), v) for k, o, d, v in items], SCHEMA)


def content(df):
    return sorted((r.k, r.o, str(r.d), r.v) for r in df.collect())


def test_upsert_replaces_and_adds(spark):
    target = rows(spark, ("a", 1, "2024-01-01", 1), ("b", 2, "2024-01-02", 1))
    source = rows(spark, ("b", 2, "2024-01-02", 9), ("c", 3, "2024-01-03", 9))
    merged = merge_upsert(target, source, ["k"])
    assert [(r[0], r[3]) for r in content(merged)] == [("a", 1), ("b", 9), ("c", 9)]
    assert content(merge_upsert(merged, source, ["k"])) == content(merged)


def test_repeated_source_keys_are_refused(spark):
    source = rows(spark, ("b", 2, "2024-01-02", 9), ("b", 2, "2024-01-02", 8))
    with pytest.raises(DuplicateMergeKeys, match="b"):
        merge_upsert(source.limit(0), source, ["k"])
    require_unique(source.limit(1), ["k"])


def test_cutoff_of_an_empty_target(spark):
    nothing = rows(spark)
    assert cutoff(nothing, "d").first()[0] is None
    assert cutoff_value(nothing, "d", when_empty=dt.date(1900, 1, 1)) == dt.date(1899, 12, 25)


def test_order_item_increment_keeps_the_boundary_day(spark):
    orders = b.orders(
        spark,
        (1, 1, "2024-01-31"),
        (2, 1, "2024-01-24"),
        (3, 1, "2024-01-23"),
        (4, 1, "2024-02-02"),
    )
    items = gold.int_order_items(
        orders, b.lines(spark, *[(o, 1, None, None, None) for o in (1, 2, 3, 4)])
    )
    target = gold.fct_order_items(items).filter("order_key = 1")
    chosen = gold.order_items_increment(items, target)
    assert sorted(r.order_key for r in chosen.collect()) == [1, 2, 4]
    wider = gold.order_items_increment(items, target, lookback_days=8)
    assert wider.count() == 4
    assert gold.order_items_increment(items, target.limit(0)).count() == 0


def shipment_case(spark):
    orders = b.orders(spark, *[(o, 1, "2024-01-01") for o in (1, 2, 3, 4)])
    lines = b.lines(
        spark,
        (1, 1, "2024-03-01", "2024-03-02", "2024-03-03"),
        (2, 1, "2024-01-01", "2024-01-02", "2024-01-03"),
        (3, 1, "2024-01-01", "2024-01-02", "2024-01-03"),
        (4, 1, "2024-03-01", "2024-03-02", "2024-03-03"),
    )
    customers = b.customers(spark, (1, "BUILDING"))
    shipped = silver.int_shipment_events(orders, lines, customers)
    policy = gold.dim_sla_policy(customers)
    return shipped, policy


def test_shipment_refresh_takes_recent_and_impossible_lines(spark):
    shipped, policy = shipment_case(spark)
    known = gold.fct_shipment_events(shipped.filter("order_key < 4"), policy)
    target = known.withColumn(
        "days_since_prior_event",
        F.when((F.col("order_key") == 3) & (F.col("event_type") == "SHIP"), -1).otherwise(
            F.col("days_since_prior_event")
        ),
    )
    chosen = gold.shipments_to_refresh(shipped, gold.shipment_refresh_keys(target))
    assert sorted(r.order_key for r in chosen.collect()) == [1, 3]
    wider = gold.shipments_to_refresh(
        shipped, gold.shipment_refresh_keys(target, new_from=shipped)
    )
    assert sorted(r.order_key for r in wider.collect()) == [1, 3, 4]
    # An empty target offers no keys, so nothing is loaded.
    assert gold.shipment_refresh_keys(target.limit(0)).count() == 0
    assert gold.shipment_refresh_keys(target.limit(0), new_from=shipped).count() == 4


def test_stored_merge_moves_rows_between_months(spark, folder):
    path = f"{folder}/fact"
    target = rows(
        spark,
        ("a", 1, "2024-01-05", 1),
        ("b", 2, "2024-02-05", 1),
        ("c", 3, "2024-02-06", 1),
        ("d", 4, "2024-03-01", 1),
        ("e", 5, None, 1),
    )
    write_clustered(target, path, LAYOUT)
    source = rows(
        spark,
        # January is left empty, an undated row gets a date, one loses it.
        ("a", 1, "2024-04-01", 2),
        ("e", 5, "2024-02-01", 2),
        ("d", 4, None, 2),
        ("f", 6, "2024-02-07", 2),
    )
    expected = [
        ("a", 1, "2024-04-01", 2),
        ("b", 2, "2024-02-05", 1),
        ("c", 3, "2024-02-06", 1),
        ("d", 4, "None", 2),
        ("e", 5, "2024-02-01", 2),
        ("f", 6, "2024-02-07", 2),
    ]
    merged = merge_fact(spark, path, source, LAYOUT)
    assert content(merged) == expected
    # Once more: same rows in, same rows out, nothing left behind.
    assert content(merge_fact(spark, path, source, LAYOUT)) == expected
    merged = merge_fact(spark, path, source.limit(0), LAYOUT)
    assert content(merged) == expected
    months = {str(r.m) for r in merged.select("m").distinct().collect()}
    assert months == {"None", "2024-02-01", "2024-04-01"}


def test_stored_merge_leaves_other_months_alone(spark, folder):
    path = f"{folder}/fact"
    write_clustered(
        rows(spark, ("a", 1, "2024-01-05", 1), ("b", 2, "2024-02-05", 1)), path, LAYOUT
    )
    january = spark.read.parquet(f"{path}/m=2024-01-01").inputFiles()
    merge_fact(spark, path, rows(spark, ("b", 2, "2024-02-06", 2)), LAYOUT)
    assert spark.read.parquet(f"{path}/m=2024-01-01").inputFiles() == january


def test_stored_merge_refuses_repeated_keys_before_touching_the_fact(spark, folder):
    path = f"{folder}/fact"
    write_clustered(rows(spark, ("a", 1, "2024-01-05", 1)), path, LAYOUT)
    twice = rows(spark, ("a", 1, "2024-01-05", 2), ("a", 1, "2024-01-06", 3))
    with pytest.raises(DuplicateMergeKeys):
        merge_fact(spark, path, twice, LAYOUT)
    assert content(read_fact(spark, path, LAYOUT, twice.schema)) == [("a", 1, "2024-01-05", 1)]


def test_failed_publishing_keeps_the_staged_months(spark, folder, monkeypatch):
    path = f"{folder}/fact"
    write_clustered(rows(spark, ("a", 1, "2024-01-05", 1), ("b", 2, "2024-01-06", 1)), path, LAYOUT)

    def fail(*args):
        raise OSError("disk lost")

    monkeypatch.setattr(merge, "publish_months", fail)
    source = rows(spark, ("a", 1, "2024-02-05", 2))
    with pytest.raises(OSError) as problem:
        merge_fact(spark, path, source, LAYOUT)
    (note,) = problem.value.__notes__
    kept = re.search(r"kept in (\S+) ", note)[1]
    staged = read_fact(spark, kept, LAYOUT, source.schema)
    months = {dt.date(2024, 1, 1), dt.date(2024, 2, 1)}
    storage.publish_months(spark, staged, path, LAYOUT, months)
    assert content(read_fact(spark, path, LAYOUT, source.schema)) == [
        ("a", 1, "2024-02-05", 2),
        ("b", 2, "2024-01-06", 1),
    ]
    storage.drop_scratch(spark, kept)


def test_only_scratch_paths_are_removed(spark, folder):
    with pytest.raises(ValueError, match="not a scratch path"):
        storage.drop_scratch(spark, folder)


def test_cutoff_of_a_stored_fact_reads_the_newest_month(spark, folder):
    path = f"{folder}/fact"
    stored = write_clustered(
        rows(spark, ("a", 1, "2024-01-05", 1), ("b", 2, "2024-02-05", 1), ("c", 3, None, 1)),
        path,
        LAYOUT,
    )
    assert cutoff_value(stored, "d", month="m") == dt.date(2024, 1, 29)
    assert cutoff_value(stored.limit(0), "d", month="m") is None


def test_merging_the_rest_equals_a_full_build(spark, small, folder):
    from builders import keyed
    from stratamart.catalog import staging

    t = staging(spark, small)
    items = gold.int_order_items(t["stg_tpch_orders"], keyed(t["stg_tpch_line_items"]))
    full = gold.fct_order_items(items).cache()
    path, layout = f"{folder}/fact", gold.ORDER_ITEM_LAYOUT
    target = write_clustered(full.filter("order_date <= '2001-06-30'"), path, layout)
    assert target.count() == 4488
    recent = gold.order_items_increment(items, target, month=layout.month)
    assert recent.count() == 122
    merged = merge_fact(spark, path, recent, layout).drop(layout.month)
    assert merged.count() == 4599
    assert merged.exceptAll(full).count() == 0 and full.exceptAll(merged).count() == 0
    net = merged.agg(F.sum("net_item_sales_amount")).first()[0]
    assert net == Decimal("230052389.8810")
    full.unpersist()


@pytest.fixture
def large_scale(spark, monkeypatch):
    """Treat small partitions as if they were large ones."""
    monkeypatch.setattr(storage, "FILE_BYTES", "64k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_clustered_files_are_sorted_by_day_and_key(spark, folder, large_scale):
    span = spark.range(20_000).select(
        F.col("id").cast("string").alias("k"),
        (F.col("id") % 7).alias("o"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 25).cast("int")).alias("d"),
        F.lit(1).alias("v"),
    )
    stored = write_clustered(span, f"{folder}/fact", LAYOUT)
    assert stored.count() == 20_000
    files = stored.inputFiles()
    assert len(files) > 1
    for file in files:
        rows_of_file = [(r.d, r.o) for r in spark.read.parquet(file).collect()]
        assert rows_of_file == sorted(rows_of_file)


def test_files_of_a_month_hold_different_days(spark, folder, large_scale):
    """Two months of which one day is larger than all others together."""
    day = "cast(if(id % 2 = 0, date'2024-01-09', date_add(date'2024-01-01', cast(id % 59 as int))) as date)"
    span = spark.range(60_000).selectExpr("uuid() k", "id o", f"{day} d", "cast(id as int) v")
    span = span.union(span.limit(50).selectExpr("k", "o", "null", "v"))
    # As a build sets them: so many tasks that one is smaller than a file.
    tasks = 256
    with storage.settings(spark, {"spark.sql.shuffle.partitions": str(tasks)}):
        stored = write_clustered(span, f"{folder}/fact", LAYOUT)
    held = (
        stored.select("d", F.input_file_name().alias("file"), F.pmod(F.hash("d"), F.lit(tasks)).alias("task"))
        .groupBy("d", "task")
        .agg(F.collect_set("file").alias("files"))
        .collect()
    )
    hot = next(row for row in held if row.d == b.day("2024-01-09"))
    assert len(held) == 60 and len(hot.files) > 2
    # A day has one file, unless it came to the task of a day that needs several.
    others = [row for row in held if row.task != hot.task]
    assert len(others) > 30 and all(len(row.files) == 1 for row in others)
    assert len({row.files[0] for row in others if row.d and row.d.month == 1}) > 1


def test_one_repeated_row_is_spread_over_several_files(spark, folder, large_scale):
    copies = spark.range(0, 400_000, 1, 8).select(
        F.md5(F.least(F.col("id"), F.lit(0)).cast("string")).alias("k"),
        F.least(F.col("id"), F.lit(0)).alias("o"),
        F.lit(dt.date(2024, 1, 1)).alias("d"),
        F.lit(1).alias("v"),
    )
    stored = write_clustered(copies, f"{folder}/fact", LAYOUT)
    counts = [r[1] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert sum(counts) == 400_000 and len(counts) > 1 and max(counts) < 300_000


def test_clustering_computes_the_rows_once(spark, small):
    from stratamart.catalog import order_items, staging

    text = plan(storage.clustered(order_items(staging(spark, small)), gold.ORDER_ITEM_LAYOUT))
    assert "REBALANCE_PARTITIONS_BY_COL" in text and "rangepartitioning" not in text


# Finding the months, publishing, and replacing whole tables


def test_months_are_found_without_moving_or_scanning_the_fact(spark, folder, monkeypatch):
    path, layout = f"{folder}/fact", gold.ORDER_ITEM_LAYOUT
    from stratamart.catalog import order_items, staging

    fact = order_items(staging(spark, "/root/testdata/sf0.001"))
    monkeypatch.setattr(line_months, "ROWS_PER_BUCKET", 1000)
    write_clustered(fact, path, layout)
    where, buckets = line_months.build_table(spark, path, layout, fact.schema)
    assert buckets > 1 and line_months.find_table(spark, path) == (where, buckets)
    recent = storage.rebuild_table(
        layout.with_month(fact.filter("order_date > '2001-06-01'")), f"{folder}/rows"
    )
    columns = recent.select(*line_months.columns_of(layout)).schema
    with (
        storage.settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}),
        line_months.registered(spark, where, buckets, layout, columns) as name,
    ):
        for found in (
            line_months.rewritten_months(spark.table(name), recent, layout),
            line_months.new_lines(spark.table(name), recent, layout),
        ):
            text = plan(found, "simple")
            known, other = [
                part for part in re.split(r"\n[ :]*[+:]- Sort ", text) if "FileScan" in part
            ][:2]
            if "Bucketed: true" not in known:
                known, other = other, known
            assert "Bucketed: true" in known and "Exchange" not in known.split("FileScan")[0]
            assert "Exchange hashpartitioning(order_key" in other
            assert "fact/order_month" not in text
        months = line_months.rewritten_months(spark.table(name), recent, layout).collect()
        assert {r[0] for r in months} == storage.months_of(recent, layout)
        assert line_months.new_lines(spark.table(name), recent, layout).count() == 0


def test_line_months_follow_the_fact_through_many_merges(spark, folder, monkeypatch):
    """Against a dictionary, with lines that move, undated rows, and buckets written anew."""
    draw = random.Random(6)
    monkeypatch.setattr(line_months, "MOST_FILES", 2)
    path, expected = f"{folder}/fact", {}
    write_clustered(rows(spark), path, LAYOUT)
    for _ in range(6):
        some = {}
        for o in draw.sample(range(12), 4):
            day = draw.choice([None, "2024-01-05", "2024-02-07", "2024-03-09", "2024-03-10"])
            some[str(o)] = (str(o), o, day, draw.randint(0, 99))
        merged = merge_fact(spark, path, rows(spark, *some.values()), LAYOUT)
        expected |= some
        assert content(merged) == sorted((k, o, str(d), v) for k, o, d, v in expected.values())
        months = {n for n in folders.names(spark, path) if n.startswith("m=")}
        filled = {storage.month_folder(LAYOUT, m) for m in storage.months_of(merged, LAYOUT)}
        assert months == filled
    where, buckets = line_months.find_table(spark, path)
    files = [f for f in folders.names(spark, where) if f.startswith("part-")]
    assert len(files) <= 2 * buckets + buckets
    with line_months.registered(
        spark, where, buckets, LAYOUT, merged.select(*line_months.columns_of(LAYOUT)).schema
    ) as name:
        known = {tuple(r) for r in spark.table(name).collect()}
    assert {(r.o, r.m) for r in merged.collect()} <= known


class Lost(OSError):
    pass


def failing_after(monkeypatch, moves):
    """The next moves of folders work, the one after them does not."""
    whole, left = folders.move, [moves]

    def move(*args):
        if not left[0]:
            raise Lost
        left[0] -= 1
        whole(*args)

    monkeypatch.setattr(folders, "move", move)


@pytest.mark.parametrize("moves", range(5))
def test_interrupted_publishing_is_finished_by_the_next_merge(spark, folder, monkeypatch, moves):
    path = f"{folder}/fact"
    write_clustered(
        rows(
            spark,
            ("a", 1, "2024-01-05", 1),
            ("b", 2, "2024-02-05", 1),
            ("c", 3, "2024-03-05", 1),
        ),
        path,
        LAYOUT,
    )
    source = rows(spark, ("a", 1, "2024-02-06", 2), ("b", 2, "2024-04-01", 2))
    line_months.build_table(spark, path, LAYOUT, source.schema)
    whole = storage.write_clustered

    def staged_then_failing(*args):
        done = whole(*args)
        failing_after(monkeypatch, moves)
        return done

    monkeypatch.setattr(merge, "write_clustered", staged_then_failing)
    failed = False
    try:
        merge_fact(spark, path, source, LAYOUT)
    except Lost:
        failed = True
    monkeypatch.undo()
    assert failed == (moves < 4)
    expected = [
        ("a", 1, "2024-02-06", 2),
        ("b", 2, "2024-04-01", 2),
        ("c", 3, "2024-03-05", 1),
    ]
    assert content(merge_fact(spark, path, source.limit(0), LAYOUT)) == expected
    assert content(merge_fact(spark, path, source, LAYOUT)) == expected
    assert not {storage.PUBLISHING, storage.REPLACED} & set(folders.names(spark, path))


def test_a_failed_rebuild_leaves_the_old_table(spark, folder):
    path = f"{folder}/t"
    storage.rebuild_table(spark.range(5), path)
    bad = spark.range(5).withColumn("id", F.expr("if(id = 3, raise_error('lost'), id)").cast("long"))
    with pytest.raises(Exception, match="lost"):
        storage.rebuild_table(bad, path)
    assert storage.load_if_exists(spark, path).count() == 5
    with pytest.raises(Exception, match="lost"):
        write_clustered(bad.selectExpr("'k' k", "id o", "date'2024-01-01' d", "1 v"), path, LAYOUT)
    assert storage.load_if_exists(spark, path).count() == 5
    # A table may be replaced by rows that are read from it.
    twice = storage.load_if_exists(spark, path)
    assert storage.rebuild_table(twice.unionAll(twice), path).count() == 10


@pytest.mark.parametrize("moves, rows_found", [(0, 5), (1, 7)])
def test_an_interrupted_switch_is_finished(spark, folder, monkeypatch, moves, rows_found):
    path = f"{folder}/t"
    storage.rebuild_table(spark.range(5), path)
    failing_after(monkeypatch, moves)
    with pytest.raises(Lost):
        storage.rebuild_table(spark.range(7), path)
    monkeypatch.undo()
    assert storage.load_if_exists(spark, path).count() == rows_found
    assert storage.rebuild_table(spark.range(9), path).count() == 9
    assert folders.names(spark, folder) == ["t"]


def test_the_newest_month_comes_from_the_listing(spark, folder):
    path = f"{folder}/fact"
    stored = write_clustered(
        rows(spark, ("a", 1, "2024-01-05", 1), ("b", 2, "2024-02-05", 1), ("c", 3, None, 1)),
        path,
        LAYOUT,
    )
    # A month that has become empty has no say.
    stored.limit(0).drop("m").coalesce(1).write.parquet(f"{path}/m=2024-07-01")
    stored = read_fact(spark, path, LAYOUT, rows(spark).schema)
    assert merge._newest_first(stored, "m", path) == merge._newest_first(stored, "m", None)
    tracker, group = spark.sparkContext.statusTracker(), "listing"
    spark.sparkContext.setJobGroup(group, "")
    assert merge._newest_first(stored, "m", path)[0] == dt.date(2024, 7, 1)
    assert not tracker.getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    for where in (path, None):
        assert cutoff_value(stored, "d", month="m", path=where) == dt.date(2024, 1, 29)


def test_an_increment_opens_recent_months_and_filters_lines(spark, small, folder):
    from stratamart.catalog import order_items, staging

    t = staging(spark, small)
    orders = write_clustered(t["stg_tpch_orders"], f"{folder}/orders", gold.ORDERS_LAYOUT)
    lines = storage.rebuild_table(t["stg_tpch_line_items"], f"{folder}/lines")
    start = dt.date(2001, 7, 10)
    wide = {"spark.sql.autoBroadcastJoinThreshold": "-1", **gold.RECENT_KEYS}
    with storage.settings(spark, wide):
        found = gold.recent_order_items(orders, lines, start)
        text = plan(found)
        months = text.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
        assert "order_month" in months and "2001-07-01" in months
        assert "might_contain" in text
        target = order_items(t).filter("order_date < '2001-07-17'")
        newest = target.agg(F.max("order_date")).first()[0]
        increment = gold.order_items_increment(
            lambda day: gold.recent_order_items(orders, lines, day),
            gold.ORDER_ITEM_LAYOUT.with_month(target),
        )
        expected = order_items(t).filter(F.col("order_date") >= F.lit(newest - dt.timedelta(7)))
        assert increment.exceptAll(expected).count() == 0 < expected.count()
        assert expected.exceptAll(increment).count() == 0
    assert gold.recent_order_items(orders, lines, None).count() == 0

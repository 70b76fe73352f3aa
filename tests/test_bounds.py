"""What a task, a shuffle and the disk hold must not grow faster than the input."""

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratamart import catalog
from stratamart.operators import folders, line_months, storage
from stratamart.operators.quality import SMALL_TASKS, check_metrics, relationship, unique
from stratamart.plans import build

RELEASED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PARTITIONS = "spark.sql.shuffle.partitions"


def test_partitions_follow_the_size_of_the_input(spark, small, monkeypatch):
    monkeypatch.setattr(build, "stored_bytes", lambda *_: 1 << 30)
    before = spark.conf.get(PARTITIONS), spark.conf.get(RELEASED)
    with build.sized_session(spark, small):
        assert int(spark.conf.get(PARTITIONS)) >= 128
        assert spark.conf.get(RELEASED) == "true"
    assert (spark.conf.get(PARTITIONS), spark.conf.get(RELEASED)) == before


@pytest.mark.parametrize("query", ["merge_order_items", "merge_shipment_events"])
def test_merges_deal_narrow_rows_and_leave_only_the_fact(spark, small, monkeypatch, query):
    """No digest or text key goes through the shuffle of the first load."""
    dealt, paths = [], []

    def write(df, path, layout, derive=None):
        if derive is not None:
            dealt.append((df.columns, spark.conf.get(RELEASED)))
        return storage.write_clustered(df, path, layout, derive)

    def place(session, purpose):
        paths.append(storage.scratch_path(session, purpose))
        return paths[-1]

    monkeypatch.setattr(catalog, "write_clustered", write)
    monkeypatch.setattr(catalog, "scratch_path", place)
    assert catalog.QUERIES[query](spark, small).count() > 0
    (columns, released), = dealt
    assert released == "true" and not {"customer_sk", "merge_key"} & set(columns)
    assert sum(folders.exists(spark, p) for p in paths) == 1


def test_tables_are_stored_with_an_entropy_coder(spark, folder):
    digests = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("k"))
    storage.rebuild_table(digests, f"{folder}/t")
    assert build.stored_bytes(spark, f"{folder}/t") < 20_000 * 24


def test_a_task_sorts_a_bounded_part_of_a_fact():
    assert int(storage.FILE_BYTES.removesuffix("m")) <= 64


def test_checks_run_in_small_tasks(spark, small, monkeypatch):
    seen = []

    def keep(model, name):
        seen.append({c: spark.conf.get(c) for c in SMALL_TASKS})
        return storage.rebuild_table(model, storage.scratch_path(spark, name))

    monkeypatch.setattr(catalog, "stored", keep)
    assert catalog.QUERIES["check_unique_combination"](spark, small).count() == 4
    assert seen == [SMALL_TASKS]


def test_digests_travel_as_bytes_and_stay_apart_from_other_texts(spark):
    digest = "0123456789abcdef" * 2
    texts = [digest, digest.upper(), digest, "x" * 32, "", None, None, digest[:30]]
    child = spark.createDataFrame([(t,) for t in texts], "k string")
    parent = spark.createDataFrame([(digest,), ("",)], "p string")
    declared = unique("c", "k") + relationship("c", "k", "p", "p")
    metrics = check_metrics({"c": child, "p": parent}, declared, "s")
    assert {(r.check_name, r.n_rows, r.n_bad) for r in metrics.collect()} == {
        ("unique", 8, 1),
        ("relationships", 8, 3),
    }
    assert "unhex" in metrics._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("query", ["clustered_write", "merge_order_items"])
def test_order_items_are_sorted_as_narrow_rows(spark, small, monkeypatch, query):
    """Digests and text keys are computed above the sort, which the writer takes as it is."""
    plans, stored = [], []

    def write(df, path, layout, derive=None):
        plans.append(storage.clustered(df, layout, derive)._jdf.queryExecution().sparkPlan().toString())
        stored.append((storage.write_clustered(df, path, layout, derive), layout))
        return stored[-1][0]

    monkeypatch.setattr(catalog, "write_clustered", write)
    assert catalog.QUERIES[query](spark, small).count() > 0
    (plan,), ((fact, layout),) = plans, stored
    assert plan.index("Sort [") > plan.rindex("md5(")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    # Above the join's own sorts there is one only.
    assert plan[: plan.index("REBALANCE")].count("Sort [") == 1
    if query == "clustered_write":
        number = F.monotonically_increasing_id().alias("i")
        in_files = fact.select(F.input_file_name().alias("f"), number, layout.day, layout.cluster_key)
        before = Window.partitionBy("f").orderBy("i")
        last = in_files.withColumn("last", F.lag(F.struct(layout.day, layout.cluster_key)).over(before))
        assert last.where(F.col("last") > F.struct(layout.day, layout.cluster_key)).count() == 0


LAYOUT = storage.FactLayout(key=("o", "n"), day="d", month="m", line=("o", "n"), cluster_key="o")


def some_days(spark):
    """Rows of 30 months, and some without a day."""
    day = "if(id % 50 = 0, null, date_add(date'2020-01-01', cast(id % 900 as int)))"
    return spark.range(5_000).selectExpr("id div 4 o", "cast(id % 4 as int) n", f"{day} d")


def test_passes_deal_every_month_once(spark, folder, monkeypatch):
    """A pass shuffles its own months only, and the table is whole."""
    dealt, clustered = [], storage.clustered

    def watch(rows, *more):
        dealt.append(storage.months_of(LAYOUT.with_month(rows), LAYOUT))
        return clustered(rows, *more)

    monkeypatch.setattr(storage, "clustered", watch)
    rows = some_days(spark)
    stored = storage.write_clustered(rows, f"{folder}/t", replace(LAYOUT, passes=7))
    assert len(dealt) == 7 and max(map(len, dealt)) <= 6
    assert sum(map(len, dealt)) == len(set.union(*dealt)) == 31
    assert Counter(stored.drop("m").collect()) == Counter(rows.collect())


def test_a_table_of_which_passes_are_missing_is_none(spark, folder, monkeypatch):
    passes, clustered = [], storage.clustered

    def stop(*given):
        passes.append(given)
        if len(passes) == 3:
            raise RuntimeError("stopped")
        return clustered(*given)

    monkeypatch.setattr(storage, "clustered", stop)
    layout = replace(LAYOUT, passes=3)
    with pytest.raises(RuntimeError, match="stopped"):
        storage.write_clustered(some_days(spark), f"{folder}/t", layout)
    assert storage.load_if_exists(spark, f"{folder}/t") is None
    assert storage.write_clustered(some_days(spark), f"{folder}/t", layout).count() == 5_000


def test_shipment_merge_is_the_same_in_passes(spark, small, monkeypatch):
    seen = []

    def write(df, path, layout, derive=None):
        seen.append((layout.passes, path))
        return storage.write_clustered(df, path, layout, derive)

    expected = Counter(catalog.QUERIES["merge_shipment_events"](spark, small).collect())
    monkeypatch.setattr(catalog, "write_clustered", write)
    monkeypatch.setattr(catalog, "passes_over", lambda size: 5 if size else 0)
    merged = catalog.QUERIES["merge_shipment_events"](spark, small)
    assert Counter(merged.collect()) == expected
    assert [passes for passes, _ in seen] == [5]


def test_a_merge_key_of_several_columns_needs_no_column_of_its_own(spark, small, monkeypatch):
    facts = []
    write = storage.write_clustered
    monkeypatch.setattr(catalog, "write_clustered", lambda *a, **k: facts.append(write(*a, **k)) or facts[-1])
    assert catalog.QUERIES["merge_shipment_events"](spark, small).count() > 0
    assert "merge_key" not in facts[0].columns and len(facts[0].columns) == 18


def test_line_months_are_sorted_and_packed_and_the_same_in_passes(spark, folder, monkeypatch):
    fact = storage.write_clustered(some_days(spark), f"{folder}/t", LAYOUT)
    monkeypatch.setattr(line_months, "ROWS_OF_FEW", 1_000)
    wanted = Counter(fact.select("o", "n", "m").distinct().collect())
    for rows_of_pass in (5_000, 1_500):
        monkeypatch.setattr(line_months, "ROWS_PER_PASS", rows_of_pass)
        where, buckets = line_months.build_table(spark, f"{folder}/t", LAYOUT, fact.schema)
        assert buckets == 5
        with line_months.registered(spark, where, buckets, LAYOUT, fact.select("o", "n", "m").schema) as name:
            assert Counter(spark.table(name).collect()) == wanted
        files = [n for n in folders.names(spark, where) if n.endswith(".parquet")]
        assert len(files) == buckets and all(".zstd." in n for n in files)
        assert folders.exists(spark, f"{where}/_SUCCESS")
        rows = [tuple(r) for r in spark.read.parquet(f"{where}/{files[0]}").select("o", "n").collect()]
        assert rows == sorted(rows)


def test_line_months_of_which_passes_are_missing_are_not_used(spark, folder, monkeypatch):
    fact = storage.write_clustered(some_days(spark), f"{folder}/t", LAYOUT)
    monkeypatch.setattr(line_months, "ROWS_OF_FEW", 1_000)
    monkeypatch.setattr(line_months, "ROWS_PER_PASS", 1_500)
    passes, dealt = [], line_months._dealt

    def stop(*given):
        passes.append(given)
        if len(passes) % 3 == 0:
            raise RuntimeError("stopped")
        return dealt(*given)

    monkeypatch.setattr(line_months, "_dealt", stop)
    for _ in range(2):
        with pytest.raises(RuntimeError, match="stopped"):
            line_months.build_table(spark, f"{folder}/t", LAYOUT, fact.schema)
        assert line_months.find_table(spark, f"{folder}/t") is None

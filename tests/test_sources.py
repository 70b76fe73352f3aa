import datetime as dt

import pytest
from pyspark.sql import functions as F

from plans_util import plan
from stratamart.plans.build import stored_bytes
from stratamart.sources import (
    SOURCE_COLUMNS,
    MissingColumns,
    read_source,
    read_sources,
    source_freshness,
)


def test_missing_columns_are_an_error_unless_stand_ins_are_asked_for(spark, small):
    with pytest.raises(MissingColumns, match="l_commitdate, l_receiptdate"):
        read_source(spark, small, "lineitem")
    lines = read_source(spark, small, "lineitem", stand_ins=True)
    assert dict(lines.dtypes) == SOURCE_COLUMNS["lineitem"]


def test_stand_ins_do_not_replace_stored_columns(spark, small, folder):
    stored = spark.read.parquet(f"{small}/part.parquet").withColumn("p_mfgr", F.lit("own"))
    stored.write.parquet(f"{folder}/part.parquet")
    parts = read_source(spark, folder, "part", stand_ins=True)
    assert [r.p_mfgr for r in parts.select("p_mfgr").distinct().collect()] == ["own"]


def test_all_sources_have_declared_types(spark, small):
    for name, table in read_sources(spark, small, stand_ins=True).items():
        assert dict(table.dtypes) == SOURCE_COLUMNS[name]


def test_window_reaches_the_scan(spark, small):
    window = ("o_orderdate", dt.date(2000, 1, 1), dt.date(2000, 2, 1))
    orders = read_source(spark, small, "orders", window=window)
    days = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    assert days[0] >= dt.date(2000, 1, 1) and days[1] <= dt.date(2000, 1, 31)
    text = plan(orders.select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01T00:00)" in text
    assert "LessThan(o_orderdate,2000-02-01T00:00)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_freshness_reads_one_column_per_source(spark, small):
    rows = source_freshness(read_sources(spark, small, stand_ins=True))
    assert {r.source for r in rows.collect()} == {"orders", "lineitem"}
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in plan(rows)


def test_stored_bytes_counts_files_of_a_folder(spark, folder):
    assert stored_bytes(spark, _written(spark, folder)) > 0


def _written(spark, folder):
    spark.range(10).write.parquet(f"{folder}/t/orders.parquet")
    return f"{folder}/t"


@pytest.mark.parametrize(
    "header, line, complaint",
    [
        ("order_date,items_cnt,item_discount_amount,gross_item_sales_amount", "2024-01-01,1,2.0,3.0", "header"),
        ("order_date,items_cnt,gross_item_sales_amount,item_discount_amount", "2024-01-01,1,2x0,3.0", "batch.csv"),
    ],
)
def test_swapped_columns_and_damaged_numbers_are_refused(spark, folder, header, line, complaint):
    from stratamart.sources import read_daily_metrics_csv

    def write(*lines):
        with open(f"{folder}/batch.csv", "w") as file:
            file.write("\n".join(lines))
        return read_daily_metrics_csv(spark, f"{folder}/batch.csv")

    good = "order_date,items_cnt,gross_item_sales_amount,item_discount_amount"
    assert write(good, "2024-01-01,1,2.0,3.0", "2024-01-02,,,").count() == 2
    with pytest.raises(Exception, match=complaint):
        write(header, "2023-12-31,5,1.0,1.0", line).collect()

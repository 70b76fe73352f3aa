"""CSV batches handed over for validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DAILY_METRICS_SCHEMA = (
    "order_date date, items_cnt bigint, "
    "gross_item_sales_amount decimal(38,4), item_discount_amount decimal(38,4)"
)


def read_daily_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    """The exported daily metric, read with its declared schema (no inference).

    A header with other names, or the same in another order, is refused; so is a
    line with a value that is not of its column's type. The error names the file.
    """
    return (
        spark.read.schema(DAILY_METRICS_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )

"""Running sums over the rows of a sorted table, without one task seeing all of them.

Rows are dealt by range and sorted, each range is summed, the ranges' sums
(one row per range) are added up in order, and each row gets its range's
offset plus its own sum inside the range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, tasks_for

ROWS_PER_TASK = 500_000


def sorted_ranges(df: DataFrame, order: Sequence[Column], parts: int, purpose: str) -> DataFrame:
    """``df`` stored in sorted ranges, with the number of each row's range as ``range_no``.

    ``order`` should end in columns that tell all rows apart; equal rows are interchangeable.
    """
    dealt = df.repartitionByRange(parts, *order).withColumn("range_no", F.spark_partition_id())
    return stored(dealt.sortWithinPartitions("range_no", *order), purpose)


def running_sums(
    df: DataFrame,
    order: Sequence[Column],
    values: dict[str, str],
    rows: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    purpose: str = "scan",
) -> DataFrame:
    """Adds, for each ``new: column`` of ``values``, the sum of ``column`` over all earlier rows."""
    if rows is None:
        df = stored(df, f"{purpose}-rows")
        rows = df.count()
    ranges = sorted_ranges(df, order, tasks_for(rows, rows_per_task), purpose)
    totals = ranges.groupBy("range_no").agg(
        *[F.sum(column).alias(f"{new}_total") for new, column in values.items()]
    )
    # One row per range: a single task adds these up.
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "range_no",
        *[F.coalesce(F.sum(f"{new}_total").over(before), F.lit(0)).alias(f"{new}_offset") for new in values],
    )
    inside = (
        Window.partitionBy("range_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = ranges.select(
        "*",
        *[
            F.coalesce(F.sum(column).over(inside), F.lit(0)).alias(f"{new}_inside")
            for new, column in values.items()
        ],
    )
    joined = summed.join(F.broadcast(offsets), "range_no")
    return joined.select(
        *df.columns,
        *[
            (F.col(f"{new}_inside") + F.col(f"{new}_offset")).cast("long").alias(new)
            for new in values
        ],
    )

"""Keeping the newest rows of each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Lists up to this length go to their group's task directly: Spark trims every
# group inside the map tasks, which leaves at most this many rows per map task.
DIRECT_LIMIT = 16
# Longer lists are trimmed in ever fewer parts of the group.
PARTS = (4096, 64)


def latest_n_per_group(
    df: DataFrame, group: list[str], newest_first: list[Column], keep: int = 5
) -> DataFrame:
    """The ``keep`` newest rows of every group.

    No task sees more of a group than one part of it, or the survivors of a
    few dozen parts, however many rows the group has.
    """

    def trimmed(rows: DataFrame, keys: list[str | Column]) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*keys).orderBy(*newest_first))
        return rows.withColumn("_rank", rank).filter(F.col("_rank") <= keep).drop("_rank")

    if keep > DIRECT_LIMIT:
        df = df.withColumn("_slice", F.spark_partition_id())
        for parts in PARTS:
            df = trimmed(df, [*group, F.col("_slice") % parts])
        df = df.drop("_slice")
    return trimmed(df, group)

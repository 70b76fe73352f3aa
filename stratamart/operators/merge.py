"""Key-based incremental merge on plain Parquet."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.operators import folders, line_months
from stratamart.operators.storage import (
    NO_MONTH,
    FactLayout,
    drop_scratch,
    finish_publishing,
    in_months,
    months_of,
    publish_months,
    read_fact,
    rebuild_table,
    scratch_path,
    settings,
    write_clustered,
)

LOOKBACK_DAYS = 7
# Fixed value: high-watermark of an empty shipment fact.
EPOCH = dt.date(1900, 1, 1)


class DuplicateMergeKeys(ValueError):
    """The rows to merge hold a key more than once."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    )


def require_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise when a key occurs more than once; a NULL equals no other key."""
    sample = duplicate_keys(df.dropna(subset=keys), keys).limit(5).collect()
    if sample:
        raise DuplicateMergeKeys(f"duplicate {', '.join(keys)}: {[tuple(r) for r in sample]}")


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: list[str], *, check_source: bool = True
) -> DataFrame:
    """Target rows whose key is not in the source, plus all source rows.

    A key with a NULL matches nothing, so its rows are inserted, and inserted
    again when the merge is repeated.

    The source is read twice (keys, rows): hand in a stored or checkpointed
    one when it is expensive to compute.
    """
    if check_source:
        require_unique(source, keys)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.select(*source.columns).unionByName(source)


def cutoff(
    target: DataFrame,
    day: str,
    *,
    lookback_days: int = LOOKBACK_DAYS,
    when_empty: dt.date | None = None,
) -> DataFrame:
    """High-watermark of ``day`` minus the late-data allowance, as one row."""
    newest = F.max(day)
    if when_empty is not None:
        newest = F.coalesce(newest, F.lit(when_empty))
    return target.agg(F.date_sub(newest, lookback_days).alias("cutoff_date"))


def cutoff_value(
    target: DataFrame,
    day: str,
    *,
    lookback_days: int = LOOKBACK_DAYS,
    when_empty: dt.date | None = None,
    month: str | None = None,
    path: str | None = None,
) -> dt.date | None:
    """The cutoff as a literal, so that filters with it prune files.

    With a ``month`` partition column only the newest month that has rows is
    scanned. Which months there are comes from the listing of the fact's
    ``path``, or else from the partitions Spark has listed for ``target``.
    """
    if month is not None:
        for newest in _newest_first(target, month, path):
            rows = target.filter(F.col(month) == F.lit(newest))
            found = cutoff(rows, day, lookback_days=lookback_days).first()[0]
            if found is not None:
                return found
        target = target.limit(0)
    return cutoff(
        target, day, lookback_days=lookback_days, when_empty=when_empty
    ).first()[0]


def _newest_first(target: DataFrame, month: str, path: str | None) -> list[dt.date]:
    """Months that have a folder, without reading any file."""
    spark = target.sparkSession
    if path is not None:
        values = [n.partition("=")[2] for n in folders.names(spark, path) if n.startswith(f"{month}=")]
        found = [dt.date.fromisoformat(v) for v in values if v != NO_MONTH]
    else:
        with settings(spark, {"spark.sql.optimizer.metadataOnly": "true"}):
            rows = target.select(month).distinct().collect()
        found = [row[0] for row in rows if row[0] is not None]
    return sorted(found, reverse=True)


def since(df: DataFrame, day: str, start: dt.date | None) -> DataFrame:
    """Rows on or after ``start``; an unknown start matches nothing."""
    return df.filter(F.lit(False) if start is None else F.col(day) >= F.lit(start))


def merge_fact(
    spark: SparkSession, path: str, source: DataFrame, layout: FactLayout
) -> DataFrame:
    """Merge rows into a stored fact, reading and rewriting only the months concerned.

    These are the months of the new rows and the months in which older copies
    of their keys live, since a changed date may move a row. The latter come
    from the fact's table of line months, which is written on the first merge
    if the fact has none. Rows with a NULL key replace nothing. New rows and
    rewritten months are written to the shared folder before the fact is
    touched; a publication that stopped half-way is finished first.
    """
    finish_publishing(spark, path)
    rows_path = scratch_path(spark, "merge-rows")
    months_path = scratch_path(spark, "merge-months")
    try:
        rows = rebuild_table(layout.with_month(source), rows_path)
        require_unique(rows, layout.keys)
        target = read_fact(spark, path, layout, source.schema)
        months = _months_concerned(spark, path, rows, layout, source)
        if months:
            merged = merge_upsert(
                target.filter(in_months(layout, months)), rows, layout.keys, check_source=False
            )
            staged = write_clustered(merged.drop(layout.month), months_path, layout)
            _publish(spark, staged, path, layout, months, months_path)
    finally:
        drop_scratch(spark, rows_path)
    return read_fact(spark, path, layout, source.schema)


def _months_concerned(
    spark: SparkSession, path: str, rows: DataFrame, layout: FactLayout, source: DataFrame
) -> set[dt.date | None]:
    """The months to rewrite; the new lines are noted before the fact changes."""
    folder, buckets = line_months.find_table(spark, path) or line_months.build_table(
        spark, path, layout, source.schema
    )
    columns = rows.select(*line_months.columns_of(layout)).schema
    with line_months.registered(spark, folder, buckets, layout, columns) as name:
        old = line_months.rewritten_months(spark.table(name), rows, layout)
        months = months_of(rows.select(layout.month).union(old), layout)
        line_months.add_lines(spark, name, folder, buckets, rows, layout)
    return months


def _publish(
    spark: SparkSession,
    staged: DataFrame,
    path: str,
    layout: FactLayout,
    months: set[dt.date | None],
    staged_path: str,
) -> None:
    """Publish, and keep the staged rows when that fails: they may be the only copy."""
    try:
        publish_months(spark, staged, path, layout, months, staged_path)
    except Exception as problem:
        problem.add_note(
            f"{path} may lack months; repeat publish_months with the rows kept in {staged_path} "
            f"and the months {sorted(map(str, months))}"
        )
        raise
    drop_scratch(spark, staged_path)

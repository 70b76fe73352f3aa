"""Which months of a stored fact hold a line: a narrow table beside the fact.

It has one row per line and month, hashed into buckets by the fact's cluster
key, and lies in the fact's folder under a name that readers skip. A merge
finds the months it must rewrite by joining its rows to this table, bucket by
bucket, so the fact itself is read only in those months, and the table is not
moved. Lines are added before the fact changes and never taken out, so a line
that has moved may name a month too many, which costs that month's rewriting
and nothing else. When appended files have become many, each bucket is written
anew without repeated rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.operators import folders
from stratamart.operators.storage import (
    MARKED,
    PACKED,
    FactLayout,
    passes_over,
    read_fact,
    replacing,
    settings,
)

FOLDER = "_lines-"  # followed by the number of buckets
ROWS_PER_BUCKET = 4_000_000
FEW_BUCKETS, ROWS_OF_FEW = 8, 50_000  # a small table is written side by side all the same
MOST_BUCKETS = 10_000
MOST_FILES = 16  # of a bucket, before they are written anew
ROWS_PER_PASS = 32_000_000  # of the fact, when the table is first written

# Rows that agree in the bucket column lie in the same task, which is enough for joins on more columns.
BUCKET_JOINS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.bucketing.enabled": "true",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


def bucket_column(layout: FactLayout) -> str:
    return layout.cluster_key if layout.cluster_key in layout.line else layout.line[0]


def columns_of(layout: FactLayout) -> list[str]:
    return [*layout.line, layout.month]


def find_table(spark: SparkSession, path: str) -> tuple[str, int] | None:
    """The folder of a fact's line months and their number of buckets."""
    for name in folders.names(spark, path):
        if name.startswith(FOLDER):
            return f"{path}/{name}", int(name.removeprefix(FOLDER))
    return None


@contextmanager
def registered(
    spark: SparkSession,
    folder: str,
    buckets: int,
    layout: FactLayout,
    schema: T.StructType,
    *,
    marked: bool = True,
) -> Iterator[str]:
    """The table under a name of its own, which tells Spark of the buckets.

    Files are sorted by line, which makes them shorter. Rows written to a table
    that is not ``marked`` leave it unfinished.
    """
    name = f"line_months_{hashlib.md5(folder.encode()).hexdigest()}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = folder.replace("\\", "\\\\").replace("'", "\\'")
    options = ", ".join(f"'{k}' '{v}'" for k, v in {**PACKED, MARKED: str(marked).lower()}.items())
    order = ", ".join(f"`{c}`" for c in dict.fromkeys([bucket_column(layout), *layout.line]))
    spark.sql(f"drop table if exists {name}")
    spark.sql(
        f"create table {name} ({fields}) using parquet options ({options}) "
        f"clustered by (`{bucket_column(layout)}`) sorted by ({order}) into {buckets} buckets "
        f"location '{place}'"
    )
    try:
        with settings(spark, BUCKET_JOINS):
            yield name
    finally:
        spark.sql(f"drop table if exists {name}")


def _dealt(lines: DataFrame, buckets: int, layout: FactLayout) -> DataFrame:
    """Rows without repetition, one task per bucket."""
    return lines.repartition(buckets, bucket_column(layout)).dropDuplicates(columns_of(layout))


def build_table(
    spark: SparkSession, path: str, layout: FactLayout, schema: T.StructType
) -> tuple[str, int]:
    """Write the line months of a stored fact, from a narrow scan of it for every pass over the buckets."""
    lines = read_fact(spark, path, layout, schema).select(*columns_of(layout))
    n = lines.count()
    few = min(FEW_BUCKETS, -(-n // ROWS_OF_FEW))
    buckets = max(1, few, min(MOST_BUCKETS, -(-n // ROWS_PER_BUCKET)))
    folder = f"{path}/{FOLDER}{buckets}"
    with replacing(spark, folder) as following:
        # An empty fact leaves an empty folder behind.
        folders.write_text(spark, f"{following}/_started", "")
        passes = min(buckets, passes_over(n, ROWS_PER_PASS))
        bucket = F.pmod(F.hash(bucket_column(layout)), F.lit(buckets))
        for number in range(passes):
            last, some = number == passes - 1, lines.filter(bucket % passes == number)
            with registered(spark, following, buckets, layout, lines.schema, marked=last) as name:
                _dealt(lines if passes == 1 else some, buckets, layout).write.insertInto(name)
    return folder, buckets


def rewritten_months(known: DataFrame, rows: DataFrame, layout: FactLayout) -> DataFrame:
    """Months in which lines of ``rows`` live already; ``known`` stays where it is."""
    lines = list(layout.line)
    return known.join(rows.select(*lines), lines, "left_semi").select(layout.month).distinct()


def new_lines(known: DataFrame, rows: DataFrame, layout: FactLayout) -> DataFrame:
    """Lines with months of ``rows`` that ``known`` lacks."""
    columns = columns_of(layout)
    wanted = rows.select(*columns).dropna(subset=list(layout.line))
    same = [wanted[c] == known[c] for c in layout.line]
    same.append(wanted[layout.month].eqNullSafe(known[layout.month]))
    return wanted.join(known, same, "left_anti")


def add_lines(
    spark: SparkSession, name: str, folder: str, buckets: int, rows: DataFrame, layout: FactLayout
) -> None:
    """Append the lines of ``rows`` to the registered table; write its buckets anew when files are many."""
    known = spark.table(name)
    _dealt(new_lines(known, rows, layout), buckets, layout).write.insertInto(name)
    files = [f for f in folders.names(spark, folder) if not f.startswith(("_", "."))]
    if len(files) > MOST_FILES * buckets:
        compact(spark, folder, buckets, layout, known.schema)


def compact(
    spark: SparkSession, folder: str, buckets: int, layout: FactLayout, schema: T.StructType
) -> None:
    """One file per bucket again."""
    with replacing(spark, folder) as following:
        folders.write_text(spark, f"{following}/_started", "")
        with registered(spark, folder, buckets, layout, schema) as known:
            rows = spark.table(known).dropDuplicates(columns_of(layout))
            with registered(spark, following, buckets, layout, schema) as name:
                rows.write.insertInto(name)

"""Writing tables: rebuilds, clustered month layout, staged publishing."""

from __future__ import annotations

import datetime as dt
import json
import posixpath
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.operators import folders

# Size at which adaptive execution cuts the rows of one output file.
ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
FILE_BYTES = "32m"  # as they are shuffled; bounds what a task sorts
# Most of a fact is digests in hexadecimal, which only an entropy coder makes shorter. Pages of the second version keep
# lengths and differences apart from the bytes. Dictionaries may be large and are judged by more rows than the first
# 20,000, so that a key with hundreds of thousands of values is written once in a file and not in every row.
COMPRESSION = "zstd"
PACKED = {
    "compression": COMPRESSION,
    "parquet.writer.version": "v2",
    "parquet.dictionary.page.size": str(16 * 1024 * 1024),
    "parquet.page.row.count.limit": "100000",
}
# A pass over a stored input deals so many bytes of it at least; beyond the most passes they grow with the input.
PASS_BYTES = 64 * 1024 * 1024
MOST_PASSES = 12
# Spark then removes the shuffle files of a job when the job ends, instead of when the driver collects garbage.
RELEASING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Whether a write leaves the file by which an unfinished table is told from a finished one.
MARKED = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
# Fixed value: Spark's folder of rows without a partition value.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
# What a publication in progress keeps in a fact's folder; readers skip such names.
PUBLISHING, REPLACED = "_publishing", "_replaced"


@dataclass(frozen=True)
class FactLayout:
    """How a fact table is keyed and laid out on storage.

    ``key`` is the merge key, of one column or several; several need no column
    that joins them. ``line`` holds the narrower columns it is made from: equal
    keys have equal lines, which is enough to find old copies. Rows are written
    in so many ``passes``, for which they have to come from a stored table.
    """

    key: str | tuple[str, ...]
    day: str
    month: str
    line: tuple[str, ...] = ("order_key", "line_number")
    cluster_key: str = "order_key"
    passes: int = 1

    @property
    def keys(self) -> list[str]:
        return [self.key] if isinstance(self.key, str) else list(self.key)

    def with_month(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.month, F.trunc(self.day, "month"))

    def stored_schema(self, schema: T.StructType) -> T.StructType:
        fields = [f for f in schema.fields if f.name != self.month]
        return T.StructType([*fields, T.StructField(self.month, T.DateType())])


@dataclass(frozen=True)
class ByRow:
    """A derivation that only computes and picks columns: rows keep their order, day and cluster key."""

    columns: Callable[[DataFrame], DataFrame]

    def __call__(self, rows: DataFrame) -> DataFrame:
        return self.columns(rows)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="stratamart-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/stratamart/{purpose}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a path handed out by ``scratch_path``."""
    if not path.startswith(f"{shared_folder(spark)}/stratamart/"):
        raise ValueError(f"not a scratch path: {path}")
    folders.remove(spark, path)


def load_if_exists(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The stored table, or None when nothing has been written there yet.

    A table whose replacement was interrupted between two generations is put back first.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return reader.parquet(path) if recover_table(spark, path) else None
        if problem.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def _generation(path: str, which: str) -> str:
    """Where the next or the previous generation of a table lies: beside it, hidden from readers."""
    folder, name = posixpath.split(path.rstrip("/"))
    return f"{folder}/.{name}.{which}"


def recover_table(spark: SparkSession, path: str) -> bool:
    """Whether there is a table; finishes a replacement that stopped between its two renames."""
    following, previous = _generation(path, "next"), _generation(path, "previous")
    if folders.exists(spark, path):
        return True
    if folders.exists(spark, f"{following}/_SUCCESS"):
        folders.move(spark, following, path)
    elif folders.exists(spark, previous):
        folders.move(spark, previous, path)
    return folders.exists(spark, path)


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """Where to write the next generation of a table.

    It takes the table's place when the block ends well. If the block fails,
    the table stays as it is. The switch is two renames: the table becomes the
    previous generation, the next one becomes the table. If the second fails,
    or the driver stops in between, ``recover_table`` finishes. A reader that
    has listed the old files finds them gone and has to start anew; it never
    sees files of both generations.
    """
    recover_table(spark, path)
    following, previous = _generation(path, "next"), _generation(path, "previous")
    folders.remove(spark, following)
    yield following
    folders.remove(spark, previous)
    if folders.exists(spark, path):
        folders.move(spark, path, previous)
    folders.move(spark, following, path)
    folders.remove(spark, previous)


def rebuild_table(df: DataFrame, path: str) -> DataFrame:
    """Replace a whole table by rows that may be read from it."""
    with replacing(df.sparkSession, path) as following:
        df.write.options(**PACKED).parquet(following)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of one job."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def clustered(
    df: DataFrame, layout: FactLayout, derive: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Rows brought together by day and sorted by day and cluster key.

    A range partitioning would have to compute the rows once more to sample
    them. Rebalancing does not: a day goes to one task, adaptive execution puts
    small tasks together and cuts a task that is larger than a file, even when
    all its rows are alike. So a day lies in one file, until it, or a day dealt
    to the same task, needs several; a build has enough shuffle partitions for
    that (``sized_session``).
    The order inside the files lets scans skip to the days they ask for.
    Columns added by ``derive`` are computed after the shuffle and do not
    travel through it. Those of a ``ByRow`` are computed after the sort too, so
    that a task holds narrow rows only; the month is sorted by its expression,
    by which the writer knows the column added later to be in order.
    """
    rows = df.hint("rebalance", layout.day)
    if isinstance(derive, ByRow):
        month = F.trunc(layout.day, "month")
        return layout.with_month(derive(rows.sortWithinPartitions(month, layout.day, layout.cluster_key)))
    if derive is not None:
        rows = derive(rows)
    return layout.with_month(rows).sortWithinPartitions(
        layout.month, layout.day, layout.cluster_key
    )


def passes_over(size: int, of_pass: int = PASS_BYTES) -> int:
    """In how many passes to work through a stored input, so that the shuffle of one is a small part of the disk."""
    return max(1, min(MOST_PASSES, -(-size // of_pass)))


def _of_pass(df: DataFrame, layout: FactLayout, number: int) -> DataFrame:
    """The rows whose month a pass deals; a month is dealt by one pass, and rows without a day by the first."""
    month = F.coalesce(F.year(layout.day) * 12 + F.month(layout.day), F.lit(0))
    return df if layout.passes == 1 else df.filter(F.pmod(month, F.lit(layout.passes)) == number)


def write_clustered(
    df: DataFrame,
    path: str,
    layout: FactLayout,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Write a fact in month folders, clustered inside, and return it as stored.

    With several passes the rows are computed once for each, and only those of
    its months are shuffled. The table is marked as complete by the last pass.
    """
    spark = df.sparkSession
    with replacing(spark, path) as following, settings(spark, {ADVISORY_SIZE: FILE_BYTES}):
        for number in range(layout.passes):
            rows = clustered(_of_pass(df, layout, number), layout, derive)
            marked = str(number == layout.passes - 1).lower()
            (
                rows.write.mode("append")
                .options(**PACKED, **{MARKED: marked})
                .partitionBy(layout.month)
                .parquet(following)
            )
    return read_fact(spark, path, layout, rows.schema)


def read_fact(
    spark: SparkSession, path: str, layout: FactLayout, schema: T.StructType
) -> DataFrame:
    """A stored fact including its month column."""
    return spark.read.schema(layout.stored_schema(schema)).parquet(path)


def months_of(df: DataFrame, layout: FactLayout) -> set[dt.date | None]:
    """Distinct months; never more than the calendar has."""
    return {row[0] for row in df.select(layout.month).distinct().collect()}


def in_months(layout: FactLayout, months: Iterable[dt.date | None]) -> Column:
    """Partition predicate for a set of months; one of them may be NULL."""
    known = [m for m in months if m is not None]
    condition = F.col(layout.month).isin(known)
    return condition | F.col(layout.month).isNull() if None in months else condition


def month_folder(layout: FactLayout, month: dt.date | None) -> str:
    return f"{layout.month}={NO_MONTH if month is None else month.isoformat()}"


def publish_months(
    spark: SparkSession,
    staged: DataFrame,
    path: str,
    layout: FactLayout,
    rewritten: set[dt.date | None],
    staged_path: str | None = None,
) -> None:
    """Replace the rewritten months of a stored fact by the staged rows.

    Given the folder of the staged rows, and if it lies in the fact's file
    system, their files are moved as they are; what is left of that when it
    fails is done by the next call, or by the next merge. Otherwise the rows
    are written once more. A dynamic overwrite leaves alone a month for which
    there are no rows, so a month that has become empty is then overwritten by
    an empty file of its own. These steps can be repeated from the staged rows.
    """
    if finish_publishing(spark, path):
        return
    if staged_path is not None and folders.same_system(spark, staged_path, path):
        months = {month_folder(layout, month) for month in rewritten}
        present = months & set(folders.names(spark, staged_path))
        plan = {"staged": staged_path, "filled": sorted(present), "emptied": sorted(months - present)}
        folders.write_text(spark, f"{path}/{PUBLISHING}", json.dumps(plan))
        finish_publishing(spark, path)
        return
    (
        staged.sortWithinPartitions(layout.month, layout.day, layout.cluster_key)
        .write.mode("overwrite")
        .options(**PACKED)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(layout.month)
        .parquet(path)
    )
    nothing = spark.createDataFrame([], staged.drop(layout.month).schema)
    for month in rewritten - months_of(staged, layout):
        folder = f"{path}/{month_folder(layout, month)}"
        nothing.coalesce(1).write.mode("overwrite").parquet(folder)


def finish_publishing(spark: SparkSession, path: str) -> bool:
    """Move the months that a started publication has not moved yet; whether there was one.

    The months that are replaced are kept aside until all new ones are in place.
    """
    journal, aside = f"{path}/{PUBLISHING}", f"{path}/{REPLACED}"
    if not folders.exists(spark, journal):
        return False
    plan = json.loads(folders.read_text(spark, journal))
    waiting = set(folders.names(spark, plan["staged"]))
    for folder in plan["filled"] + plan["emptied"]:
        # A filled month that waits no more is in place already.
        if folder in plan["filled"] and folder not in waiting:
            continue
        if folders.exists(spark, f"{path}/{folder}"):
            folders.remove(spark, f"{aside}/{folder}")
            folders.move(spark, f"{path}/{folder}", f"{aside}/{folder}")
        if folder in waiting:
            folders.move(spark, f"{plan['staged']}/{folder}", f"{path}/{folder}")
    folders.remove(spark, journal)
    folders.remove(spark, aside)
    return True

"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stratamart.operators.storage import RELEASING, drop_scratch, scratch_path, settings

# Rows that a task turns into Python objects at a time; bounds its memory with very long texts.
ROWS_AT_A_TIME = 256

# Rows in one Arrow batch between Spark and a Python worker; both sides hold it, outside Spark's memory.
ROWS_OF_A_BATCH = 1024

# Bytes ``0x20 0x09-0x0D``, the white space that ends a word, as a Java and RE2 class.
SPACE = r"\x20\x09-\x0D"


# For each operator that is at work, what it has stored on the way.
_intermediates: list[list[str]] = []


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts its lineage for good."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    if _intermediates:
        _intermediates[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession, *purposes: str) -> None:
    """Remove what the operator at work has stored for these purposes."""
    for path in list(_intermediates[-1] if _intermediates else []):
        if path.rpartition("/")[2].rpartition("-")[0] in purposes:
            drop_scratch(spark, path)
            _intermediates[-1].remove(path)


def tidy(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator on a DataFrame whose result is stored, and whose intermediate tables are then removed.

    What its jobs have shuffled is removed as each of them ends.
    """

    @wraps(operator)
    def run(df: DataFrame, *args, **kwargs) -> DataFrame:
        spark = df.sparkSession
        batches = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(ROWS_OF_A_BATCH)}
        _intermediates.append([])
        try:
            with settings(spark, RELEASING | batches):
                result = operator(df, *args, **kwargs)
                path = scratch_path(spark, operator.__name__)
                result.write.parquet(path)
            for used in _intermediates[-1]:
                drop_scratch(spark, used)
        finally:
            _intermediates.pop()
        if _intermediates:
            _intermediates[-1].append(path)
        return result.sparkSession.read.schema(result.schema).parquet(path)

    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out() -> F.Column:
    """Rows of which no label may be learnt: crc32 of the id as text is a multiple of five."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def map_task(
    df: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]],
    schema: str | T.StructType,
) -> DataFrame:
    """``work`` reads a task's rows in small batches and gives columns by name."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(schema)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = (
            batch.slice(start, ROWS_AT_A_TIME)
            for batch in batches
            for start in range(0, batch.num_rows, ROWS_AT_A_TIME)
        )
        for columns in work(small):
            arrays = []
            for field in arrow:
                values = columns[field.name]
                if not isinstance(values, pa.Array):
                    values = pa.array(values, field.type)
                arrays.append(values if values.type == field.type else values.cast(field.type))
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(over, schema)


def joined_batches(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Small batches put together until they hold so many bytes."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.nbytes
        if size >= most_bytes:
            yield pa.concat_batches(waiting)
            waiting, size = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str | T.StructType
) -> DataFrame:
    """Columns by name for each small batch of input rows."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield work(batch)

    return map_task(df, each, schema)


def tasks_for(rows: int, rows_per_task: int) -> int:
    return max(1, -(-rows // rows_per_task))

"""Parquet readers that give every source table its declared names and types."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions import between_window
from stratamart.sources.stand_ins import STAND_INS

# The source columns in use and their types.
SOURCE_COLUMNS: dict[str, dict[str, str]] = {
    "orders": {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "decimal(15,2)",
        "o_orderdate": "date",
    },
    "lineitem": {
        "l_orderkey": "bigint",
        "l_partkey": "bigint",
        "l_suppkey": "bigint",
        "l_linenumber": "int",
        "l_extendedprice": "decimal(15,2)",
        "l_discount": "decimal(15,2)",
        "l_shipdate": "date",
        "l_commitdate": "date",
        "l_receiptdate": "date",
        "l_returnflag": "string",
        "l_linestatus": "string",
    },
    "customer": {
        "c_custkey": "bigint",
        "c_name": "string",
        "c_mktsegment": "string",
        "c_nationkey": "int",
        "c_acctbal": "decimal(15,2)",
        "c_phone": "string",
        "c_address": "string",
        "c_comment": "string",
    },
    "part": {
        "p_partkey": "bigint",
        "p_name": "string",
        "p_mfgr": "string",
        "p_brand": "string",
        "p_type": "string",
        "p_size": "int",
        "p_container": "string",
        "p_retailprice": "decimal(15,2)",
        "p_comment": "string",
    },
    "supplier": {
        "s_suppkey": "bigint",
        "s_name": "string",
        "s_nationkey": "int",
        "s_acctbal": "decimal(15,2)",
        "s_phone": "string",
        "s_address": "string",
        "s_comment": "string",
    },
}


class MissingColumns(ValueError):
    """A source table lacks columns the models read."""


def read_source(
    spark: SparkSession,
    base_dir: str,
    name: str,
    *,
    stand_ins: bool = False,
    window: tuple[str, dt.date | None, dt.date | None] | None = None,
) -> DataFrame:
    """One source table with its declared columns.

    ``stand_ins`` computes columns that the stored table lacks (test data);
    without it a missing column is an error. ``window`` is a half-open date
    range on a stored column, compared in the stored type so that it is pushed
    into the scan.
    """
    stored = spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
    if window is not None:
        column, start, end = window
        stored = stored.filter(
            between_window(F.col(column), start, end, stored.schema[column].dataType.simpleString())
        )
    return conform(stored, name, stand_ins=stand_ins)


def conform(stored: DataFrame, name: str, *, stand_ins: bool = False) -> DataFrame:
    """Select the declared columns of ``name`` from a stored table and cast them."""
    fillers = STAND_INS.get(name, {}) if stand_ins else {}
    missing = [c for c in SOURCE_COLUMNS[name] if c not in stored.columns and c not in fillers]
    if missing:
        raise MissingColumns(f"{name} lacks {', '.join(missing)}")

    def declared(column: str, data_type: str) -> Column:
        value = F.col(column) if column in stored.columns else fillers[column]()
        return value.cast(data_type).alias(column)

    return stored.select(*[declared(c, t) for c, t in SOURCE_COLUMNS[name].items()])


def read_sources(
    spark: SparkSession, base_dir: str, *, stand_ins: bool = False
) -> dict[str, DataFrame]:
    """All five source tables."""
    return {
        name: read_source(spark, base_dir, name, stand_ins=stand_ins) for name in SOURCE_COLUMNS
    }

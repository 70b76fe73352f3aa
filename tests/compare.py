"""Order-insensitive comparison of a Spark result with a SQL result."""

from __future__ import annotations

import glob
import math
import os

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r),
    )


TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when both sides have the same columns, types and rows."""
    cursor = con.execute(sql)
    sql_columns = [d[0] for d in cursor.description]
    if sorted(sql_columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(sql_columns)}"]
    sql_types = {d[0]: str(d[1]) for d in cursor.description}
    mistyped = [
        f"{name}: {kind} != {sql_types[name]}"
        for name, kind in df.dtypes
        if TYPES[kind] != sql_types[name]
    ]
    if mistyped:
        return mistyped
    expected = _rows(sql_columns, cursor.fetchall())
    found = _rows(df.columns, df.collect())
    if len(found) != len(expected):
        return [f"{len(found)} rows, expected {len(expected)}"]
    problems = []
    for a, b in zip(found, expected):
        same = all(
            type(x) is type(y)
            and (math.isclose(x, y, rel_tol=1e-12) if isinstance(x, float) else x == y)
            for x, y in zip(a, b)
        )
        if not same:
            problems.append(f"{a} != {b}")
            if len(problems) == 3:
                break
    return problems

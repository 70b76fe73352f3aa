"""Deterministic stand-ins for source columns that the test tables do not carry.

Fixed values: integer arithmetic over the table's own keys, the same in any
SQL engine. They are used only when a caller asks for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _shifted_ship_date(days: str) -> Callable[[], Column]:
    return lambda: F.date_add(F.col("l_shipdate").cast("date"), F.expr(days).cast("int"))


def _phone(nation: str, key: str) -> Callable[[], Column]:
    return lambda: F.concat(
        F.col(nation).cast("string"), F.lit("-"), (F.col(key) % 9000 + 1000).cast("string")
    )


def _address(key: str) -> Callable[[], Column]:
    return lambda: F.concat(F.lit("Addr "), F.col(key).cast("string"))


def _no_text() -> Column:
    return F.lit(None).cast("string")


STAND_INS: dict[str, dict[str, Callable[[], Column]]] = {
    "lineitem": {
        "l_commitdate": _shifted_ship_date("(l_orderkey * 7 + bigint(l_linenumber) * 3) % 61 - 30"),
        "l_receiptdate": _shifted_ship_date("(l_orderkey * 11 + bigint(l_linenumber) * 5) % 30 - 5"),
    },
    "customer": {
        "c_phone": _phone("c_nationkey", "c_custkey"),
        "c_address": _address("c_custkey"),
        "c_comment": _no_text,
    },
    "part": {
        "p_mfgr": lambda: F.concat(
            F.lit("Manufacturer#"), (F.col("p_partkey") % 5 + 1).cast("string")
        ),
        "p_container": lambda: F.concat(F.lit("BOX "), (F.col("p_partkey") % 4).cast("string")),
        "p_comment": _no_text,
    },
    "supplier": {
        "s_phone": _phone("s_nationkey", "s_suppkey"),
        "s_address": _address("s_suppkey"),
        "s_comment": _no_text,
    },
}

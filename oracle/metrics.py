"""Declared checks as SQL counting statements."""

from __future__ import annotations

from collections.abc import Iterable

from stratamart.operators.quality import Check

SOURCE_TABLES = {
    "orders": "src_orders",
    "lineitem": "src_lineitem",
    "customer": "src_customer",
    "part": "src_part",
    "supplier": "src_supplier",
}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _relation(name: str) -> str:
    return SOURCE_TABLES.get(name, name)


def counts(check: Check, as_of: str = "current_date") -> str:
    """SELECT giving n_rows and n_bad of a check."""
    table = _relation(check.target)
    column = check.columns[0] if check.columns else ""
    if check.kind in ("unique", "unique_combination"):
        keys = ", ".join(check.columns)
        ignored = f"{column} IS NOT NULL" if check.kind == "unique" else "true"
        return f"""SELECT (SELECT count(*) FROM {table}) AS n_rows,
               (SELECT count(*) FROM (SELECT {keys} FROM {table} WHERE {ignored}
                  GROUP BY {keys} HAVING count(*) > 1)) AS n_bad"""
    if check.kind == "relationships":
        parent, key = _relation(check.parent[0]), check.parent[1]
        bad = f"c.{column} IS NOT NULL AND NOT EXISTS " + (
            f"(SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})"
        )
        return f"""SELECT (SELECT count(*) FROM {table}) AS n_rows,
               (SELECT count(*) FROM {table} c WHERE {bad}) AS n_bad"""
    if check.kind == "row_count_at_least":
        return f"""SELECT count(*) AS n_rows,
               CASE WHEN count(*) < {check.minimum} THEN 1 ELSE 0 END AS n_bad FROM {table}"""
    bad = {
        "not_null": f"{column} IS NULL",
        "accepted_values": f"{column} NOT IN ({', '.join(_text(v) for v in check.values)})",
        "expression_is_true": f"NOT ({check.condition})",
        "at_least": f"{column} < {check.minimum}",
        "no_rows_where": check.condition.replace(":as_of", as_of).replace("to_date(", "date("),
    }[check.kind]
    return f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE {bad}) AS n_bad FROM {table}"


def metrics(checks: Iterable[Check], suite: str, as_of: str = "current_date") -> str:
    """One metrics row per check."""
    return "\nUNION ALL\n".join(
        f"""SELECT {_text(suite)} AS suite, {_text(c.target)} AS target,
       {_text(c.kind)} AS check_name, {_text(c.column_name)} AS column_name,
       {_text(c.severity)} AS severity, CAST(n_rows AS BIGINT) AS n_rows,
       CAST(n_bad AS BIGINT) AS n_bad, n_bad = 0 AS passed
FROM ({counts(c, as_of)})"""
        for c in checks
    )

"""Declarative data checks evaluated as aggregates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.operators.merge import duplicate_keys

METRIC_COLUMNS = [
    "suite",
    "target",
    "check_name",
    "column_name",
    "severity",
    "n_rows",
    "n_bad",
    "passed",
]


@dataclass(frozen=True)
class Check:
    """One declared check on one table."""

    target: str
    kind: str
    columns: tuple[str, ...] = ()
    condition: str = ""
    values: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None
    minimum: int = 0
    severity: str = "error"
    label: str = field(default="", compare=False)

    @property
    def column_name(self) -> str:
        return self.label or self.condition or ", ".join(self.columns)


def not_null(target: str, *columns: str, severity: str = "error") -> list[Check]:
    return [Check(target, "not_null", (c,), severity=severity) for c in columns]


def unique(target: str, *columns: str) -> list[Check]:
    return [Check(target, "unique", (c,)) for c in columns]


def unique_combination(target: str, *columns: str) -> list[Check]:
    return [Check(target, "unique_combination", columns)]


def accepted_values(target: str, column: str, *values: str) -> list[Check]:
    return [Check(target, "accepted_values", (column,), values=values)]


def relationship(target: str, column: str, parent: str, parent_column: str) -> list[Check]:
    return [Check(target, "relationships", (column,), parent=(parent, parent_column))]


def expression(target: str, *conditions: str) -> list[Check]:
    """The condition must not be false; NULL passes."""
    return [Check(target, "expression_is_true", condition=c) for c in conditions]


def no_rows_where(target: str, label: str, condition: str) -> list[Check]:
    """No row may meet the condition; ``:as_of`` in it stands for the run's day."""
    return [Check(target, "no_rows_where", condition=condition, label=label)]


def row_count_at_least(target: str, minimum: int) -> list[Check]:
    return [Check(target, "row_count_at_least", minimum=minimum)]


def at_least(target: str, minimum: int, *columns: str) -> list[Check]:
    """Non-null values must not be below the minimum."""
    return [Check(target, "at_least", (c,), minimum=minimum) for c in columns]


def with_severity(checks: Iterable[Check], overrides: Mapping[Check, str]) -> list[Check]:
    """The checks with some severities replaced."""
    return [replace(c, severity=overrides.get(c, c.severity)) for c in checks]


def _text(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def bad_row(check: Check, as_of: dt.date | None = None) -> str:
    """SQL predicate for rows that break a row-wise check."""
    if check.kind == "expression_is_true":
        return f"not ({check.condition})"
    if check.kind == "no_rows_where":
        day = "current_date()" if as_of is None else f"date'{as_of.isoformat()}'"
        return check.condition.replace(":as_of", day)
    column = f"`{check.columns[0]}`"
    if check.kind == "not_null":
        return f"{column} is null"
    if check.kind == "accepted_values":
        return f"{column} not in ({', '.join(_text(v) for v in check.values)})"
    if check.kind == "at_least":
        return f"{column} < {check.minimum}"
    raise ValueError(f"{check.kind} is not a row-wise check")


def violations(
    df: DataFrame,
    check: Check,
    parent: DataFrame | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    """The rows (or repeated keys) that break a check."""
    if check.kind == "unique":
        return duplicate_keys(df.filter(F.col(check.columns[0]).isNotNull()), list(check.columns))
    if check.kind == "unique_combination":
        return duplicate_keys(df, list(check.columns))
    if check.kind == "relationships":
        column, parent_column = check.columns[0], check.parent[1]
        known = parent.select(F.col(parent_column).alias(column))
        return df.filter(F.col(column).isNotNull()).join(known, column, "left_anti")
    if check.kind == "row_count_at_least":
        return df.agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") < check.minimum)
    return df.filter(F.expr(bad_row(check, as_of)))


def _metric_rows(totals: DataFrame, suite: str, counted: dict[Check, str]) -> DataFrame:
    """One row per check from a single row of totals; maps checks to their bad count."""
    rows = [
        f"""named_struct(
            'suite', {_text(suite)},
            'target', {_text(check.target)},
            'check_name', {_text(check.kind)},
            'column_name', {_text(check.column_name)},
            'severity', {_text(check.severity)},
            'n_rows', cast(coalesce(n_rows, 0) as bigint),
            'n_bad', cast(coalesce({n_bad}, 0) as bigint),
            'passed', coalesce({n_bad}, 0) = 0)"""
        for check, n_bad in counted.items()
    ]
    return totals.selectExpr(f"inline(array({', '.join(rows)}))")


def _row_wise(df: DataFrame, checks: list[Check], suite: str, as_of: dt.date | None) -> DataFrame:
    """All row-wise checks of a table in one aggregate over one scan."""
    wanted = ["count(*) as n_rows"]
    counted = {}
    for i, check in enumerate(checks):
        if check.kind == "row_count_at_least":
            counted[check] = f"if(n_rows < {check.minimum}, 1, 0)"
        else:
            wanted.append(f"count_if({bad_row(check, as_of)}) as bad_{i}")
            counted[check] = f"bad_{i}"
    return _metric_rows(df.agg(*[F.expr(w) for w in wanted]), suite, counted)


# The checks on keys, which have to bring equal keys together.
KEY_KINDS = ("unique", "unique_combination", "relationships")
# A task that counts keys holds several hundred bytes for each row it reads, where keys hardly
# repeat. So the rows of a task are bounded, of the tables as stored and of what is shuffled.
SMALL_TASKS = {
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}
# Of rows that are stored with their digests; a table in few tasks sends fewer copies of a key.
SMALL_TASKS_OF_STORED = {**SMALL_TASKS, "spark.sql.files.maxPartitionBytes": "32m"}
WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")


def _key_types(tables: Mapping[str, DataFrame], check: Check) -> list[str]:
    """Types in which the keys of a check are compared; whole numbers as the widest one."""
    keys = tables[check.target].select(*[f"`{c}`" for c in check.columns])
    if check.kind == "relationships":
        parent, column = check.parent
        keys = keys.union(tables[parent].select(f"`{column}`"))
    types = [f.dataType.simpleString() for f in keys.schema.fields]
    return ["bigint" if t in WHOLE_NUMBERS else t for t in types]


def _same_type(column: str, kind: str) -> str:
    return column if kind == "string" else f"cast({column} as {kind})"


def _carried(column: str, kind: str) -> str:
    """SQL for a key as it travels: texts as bytes, a digest in hexadecimal as the half of them it stands for.

    The first byte tells the two apart, so different texts stay different.
    """
    if kind != "string":
        return _same_type(column, kind)
    digest = f"length({column}) = 32 and lower(hex(unhex({column}))) = {column}"
    return f"if({digest}, concat(x'01', unhex({column})), concat(x'00', cast({column} as binary)))"


def _key_rows(
    tables: Mapping[str, DataFrame], checks: list[Check], number_of_pass: int, passes: int
) -> tuple[list[DataFrame], list[str]]:
    """(columns for keys, check, child, parent) of all checks, from one scan per table.

    A key stands in the columns of its types, the others are NULL, so keys of
    any types share one row layout. A row of a table gives one row per check
    it takes part in, as child (the checked side) or as parent, if its key is
    dealt to this pass: equal keys always are dealt to the same.
    """
    columns: dict[str, str] = {}
    wanted: dict[str, list[tuple[int, dict[str, str], bool]]] = {}
    for number, check in enumerate(checks):
        places: list[str] = []
        for kind in _key_types(tables, check):
            place = f"k{sum(columns[p] == kind for p in places)}_{kind}"
            columns[place] = kind
            places.append(place)
        wanted.setdefault(check.target, []).append((number, dict(zip(places, check.columns)), False))
        if check.kind == "relationships":
            parent, column = check.parent
            wanted.setdefault(parent, []).append((number, {places[0]: column}, True))

    def row(number: int, key: dict[str, str], is_parent: bool) -> str:
        values = [f"'check', {number}", f"'child', {int(not is_parent)}", f"'parent', {int(is_parent)}"]
        for place, kind in columns.items():
            carried = "binary" if kind == "string" else kind
            value = f"`{key[place]}`" if place in key else f"cast(null as {kind})"
            values.append(f"'{place}', cast({_carried(value, kind)} as {carried})")
        made = f"named_struct({', '.join(values)})"
        if passes == 1:
            return made
        dealt = ", ".join(_same_type(f"`{column}`", columns[place]) for place, column in key.items())
        return f"if(pmod(xxhash64({dealt}), {passes}) = {number_of_pass}, {made}, null)"

    parts = [
        tables[target].selectExpr(f"inline(array({', '.join(row(*w) for w in group)}))")
        for target, group in wanted.items()
    ]
    # What another pass counts is a row of nulls here.
    return [p if passes == 1 else p.filter("check is not null") for p in parts], list(columns)


def _key_totals(
    tables: Mapping[str, DataFrame], checks: list[Check], number_of_pass: int = 0, passes: int = 1
) -> DataFrame:
    """(check, n_rows, n_bad) over the keys of a pass: one aggregate over (check, key).

    Bad are key values that occur more than once, or child rows without a
    parent. Keys are counted before they are shuffled, so a key shared by most
    rows travels as one row per task.
    """
    parts, columns = _key_rows(tables, checks, number_of_pass, passes)
    quoted = [f"`{c}`" for c in columns]
    per_key = (
        _union(parts)
        .groupBy(*quoted, "check")
        .agg(F.expr("sum(child) as children"), F.expr("max(parent) as known"))
    )
    of_kind = {kind: [str(i) for i, c in enumerate(checks) if c.kind == kind] for kind in KEY_KINDS}
    present = f"({' or '.join(f'{c} is not null' for c in quoted)})"
    bad = {
        "unique": f"if(children > 1 and {present}, 1, 0)",
        "unique_combination": "if(children > 1, 1, 0)",
        "relationships": f"if(known = 0 and {present}, children, 0)",
    }
    cases = [f"when check in ({', '.join(of_kind[k])}) then {bad[k]}" for k in KEY_KINDS if of_kind[k]]
    counted = per_key.selectExpr("check", "children as n_rows", f"case {' '.join(cases)} end as n_bad")
    # A check over empty tables has no key, but a result.
    numbers = per_key.sparkSession.range(len(checks), numPartitions=1)
    counted = counted.union(numbers.selectExpr("cast(id as int)", "0", "0"))
    return counted.groupBy("check").agg(F.expr("sum(n_rows) as n_rows"), F.expr("sum(n_bad) as n_bad"))


def _keyed(
    tables: Mapping[str, DataFrame], checks: list[Check], suite: str, passes: int
) -> DataFrame:
    """All uniqueness and reference checks.

    With several passes each counts a part of the keys in a job of its own, so
    that no more than that part is shuffled at a time; a row per check and pass
    reaches the driver.
    """
    if passes == 1:
        totals = _key_totals(tables, checks)
    else:
        rows = [r for n in range(passes) for r in _key_totals(tables, checks, n, passes).collect()]
        spark = tables[checks[0].target].sparkSession
        values = ", ".join(f"({r['check']}, {r.n_rows}L, {r.n_bad}L)" for r in rows)
        counts = spark.sql(f"select * from values {values} as t(check, n_rows, n_bad)")
        totals = counts.groupBy("check").agg(F.expr("sum(n_rows) as n_rows"), F.expr("sum(n_bad) as n_bad"))
    declared = [
        f"""named_struct(
            'suite', {_text(suite)},
            'target', {_text(check.target)},
            'check_name', {_text(check.kind)},
            'column_name', {_text(check.column_name)},
            'severity', {_text(check.severity)})"""
        for check in checks
    ]
    named = totals.selectExpr(f"array({', '.join(declared)})[check] as declared", "n_rows", "n_bad")
    return named.selectExpr("declared.*", "n_rows", "n_bad", "n_bad = 0 as passed")


def _union(parts: list[DataFrame]) -> DataFrame:
    """Union as a balanced tree, which keeps the analysis of many parts short."""
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    return _union(parts[:half]).union(_union(parts[half:]))


def check_metrics(
    tables: Mapping[str, DataFrame],
    checks: Iterable[Check],
    suite: str,
    *,
    as_of: dt.date | None = None,
    passes: int = 1,
) -> DataFrame:
    """One metrics row per check.

    Nothing runs until the result is read, except with several ``passes``: the
    checks on keys then read their tables once in each, so hand in stored ones.
    """
    keyed: list[Check] = []
    row_wise: dict[str, list[Check]] = {}
    for check in checks:
        if check.kind in KEY_KINDS:
            keyed.append(check)
        else:
            row_wise.setdefault(check.target, []).append(check)
    parts = [_keyed(tables, keyed, suite, passes)] if keyed else []
    for target, group in row_wise.items():
        parts.append(_row_wise(tables[target], group, suite, as_of))
    return _union(parts)


class GateFailed(RuntimeError):
    """Checks of severity error have failed."""

    def __init__(self, suite: str, failed: list[str]):
        super().__init__(f"{suite}: {len(failed)} failed checks: {'; '.join(failed)}")
        self.failed = failed


def enforce(metrics: DataFrame) -> None:
    """Raise when a check of severity error has failed.

    Reads one row per failed check, a number bounded by the declared checks.
    """
    failing = metrics.filter(~F.col("passed") & (F.col("severity") == "error")).collect()
    if failing:
        raise GateFailed(
            failing[0]["suite"],
            [f"{r.target}.{r.check_name}({r.column_name}) n_bad={r.n_bad}" for r in failing],
        )

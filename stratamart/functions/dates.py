"""Date helpers with the NULL rules of the warehouse SQL."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _none_null(cols: tuple[Column, ...]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])


def least_strict(*cols: Column) -> Column:
    """Smallest value, NULL when any argument is NULL (``F.least`` skips NULLs)."""
    return F.when(_none_null(cols), F.least(*cols))


def greatest_strict(*cols: Column) -> Column:
    """Largest value, NULL when any argument is NULL (``F.greatest`` skips NULLs)."""
    return F.when(_none_null(cols), F.greatest(*cols))


def median_of_three(first: Column, second: Column, third: Column) -> Column:
    """Middle value; falls back to ``third`` when neither of the others is known to be it."""

    def in_the_middle(x: Column, y: Column) -> Column:
        return x.between(y, third) | x.between(third, y)

    return (
        F.when(in_the_middle(first, second), first)
        .when(in_the_middle(second, first), second)
        .otherwise(third)
    )


def between_window(
    day: Column,
    start: dt.date | None = None,
    end: dt.date | None = None,
    data_type: str = "date",
) -> Column:
    """Half-open ``[start, end)`` predicate.

    The bounds become literals of the column's own type, so the predicate
    reaches the Parquet scan also where the stored column is a timestamp.
    """
    condition = F.lit(True)
    if start is not None:
        condition = condition & (day >= F.lit(start).cast(data_type))
    if end is not None:
        condition = condition & (day < F.lit(end).cast(data_type))
    return condition

import datetime as dt

import pytest

from plans_util import plan
from stratamart.operators.spine import date_bounds, date_spine
from stratamart.plans.gold import dim_date

DAY = dt.timedelta(days=1)


def bounds(spark, start, end):
    return spark.createDataFrame([(start, end)], "start_date date, end_date date")


@pytest.mark.parametrize(
    "start, end, days",
    [
        (dt.date(2024, 2, 27), dt.date(2024, 3, 1), 4),
        (dt.date(2024, 1, 1), dt.date(2024, 1, 1), 1),
        (dt.date(2024, 1, 2), dt.date(2024, 1, 1), 0),
        (None, dt.date(2024, 1, 1), 0),
        (dt.date(2024, 1, 1), None, 0),
        (dt.date(1900, 1, 1), dt.date(2024, 12, 31), 45_656),
    ],
)
def test_spine_is_contiguous_and_whole(spark, start, end, days):
    found = [r.date_day for r in date_spine(bounds(spark, start, end)).collect()]
    assert found == [start + i * DAY for i in range(days)]


def test_bounds_take_the_first_known_line_date(spark):
    orders = spark.createDataFrame(
        [(dt.date(2024, 1, 3),), (dt.date(2024, 1, 2),), (None,)], "order_date date"
    )
    lines = spark.createDataFrame(
        [
            (dt.date(2024, 1, 5), dt.date(2024, 3, 1), None),
            (None, dt.date(2024, 1, 7), dt.date(2024, 4, 1)),
            (None, None, dt.date(2024, 1, 9)),
        ],
        "receipt_date date, ship_date date, commit_date date",
    )
    row = date_bounds(orders, lines)
    assert tuple(row.first()) == (dt.date(2024, 1, 2), dt.date(2024, 1, 9))
    assert "NestedLoop" not in plan(row) and "Cartesian" not in plan(row)


def test_calendar_columns(spark):
    orders = spark.createDataFrame([(dt.date(2024, 1, 7),)], "order_date date")
    lines = spark.createDataFrame(
        [(dt.date(2024, 2, 29), None, None)], "receipt_date date, ship_date date, commit_date date"
    )
    rows = {r.date_day: r for r in dim_date(orders, lines).collect()}
    sunday, leap = rows[dt.date(2024, 1, 7)], rows[dt.date(2024, 2, 29)]
    assert (sunday.day_of_week, sunday.month_start) == (0, dt.date(2024, 1, 1))
    assert (leap.year, leap.month, leap.day, leap.day_of_week) == (2024, 2, 29, 4)
    assert leap.month_start == dt.date(2024, 2, 1)

"""Every named query against the same result in SQL."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, differences
from plans_util import plan

# The corpus operators have tests of their own.
QUERIES, ORACLES = entry_points.QUERIES, entry_points.ORACLES


@pytest.fixture(scope="module")
def tables(small):
    return connect(small)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, small, tables, name):
    assert differences(QUERIES[name](spark, small), tables, ORACLES[name]) == []


def test_entry_gives_the_daily_metric(spark):
    assert entry_points.entry(spark).count() == 1084


LAZY = [
    n
    for n in QUERIES
    if not n.startswith(("merge_", "snap_", "check_", "expect_", "export_", "build_"))
]


@pytest.mark.parametrize("name", LAZY)
def test_plans_stay_distributed(spark, small, name):
    text = plan(QUERIES[name](spark, small), "simple")
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "collect_list"):
        assert operator not in text, text

"""Operators against plain Python on random small inputs."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratamart.functions import greatest_strict, least_strict, median_of_three
from stratamart.operators.history import Snapshot, apply_snapshot, as_of, run_snapshot
from stratamart.operators.merge import merge_fact
from stratamart.operators.quality import (
    check_metrics,
    relationship,
    unique,
    unique_combination,
)
from stratamart.operators.small_join import small_left_join
from stratamart.operators.storage import FactLayout, write_clustered

START = dt.date(2024, 1, 1)


def maybe(rng, value, share=0.15):
    return None if rng.random() < share else value


def test_dates(spark):
    rng = random.Random(1)
    triples = [
        tuple(maybe(rng, START + dt.timedelta(days=rng.randrange(6))) for _ in range(3))
        for _ in range(600)
    ]

    def between(x, a, b):
        """Three-valued BETWEEN."""
        low = None if x is None or a is None else x >= a
        high = None if x is None or b is None else x <= b
        if low is False or high is False:
            return False
        return None if low is None or high is None else True

    def expected(c, s, r):
        middle = r
        if between(c, s, r) or between(c, r, s):
            middle = c
        elif between(s, c, r) or between(s, r, c):
            middle = s
        known = None not in (c, s, r)
        return (min(c, s, r) if known else None, middle, max(c, s, r) if known else None)

    numbered = [(i, *t) for i, t in enumerate(triples)]
    df = spark.createDataFrame(numbered, "i int, c date, s date, r date")
    c, s, r = F.col("c"), F.col("s"), F.col("r")
    found = df.select(
        "i", least_strict(c, s, r), median_of_three(c, s, r), greatest_strict(c, s, r)
    )
    assert {row[0]: tuple(row)[1:] for row in found.collect()} == {
        i: expected(*t) for i, t in enumerate(triples)
    }


@pytest.mark.parametrize("seed", [2, 3])
def test_merges(spark, folder, seed):
    rng = random.Random(seed)
    layout = FactLayout(key="k", day="d", month="m", line=("o",), cluster_key="o")

    def batch(size, value):
        return {
            o: (maybe(rng, START + dt.timedelta(days=rng.randrange(150))), value)
            for o in rng.sample(range(30), size)
        }

    def frame(rows):
        data = [(f"key-{o}", o, d, v) for o, (d, v) in rows.items()]
        return spark.createDataFrame(data, "k string, o bigint, d date, v int")

    state = batch(15, 0)
    stored = write_clustered(frame(state), folder, layout)
    for step in (1, 2, 3):
        change = batch(rng.choice([1, 4, 12]), step)
        stored = merge_fact(spark, folder, frame(change), layout)
        state |= change
        assert sorted((r.o, str(r.d), r.v) for r in stored.collect()) == sorted(
            (o, str(d), v) for o, (d, v) in state.items()
        )


@pytest.mark.parametrize("seed", [4, 5])
def test_histories(spark, folder, seed):
    rng = random.Random(seed)
    snapshot = Snapshot("s", "k", ("k", "a", "b", "free"), ("a", "b"))
    versions: list[dict] = []
    history = stored = None
    runs = [dt.datetime(2024, 1, 1) + dt.timedelta(days=i) for i in range(4)]
    for now in runs:
        source = {
            k: (maybe(rng, rng.choice("xy")), maybe(rng, rng.choice("xy")), rng.randrange(3))
            for k in rng.sample(range(14), 9)
        }
        for k, (a, b, free) in source.items():
            current = [v for v in versions if v["k"] == k and v["to"] is None]
            if current and (current[0]["a"], current[0]["b"]) == (a, b):
                continue
            for v in current:
                v["to"] = now
            versions.append({"k": k, "a": a, "b": b, "free": free, "from": now, "to": None})
        df = spark.createDataFrame(
            [(k, *v) for k, v in source.items()], "k bigint, a string, b string, free int"
        )
        history = apply_snapshot(history, df, snapshot, now)
        stored = run_snapshot(spark, folder, df, snapshot, now)

    def text(rows):
        return sorted(str(tuple(r)) for r in rows)

    columns = ["k", "a", "b", "free", "valid_from", "valid_to"]
    expected = text(
        (v["k"], v["a"], v["b"], v["free"], v["from"], v["to"]) for v in versions
    )
    assert text(history.select(*columns).collect()) == expected
    assert text(stored.select(*columns).collect()) == expected
    moment = runs[2] + dt.timedelta(hours=3)
    alive = [v for v in versions if v["from"] <= moment and (v["to"] is None or v["to"] > moment)]
    assert as_of(stored, moment).count() == len(alive)


def test_key_checks(spark):
    rng = random.Random(6)
    child = [(maybe(rng, rng.randrange(40)), maybe(rng, rng.randrange(3))) for _ in range(400)]
    parent = [(maybe(rng, rng.randrange(40)),) for _ in range(30)]
    tables = {
        "c": spark.createDataFrame(child, "k bigint, n int"),
        "p": spark.createDataFrame(parent, "id bigint"),
    }
    declared = [
        *relationship("c", "k", "p", "id"),
        *unique("c", "k"),
        *unique_combination("c", "k", "n"),
    ]
    found = {r.check_name: r.n_bad for r in check_metrics(tables, declared, "s").collect()}
    known = {p[0] for p in parent}
    singles = Counter(k for k, _ in child if k is not None)
    assert found == {
        "relationships": sum(k is not None and k not in known for k, _ in child),
        "unique": sum(n > 1 for n in singles.values()),
        "unique_combination": sum(n > 1 for n in Counter(child).values()),
    }


@pytest.mark.parametrize("max_rows", [100, 1])
def test_small_join(spark, max_rows):
    rng = random.Random(7)
    large = [(i, maybe(rng, rng.choice("abcdef"))) for i in range(300)]
    small = {"a": 1, "b": 2, "z": 3}
    joined = small_left_join(
        spark.createDataFrame(large, "i int, k string").repartition(5),
        spark.createDataFrame(list(small.items()), "k string, v int"),
        "k",
        max_rows=max_rows,
    )
    assert sorted((r.i, r.v) for r in joined.collect()) == [
        (i, small.get(k)) for i, k in large
    ]

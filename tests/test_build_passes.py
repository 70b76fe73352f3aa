"""A build that works in passes, so that little is shuffled at a time, builds the same."""

import datetime as dt

from pyspark.sql import functions as F

from stratamart import catalog
from stratamart.operators import quality
from stratamart.operators.quality import check_metrics, relationship, unique, unique_combination
from stratamart.plans import build
from stratamart.plans.export import read_results


def test_keys_counted_in_passes_give_the_same_metrics(spark):
    digest = "0123456789abcdef" * 2
    child = spark.createDataFrame(
        [
            (i % 40 if i % 11 else None, f"{i % 60:032x}" if i % 7 else digest.upper(), float(i % 30))
            for i in range(200)
        ]
        + [(None, None, -0.0), (None, None, float("nan")), (None, None, float("nan"))],
        "i int, s string, x double",
    )
    parent = spark.createDataFrame([(i, f"{i:032x}") for i in range(0, 40, 3)], "p long, q string")
    empty = child.filter("i > 1000")
    declared = [
        *unique("c", "i", "s", "x"),
        *unique_combination("c", "i", "x"),
        *unique_combination("c", "s"),
        *relationship("c", "i", "p", "p"),
        *relationship("c", "s", "p", "q"),
        *unique("e", "i"),
        *relationship("e", "i", "p", "p"),
    ]
    tables = {"c": child, "p": parent, "e": empty}
    whole = check_metrics(tables, declared, "s")
    passes = check_metrics(tables, declared, "s", passes=5)
    assert passes.dtypes == whole.dtypes
    assert sorted(passes.collect()) == sorted(whole.collect())
    parts = [quality._key_totals(tables, declared, n, 5).agg(F.sum("n_rows")).first()[0] for n in range(5)]
    total = sum(r.n_rows for r in whole.collect())
    assert sum(parts) == total and max(parts) < total / 2


def test_a_build_in_passes_is_the_same(spark, small, folder, monkeypatch):
    """The shipment fact and the gates of silver and gold; the sources are read once."""
    sizes, passes = [], []
    measure = quality.check_metrics

    def check(tables, checks, layer, **more):
        passes.append((layer, more["passes"]))
        return measure(tables, checks, layer, **more)

    monkeypatch.setattr(build, "check_metrics", check)
    monkeypatch.setattr(build, "passes_over", lambda size, *_: sizes.append(size) or (3 if size else 1))
    run = dt.datetime(2024, 1, 1)
    severities = {c: "warn" for c in catalog.KNOWN_TO_FAIL}
    given = {"as_of": catalog.BUILT_ON, "severities": severities}
    sources = catalog.read_sources(spark, small, stand_ins=True)
    found = build.build_layers(spark, small, f"{folder}/passes", run, sources=sources, **given)
    assert passes == [("bronze", 1), ("silver", 3), ("gold", 3)] and sizes[0] == 0 and min(sizes[1:]) > 0
    monkeypatch.setattr(build, "passes_over", lambda *_: 1)
    whole = build.build_layers(spark, small, f"{folder}/whole", run, sources=sources, **given)
    assert sorted(found.collect()) == sorted(whole.collect())
    events = [spark.read.parquet(f"{folder}/{d}/gold/fct_shipment_events") for d in ("passes", "whole")]
    assert events[0].exceptAll(events[1]).count() == events[1].exceptAll(events[0]).count() == 0
    assert read_results(spark, f"{folder}/passes/validation_results").count() == whole.count()

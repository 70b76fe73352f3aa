"""Connected components of a graph given as pairs, by alternating star steps.

Large stars move a node's larger neighbours to its smallest one, small stars
its smaller ones. When a round changes nothing, every node points to the
smallest node it can reach. A round is two joins over the pairs; nothing but
a row count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(pairs: DataFrame) -> DataFrame:
    """(node, component) of all nodes of (a, b) pairs that differ; component is the smallest node."""
    edges = stored(
        pairs.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    before = _state(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return found.unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (
        edges.join(smallest, "u")
        .where("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.unionByName(smallest.withColumnRenamed("m", "v")).distinct()

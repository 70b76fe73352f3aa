"""Near-duplicate vectors through spherical caps of structured random product codes.

A code is a random rotation and, for each of four blocks of coordinates, a set
of random directions; a filter is one direction of each block, so few
directions make many filters and the filters of a vector can be listed without
trying all. Each vector is given all filters whose direction it exceeds the
height of its cap for, which is set at its ``listed``-th best filter, so that
vectors in thin and in dense places get as many. Vectors that share a filter
of one of the codes are compared in double precision.

Members of a filter stand in blocks of bounded size, and a task compares two
blocks of a filter by a matrix product. A pair is counted in the smallest
filter it shares. A task gives the number of links per vector, and links that
span what it found connected, never all pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_task, stored, tidy
from .components import components

PARTS = 4  # blocks of coordinates
WIDEST_MATRIX = 1024  # wider vectors are rotated without a matrix, whose size grows with the square


@dataclass(frozen=True)
class CapCodes:
    """``codes`` product codes of ``directions`` directions in each of four blocks.

    Recall measured against brute force at a cosine of 0.95 is above 0.99 with
    these numbers of codes and filters.
    """

    width: int
    directions: int
    codes: int = 4
    listed: int = 8
    seed: int = 20

    @classmethod
    def fitting(cls, vectors: int, width: int) -> CapCodes:
        """About as many filters as vectors, a million at least."""
        return cls(width, max(32, int(np.ceil(vectors ** (1 / PARTS)))))

    @lru_cache(maxsize=2)
    def tables(self) -> list[tuple[np.ndarray, list[np.ndarray]]]:
        """The rotation and the directions of each code; the same for the same numbers."""
        random = np.random.default_rng(self.seed)
        padded = -(-self.width // PARTS) * PARTS
        found = []
        for _ in range(self.codes):
            if self.width <= WIDEST_MATRIX:
                rotation = np.linalg.qr(random.standard_normal((padded, padded)))[0][: self.width]
            else:
                padded = 1 << (self.width - 1).bit_length()
                rotation = random.choice([-1.0, 1.0], (3, padded))
            blocks = []
            for _ in range(PARTS):
                block = random.standard_normal((self.directions, padded // PARTS))
                blocks.append(block / np.linalg.norm(block, axis=1, keepdims=True))
            found.append((rotation, blocks))
        return found

    def turned(self, unit: np.ndarray, rotation: np.ndarray) -> np.ndarray:
        """Rotated rows: by a matrix, or by three rounds of random signs and a Hadamard transform."""
        if self.width <= WIDEST_MATRIX:
            return unit @ rotation
        rows = np.zeros((len(unit), rotation.shape[1]))
        rows[:, : self.width] = unit
        for signs in rotation:
            rows = _hadamard(rows * signs)
        return rows

    def filters(self, unit: np.ndarray) -> np.ndarray:
        """Sorted filter numbers, one row per row of unit vectors."""
        lists = []
        for number, (rotation, blocks) in enumerate(self.tables()):
            turned = np.split(self.turned(unit, rotation), PARTS, axis=1)
            a, b, c, d = (part @ block.T for part, block in zip(turned, blocks))
            front = (a[:, :, None] + b[:, None, :]).reshape(len(unit), -1)
            back = (c[:, :, None] + d[:, None, :]).reshape(len(unit), -1)
            # The best sums are sums of the best halves.
            n = min(self.listed, front.shape[1])
            best_front = np.argsort(-front, axis=1, kind="stable")[:, :n]
            best_back = np.argsort(-back, axis=1, kind="stable")[:, :n]
            sums = (
                np.take_along_axis(front, best_front, 1)[:, :, None]
                + np.take_along_axis(back, best_back, 1)[:, None, :]
            ).reshape(len(unit), -1)
            best = np.argsort(-sums, axis=1, kind="stable")[:, : self.listed]
            pairs = front.shape[1]
            chosen = np.take_along_axis(best_front, best // n, 1) * pairs + np.take_along_axis(
                best_back, best % n, 1
            )
            lists.append(chosen + number * pairs * pairs)
        return np.sort(np.concatenate(lists, axis=1), axis=1)


BLOCK = 256  # vectors that are compared with as many in one group of rows


def _hadamard(rows: np.ndarray) -> np.ndarray:
    """The orthonormal Hadamard transform of rows whose width is a power of two."""
    n, width = rows.shape
    half = 1
    while half < width:
        pairs = rows.reshape(n, width // (2 * half), 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, width)
        half *= 2
    return rows / np.sqrt(width)


def _usable(values: list | None) -> bool:
    if not values or any(x is None for x in values):
        return False
    numbers = np.array(values, np.float64)
    return bool(np.isfinite(numbers).all() and numbers.any())


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one. A power of two first brings the largest component near one, so no square overflows."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    scaled = np.ldexp(vectors, -exponent)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


@tidy
def vector_links(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding).

    Rows link when the cosine of their vectors is ``threshold`` or more. Rows
    of equal vectors are compared as one and all link with one another. A row
    links with nothing if its vector is null, empty or zero or holds a null or
    non-finite component; nor does a row with a null id, which has no component and is not kept.
    Vectors of any width and length are compared, with those of their own width: between different
    widths there is no cosine. Repeated ids are rows of their own. An empty table gives an empty result. Other columns are not read.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            keys, widths = [], []
            for values in batch.column("embedding").to_pylist():
                if _usable(values):
                    raw = (np.array(values, np.float64) + 0.0).tobytes()
                    keys.append(hashlib.blake2b(raw, digest_size=16).digest())
                    widths.append(len(values))
                else:
                    keys.append(None)
                    widths.append(0)
            yield {"vec_id": batch.column("vec_id"), "vector_key": keys, "width": widths, "embedding": batch.column("embedding")}

    found = stored(
        map_task(
            vectors.select(
                F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
            ),
            describe,
            "vec_id long, vector_key binary, width int, embedding array<double>",
        ).withColumn("row_no", F.monotonically_increasing_id()),
        "vectors",
    )
    usable = F.col("vector_key").isNotNull() & F.col("vec_id").isNotNull()
    nodes = stored(
        found.where(usable)
        .groupBy("vector_key", "width")
        .agg(
            F.min("row_no").alias("node"),
            F.min("vec_id").alias("first_id"),
            F.count("*").alias("rows"),
        ),
        "vector-nodes",
    )
    # K widths with two vectors each take more than K * K numbers, so few fit into any table.
    several = nodes.groupBy("width").count().where("count > 1").collect()
    own = found.select(F.col("row_no").alias("node"), "width", "embedding").join(nodes.select("node", "rows"), "node")
    listed = _filtered(own, {r["width"] for r in several}, sum(r["count"] for r in several))
    compared = stored(_compare(listed, threshold), "vector-compared")
    counts = compared.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(
        compared.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    )
    named = (
        nodes.join(linked, "node", "left")
        .join(counts, "node", "left")
        .select(
            "vector_key",
            "first_id",
            F.coalesce("component", "node").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"),
        )
    )
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_vector = named.join(smallest, "component").select("vector_key", "n_links", "component_id")
    rows = found.select("vec_id", "vector_key", usable.alias("usable"))
    alone = rows.where(~F.coalesce("usable", F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        rows.where("usable")
        .join(by_vector, "vector_key")
        .select("vec_id", "n_links", "component_id")
        .unionByName(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


def _filtered(nodes: DataFrame, widths: set[int], vectors: int) -> DataFrame:
    """(width, node, rows, unit, filters) per node of one of the widths."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            width = batch.column("width").to_numpy()
            for here in np.unique(width).tolist():
                if here not in widths:
                    continue
                rows = batch.filter(pa.array(width == here))
                unit = _unit(np.array(rows.column("embedding").to_pylist(), np.float64))
                yield {
                    "width": rows.column("width"),
                    "node": rows.column("node"),
                    "rows": rows.column("rows"),
                    "unit": [row.tobytes() for row in unit],
                    "filters": list(CapCodes.fitting(vectors, here).filters(unit)),
                }

    listed = map_task(
        nodes.select("width", "node", "rows", "embedding"),
        decode,
        "width int, node long, rows long, unit binary, filters array<long>",
    )
    return stored(listed, "vector-filters")


def _compare(listed: DataFrame, threshold: float) -> DataFrame:
    """(node, links) with the number of rows linked, and (node, other) of links that span."""
    members = listed.select("width", F.explode("filters").alias("filter"), "node")
    # Filters of one vector are gone before vectors travel.
    sizes = (
        members.groupBy("width", "filter")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("width", "filter", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    )
    block = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    paired = (
        members.join(sizes, ["width", "filter"])
        .withColumn("block", block)
        .select(
            "width", "filter", "node", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("met")
        )
        .select(
            "width",
            "filter",
            "node",
            F.least("block", "met").alias("low"),
            F.greatest("block", "met").alias("high"),
            "block",
        )
    )
    loaded = (
        paired.join(listed.drop("width"), "node")
        .repartition("width", "filter", "low", "high")
        .sortWithinPartitions("width", "filter", "low", "high", "node")
        .select("width", "filter", "low", "high", "block", "node", "rows", "unit", "filters")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """Rows of two blocks of a filter follow one another."""
        last, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:4] != last:
                    yield from links(last, rows)
                    last, rows = row[:4], []
                rows.append(row[4:])
        yield from links(last, rows)

    def links(key: tuple | None, rows: list[tuple]) -> Iterator[dict]:
        if len(rows) < 2:
            return
        _, here, low, high = key
        blocks = np.array([r[0] for r in rows])
        left, right = np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)
        if not len(left) or not len(right):
            return
        unit = np.array([np.frombuffer(r[3], np.float64) for r in rows])
        alike = unit[left] @ unit[right].T >= threshold
        if low == high:
            alike = np.triu(alike, 1)
        if not alike.any():
            return
        earlier = [[f for f in r[4] if f < here] for r in rows]
        alike &= ~_share(earlier, left, right)
        weights = np.array([r[2] for r in rows], np.int64)
        counts = np.zeros(len(rows), np.int64)
        np.add.at(counts, left, alike @ weights[right])
        np.add.at(counts, right, alike.T @ weights[left])
        some = np.flatnonzero(counts)
        if len(some):
            nodes = [r[1] for r in rows]
            spanning = _spanning(len(rows), left, right, alike)
            yield {
                "node": [nodes[i] for i in some] + [nodes[i] for i, _ in spanning],
                "links": [*counts[some].tolist(), *[None] * len(spanning)],
                "other": [None] * len(some) + [nodes[j] for _, j in spanning],
            }

    return map_task(loaded, compare, "node long, links long, other long")


def _share(lists: list[list[int]], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of the left and right rows have a number in common."""
    width = [len(x) for x in lists]
    numbers = np.concatenate([np.array(x, np.int64) for x in lists])
    owner = np.repeat(np.arange(len(lists)), width)
    distinct, column, count = np.unique(numbers, return_inverse=True, return_counts=True)
    often = count > 1
    place = np.cumsum(often) - 1
    cells = np.zeros((len(lists), int(often.sum())), np.float32)
    kept = often[column]
    cells[owner[kept], place[column[kept]]] = 1
    return cells[left] @ cells[right].T > 0


def _spanning(n: int, left: np.ndarray, right: np.ndarray, alike: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the matrix connects, fewer than ``n``."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    found = []
    for k, i in enumerate(left.tolist()):
        for j in right[alike[k]].tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[b] = a
                found.append((i, j))
    return found

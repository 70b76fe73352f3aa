"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's shingles are put in one global order, rare ones first. Let a
document's prefix be its first n - ceil(t * n) + l shingles. Two documents
with a similarity of t or more share at least the smaller of their two l's in
their prefixes: of the document whose prefix ends first, at most
ceil(t * n) - l shingles are outside it. Each document picks the l for which
the estimated cost of its candidates is least: a larger l lengthens the prefix
a little and rids it of documents that only have a passage in common.
Documents that share enough are compared in full.

The order comes from a count sketch of fixed size over all documents; any
order gives the right result. Documents with equal sets are one node. In the
first round each shingle's documents are compared with one of them only, the
one whose prefix is shared most, which merges groups of near copies without
pairing their members. In the second round documents stand in blocks, by the
one they share most with, and pairs of blocks that share enough are compared
in full, but for blocks of one and the same component. So no link between
components is missed, and no pairs of documents are written but links.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_stored, map_task, stored, tidy
from .components import components
from .shingles import Shingler, common_counts, similar

PERCENT = 80
SKETCH_BITS = 20
SLICE = 1 << 14  # counters whose counts travel in one row
MOST_MATCHES = 64
PASSAGE = 30.0  # mean number of shingles that documents with a common passage share
FREQUENT = 10_000  # documents from which on a shingle's rows are not brought together
BLOCK = 128  # documents that are compared with as many in one group of rows
VERIFY_COST = 300.0  # of one full comparison, in units of one shingle of a prefix


@dataclass(frozen=True)
class ShingleOrder:
    """Frequencies above the noise of the sketch, as steps of a logarithmic scale."""

    steps: np.ndarray

    @staticmethod
    def slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """Ascending in the global order: the step, then the lower bits of the hash."""
        steps = self.steps[self.slot(hashes)].astype(np.uint64)
        return (steps << np.uint64(56)) | (hashes & np.uint64((1 << 56) - 1))

    @staticmethod
    def frequencies(keys: np.ndarray) -> np.ndarray:
        return np.exp2((keys >> np.uint64(56)).astype(float) / 8) - 1


def shingle_order(docs: DataFrame) -> ShingleOrder:
    """Count in how many documents the shingles of each slot occur, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shingler = Shingler()
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            found = [shingler.shingles(text) for text in batch.column("text").to_pylist()]
            slots = ShingleOrder.slot(np.concatenate(found))
            counts += np.bincount(slots, minlength=len(counts))
        for number in range(len(counts) // SLICE):
            piece = counts[number * SLICE : (number + 1) * SLICE]
            if piece.any():
                yield {"slice": [number], "counts": [zlib.compress(piece.astype("<u4").tobytes(), 1)]}

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SLICE, np.int64)
        for counts in rows["counts"]:
            total += np.frombuffer(zlib.decompress(counts), "<u4")
        return pd.DataFrame({"slice": [rows["slice"].iloc[0]], "counts": [total.tobytes()]})

    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    # One row per slice: the sketch has a fixed size.
    for row in (
        map_task(docs.select("text"), count, "slice int, counts binary")
        .groupBy("slice")
        .applyInPandas(add, "slice int, counts binary")
        .collect()
    ):
        counts[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = np.frombuffer(row.counts, np.int64)
    usual = float(np.median(counts))
    above = np.maximum(0, counts - usual - 3 * np.sqrt(usual))
    return ShingleOrder(np.minimum(255, np.round(8 * np.log2(1 + above))).astype(np.uint8))


def choose_matches(frequencies: np.ndarray, n: int, base: int, needed: int) -> int:
    """How many matches to ask for, by the estimated cost of the candidates.

    ``frequencies`` of a set of ``n`` in the global order, ``base`` the length
    of the prefix for one match, ``needed`` the least intersection. Each
    shingle of the prefix costs its lookup. Documents that come up are one and
    those the frequencies tell of; they share a passage of exponential length,
    and are compared if enough of it is in the prefix.
    """
    asked = np.arange(1, min(MOST_MATCHES, needed) + 1)
    length = base + asked - 1
    met = 1 + np.cumsum(frequencies)[np.minimum(length, len(frequencies)) - 1]
    compared = met * np.exp(-asked * n / (length * PASSAGE))
    return int(np.argmin(length + VERIFY_COST * compared)) + 1


def prefixes(docs: DataFrame, order: ShingleOrder, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, set_key, matches, weight, prefix) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(order.steps)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shingler, order = Shingler(), ShingleOrder(shared.value)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                hashes = shingler.shingles(text)
                n = len(hashes)
                if not n:
                    rows.append((0, None, 0, []))
                    continue
                needed = -(-percent * n // 100)
                base = n - needed + 1
                keys = order.keys(hashes)
                longest = min(n, base + MOST_MATCHES - 1)
                if longest < n:
                    keys = np.partition(keys, longest - 1)[:longest]
                keys.sort()
                matches = choose_matches(order.frequencies(keys), n, base, needed)
                key = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
                rows.append((n, key, matches, keys[: base + matches - 1].view(np.int64)))
            sizes, set_keys, matches, found = zip(*rows)
            yield {
                "doc_id": batch.column("doc_id"),
                "n_shingles": sizes,
                "set_key": set_keys,
                "matches": matches,
                "prefix": found,
            }

    return map_task(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        find,
        "doc_id long, n_shingles long, set_key binary, matches int, prefix array<long>",
    )


def _sizes_permit(a: str, b: str, percent: int) -> Column:
    small, large = F.least(a, b), F.greatest(a, b)
    return 100 * small >= percent * large


@tidy
def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``, repeated rows each.

    Rows link when their sets of five-word shingles have a Jaccard similarity
    of ``percent`` or more. component_id is the smallest doc_id that links
    reach; rows that share an id are one document. A null text counts as an empty one; a text without words links with
    nothing, and a row whose doc_id is null neither links nor has a component.
    Empty tables give an empty result. Other columns are not read.
    """
    order = shingle_order(docs)
    spark = docs.sparkSession
    found = stored(prefixes(docs, order, percent), "jaccard-prefixes")
    linkable = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    # Rows of equal sets are one node, numbered by a hash that must not collide.
    for seed in range(8):
        numbered = found.where(linkable).withColumn("node", F.xxhash64("set_key", F.lit(seed)))
        nodes = stored(
            numbered.groupBy("set_key", "node").agg(F.min("doc_id").alias("first_id")),
            "jaccard-nodes",
        )
        collided = nodes.groupBy("node").count().where("count > 1")
        if not collided.take(1):
            break
    else:
        raise RuntimeError("too many different texts to number them by 64 bits")
    shared = stored(_shared_shingles(numbered), "jaccard-shared")
    # The prefixes are most of what is stored, and not read again.
    found = stored(found.drop("prefix", "matches"), "jaccard-rows")
    numbered = found.where(linkable).withColumn("node", F.xxhash64("set_key", F.lit(seed)))
    drop_stored(spark, "jaccard-prefixes")
    texts = _texts(docs, numbered, shared)
    star = stored(_with_pivot(shared, percent), "jaccard-star")
    edges = [stored(_verified(star, texts, percent), "jaccard-star-edges")]
    merged = components(edges[0])
    edges.append(stored(_across(shared, merged, star, texts, percent), "jaccard-across-edges"))
    # Rows that share an id are one document.
    ids = numbered.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("high"))
    several = ids.where("a < high").select("doc_id", "a")
    edges.append(
        numbered.join(several, "doc_id").select("a", F.col("node").alias("b")).where("a <> b").distinct()
    )
    linked = components(edges[0].unionByName(edges[1]).unionByName(edges[2]))
    named = nodes.join(linked, "node", "left").select(
        "set_key", "first_id", F.coalesce("component", "node").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_set = named.join(smallest, "component").select("set_key", "component_id")
    rows = found.select("doc_id", "n_shingles", "set_key")
    alone = rows.where(~linkable).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return (
        rows.where(linkable)
        .join(by_set, "set_key")
        .select("doc_id", "n_shingles", "component_id")
        .unionByName(alone)
    )


def _shared_shingles(numbered: DataFrame) -> DataFrame:
    """(shingle, node, n, matches, c, least) of the shingles in the prefixes of two nodes or more.

    ``c`` counts the rows of the shingle, ``least`` is the smallest of their matches.
    """
    rows = numbered.select(
        F.explode("prefix").alias("shingle"),
        "node",
        F.col("n_shingles").alias("n"),
        "matches",
    )
    step = F.shiftrightunsigned("shingle", 56)
    frequent = step >= round(8 * np.log2(1 + FREQUENT))
    together = Window.partitionBy("shingle")
    # By the sketch, a shingle of these has a bounded number of rows.
    few = (
        rows.where(~frequent)
        .select(
            "*",
            F.min("node").over(together).alias("low"),
            F.max("node").over(together).alias("high"),
            F.count("*").over(together).alias("c"),
            F.min("matches").over(together).alias("least"),
        )
        .where("low < high")
        .drop("low", "high")
    )
    # Counted inside the map tasks first, so a frequent shingle is one row per task.
    many = rows.where(frequent)
    counted = many.groupBy("shingle").agg(F.count("*").alias("c"), F.min("matches").alias("least"))
    return few.unionByName(many.join(counted, "shingle")).dropDuplicates(["shingle", "node"])


def _texts(docs: DataFrame, numbered: DataFrame, shared: DataFrame) -> DataFrame:
    """(node, text) of the nodes that share as many shingles as a partner of theirs asks for."""
    some = shared.groupBy("node").agg(F.count("*").alias("own"), F.min("least").alias("least"))
    wanted = stored(
        numbered.join(some.where("own >= least"), "node")
        .groupBy("node", "set_key")
        .agg(F.min("doc_id").alias("doc_id")),
        "jaccard-wanted",
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id")
    repeated = numbered.groupBy("doc_id").count().where("count > 1")
    if not repeated.take(1):
        return stored(rows.select("node", "text"), "jaccard-texts")

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """A repeated doc_id brings texts of other nodes along; they are left out."""
        shingler = Shingler()
        for batch in batches:
            keys, texts = batch.column("set_key").to_pylist(), batch.column("text").to_pylist()
            kept = [
                hashlib.blake2b(shingler.shingles(t).tobytes(), digest_size=16).digest() == key
                for key, t in zip(keys, texts)
            ]
            some = batch.filter(pa.array(kept, pa.bool_()))
            yield {"node": some.column("node"), "text": some.column("text")}

    found_texts = map_task(rows.select("node", "set_key", "text"), own, "node long, text string")
    return stored(found_texts.dropDuplicates(["node"]), "jaccard-texts")


def _with_pivot(shared: DataFrame, percent: int) -> DataFrame:
    """(a, b, common): each node with the pivots of its shingles, where sizes and matches permit.

    The pivot of a shingle is the node whose prefix is shared most often.
    """
    degrees = shared.groupBy("node").agg(F.sum("c").alias("degree"))
    ranked = shared.join(degrees, "node")
    pivots = ranked.groupBy("shingle").agg(
        F.max(F.struct("degree", "node", "n", "matches")).alias("pivot")
    )
    return (
        shared.join(pivots, "shingle")
        .where(F.col("node") != F.col("pivot.node"))
        .select(
            F.col("pivot.node").alias("a"),
            F.col("node").alias("b"),
            F.col("pivot.n").alias("n_a"),
            F.col("n").alias("n_b"),
            F.least("matches", "pivot.matches").alias("needed"),
        )
        .where(_sizes_permit("n_a", "n_b", percent))
        .groupBy("a", "b")
        .agg(F.count("*").alias("common"), F.max("needed").alias("needed"))
        # A pair may share other shingles under other pivots; the second round sees to those.
        .where("2 * common >= needed")
        .select("a", "b", "common")
    )


def _blocks(shared: DataFrame, merged: DataFrame, star: DataFrame) -> DataFrame:
    """(shingle, node, n, matches, component, block, whole) of shingles of two components or more.

    Nodes that share most with the same pivot stand together in blocks of
    bounded size, apart by whether they are in the pivot's component. ``whole``
    is the component of such a block, and null for blocks of several components.
    """
    pivot_of = star.groupBy("b").agg(F.max_by("a", F.struct("common", "a")).alias("pivot"))
    component = merged.select("node", "component")
    places = (
        shared.select("node")
        .distinct()
        .join(pivot_of.withColumnRenamed("b", "node"), "node", "left")
        .join(component, "node", "left")
        .select("node", F.coalesce("pivot", "node").alias("pivot"), F.coalesce("component", "node").alias("component"))
        .join(
            component.select(F.col("node").alias("pivot"), F.col("component").alias("its")),
            "pivot",
            "left",
        )
        .withColumn("inside", F.col("component") == F.coalesce("its", "pivot"))
    )
    counts = places.groupBy("pivot", "inside").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    block = F.struct("pivot", "inside", F.pmod(F.xxhash64("node"), "parts").alias("part"))
    placed = places.join(counts, ["pivot", "inside"]).select(
        "node", "component", block.alias("block"), F.when(F.col("inside"), F.col("component")).alias("whole")
    )
    labelled = shared.select("shingle", "node", "n", "matches").join(placed, "node")
    # Shingles of one component only are gone before any pairing.
    mixed = (
        labelled.groupBy("shingle")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("shingle")
    )
    return labelled.join(mixed, "shingle", "left_semi")


def _across(shared: DataFrame, merged: DataFrame, star: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between different components, one for two components of two blocks.

    Blocks are paired instead of nodes, where they share shingles enough and
    their sizes permit the similarity; a task compares the nodes of two blocks
    and gives only links.
    """
    spark = shared.sparkSession
    rows = stored(_blocks(shared, merged, star), "jaccard-mixed")
    drop_stored(spark, "jaccard-shared", "jaccard-star")
    bounds = rows.groupBy("block").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("matches").alias("needed")
    )
    # The bounds stand with each block, so that pairs are dropped where they would arise.
    groups = rows.groupBy("shingle", "block").agg(F.first("whole").alias("whole")).join(bounds, "block")

    def side(df: DataFrame, end: str) -> DataFrame:
        return df.select("*").toDF(*[c if c == "shingle" else f"{c}_{end}" for c in df.columns])

    apart = F.col("whole_l").isNull() | F.col("whole_r").isNull() | (F.col("whole_l") != F.col("whole_r"))
    met = (
        side(groups, "l")
        .join(side(groups, "r"), "shingle")
        .where((F.col("block_l") <= F.col("block_r")) & apart)
        .where(100 * F.col("most_l") >= percent * F.col("least_r"))
        .where(100 * F.col("most_r") >= percent * F.col("least_l"))
        .groupBy("block_l", "block_r")
        .agg(F.count("*").alias("common"), F.first(F.least("needed_l", "needed_r")).alias("needed"))
        .where("common >= needed")
        .select("block_l", "block_r")
    )
    met = stored(met.withColumn("pair", F.monotonically_increasing_id()), "jaccard-block-pairs")
    members = stored(
        rows.groupBy("block", "node").agg(
            F.first("component").alias("component"),
            F.first("n").alias("n"),
            F.first("matches").alias("matches"),
            F.sort_array(F.collect_list("shingle")).alias("prefix"),
        ),
        "jaccard-members",
    )
    drop_stored(spark, "jaccard-mixed")
    sides = met.select("pair", F.col("block_l").alias("block"), F.lit(0).alias("side")).unionByName(
        met.select("pair", F.col("block_r").alias("block"), F.lit(1).alias("side"))
    )
    # Texts follow for those nodes only that share enough of their prefixes with one of the other block.
    able = stored(_able(sides.join(members, "block"), percent), "jaccard-able")
    drop_stored(spark, "jaccard-members", "jaccard-block-pairs")
    loaded = (
        able.join(texts, "node")
        .select("pair", "side", "node", "component", "text")
        .repartition("pair")
        .sortWithinPartitions("pair", "side", "node")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """Rows of a pair of blocks follow one another."""
        shingler, last, sides = Shingler(), None, ([], [])
        for batch in batches:
            for pair, side, node, component, text in zip(*(c.to_pylist() for c in batch.columns)):
                if pair != last:
                    yield from links(*sides)
                    last, sides = pair, ([], [])
                sides[side].append((node, component, shingler.shingles(text)))
        yield from links(*sides)

    def links(left: list[tuple], right: list[tuple]) -> Iterator[dict]:
        if not left or not right:
            return
        sizes = [np.array([len(x) for _, _, x in side]) for side in (left, right)]
        common = common_counts([x for _, _, x in left], [x for _, _, x in right])
        alike = 100 * common >= percent * (sizes[0][:, None] + sizes[1][None, :] - common)
        found = {}
        for i, j in zip(*np.nonzero(alike)):
            ends = left[i][1], right[j][1]
            if ends[0] != ends[1]:
                found.setdefault(ends, (left[i][0], right[j][0]))
        if found:
            a, b = zip(*found.values())
            yield {"a": a, "b": b}

    return map_task(loaded, compare, "a long, b long")


def _able(members: DataFrame, percent: int) -> DataFrame:
    """(pair, side, node, component) of the nodes that may link with one of the pair's other block.

    Two nodes may if their sizes permit it, their components differ, and their
    prefixes share as many shingles as the smaller of their matches.
    """

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        last, sides = None, ([], [])
        for batch in batches:
            for pair, side, *node in zip(*(c.to_pylist() for c in batch.columns)):
                if pair != last:
                    yield from found(last, *sides)
                    last, sides = pair, ([], [])
                sides[side].append(node)
        yield from found(last, *sides)

    def found(pair: int | None, left: list[list], right: list[list]) -> Iterator[dict]:
        if not left or not right:
            return
        columns = [[np.array(c) for c in list(zip(*side))[1:4]] for side in (left, right)]
        (component, n, matches), (component_r, n_r, matches_r) = columns
        sets = [[np.array(node[4]) for node in side] for side in (left, right)]
        may = common_counts(*sets) >= np.minimum(matches[:, None], matches_r[None, :])
        may &= component[:, None] != component_r[None, :]
        may &= 100 * np.minimum(n[:, None], n_r[None, :]) >= percent * np.maximum(n[:, None], n_r[None, :])
        for side, nodes, able in ((0, left, may.any(axis=1)), (1, right, may.any(axis=0))):
            some = [node for node, ok in zip(nodes, able) if ok]
            if some:
                yield {
                    "pair": [pair] * len(some),
                    "side": [side] * len(some),
                    "node": [node[0] for node in some],
                    "component": [node[1] for node in some],
                }

    together = (
        members.select("pair", "side", "node", "component", "n", "matches", "prefix")
        .repartition("pair")
        .sortWithinPartitions("pair", "side", "node")
    )
    return map_task(together, choose, "pair long, side int, node long, component long")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole texts are as similar as asked for."""
    text_a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    text_b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    # The text of ``a``, which may have many partners, is joined last and not moved again.
    both = pairs.join(text_b, "b").join(text_a, "a").select("a", "b", "text_a", "text_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shingler = Shingler()
        last, set_a = None, None
        for batch in batches:
            kept = []
            for a, text_a, text_b in zip(
                batch.column("a").to_pylist(),
                batch.column("text_a").to_pylist(),
                batch.column("text_b").to_pylist(),
            ):
                if a != last:
                    last, set_a = a, shingler.shingles(text_a)
                kept.append(similar(set_a, shingler.shingles(text_b), percent))
            some = batch.filter(pa.array(kept, pa.bool_()))
            yield {"a": some.column("a"), "b": some.column("b")}

    return map_task(both, compare, "a long, b long")

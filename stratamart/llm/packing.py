"""Best-fit packing of documents into sequences, in bulk-synchronous rounds.

Items and the gaps of open sequences are sorted by size into ranges. A sweep
runs down the sizes: an item takes the smallest gap seen so far that nobody
has taken, which is its best fit; items that meet at the same gap are ranked,
the larger first, and the next one takes the next larger gap. Each task sweeps
its range; what it cannot match is matched with earlier ranges by rank, from
two counts per range. Gaps are updated and the round repeats.

Items are placed in bands of falling size, so that small ones are left to fill
up. Once items are small and outnumber the gaps, a round lays gaps and items
end to end, largest first, and an item takes the gap it falls into, unless it
straddles a border. When no item fits, as many sequences are opened as the
rest needs at least. Rounds are the same at every size: a table that fits one
range is swept in one part, and is packed as it would be in many.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import joined_batches, map_batches, map_task, stored, tasks_for, tidy
from .scan import running_sums
from .tokens import CODED_BYTES, WordCoder, broadcast_vocabulary

CAPACITY = 4096
# Shares of the capacity above which items are placed before smaller ones.
BANDS = (3 / 16, 3 / 64, 3 / 256, 0.0)
SMALL = 1 / 8  # largest item, as a share of the capacity, of a round that lays items end to end
ROWS_PER_TASK = 100_000  # of a range
BLOCK = 256  # capacities whose gaps and items one group of rows holds when laid end to end


def document_pieces(
    docs: DataFrame,
    vocabulary_path: str,
    end_id: int = 1,
    capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, and ids on demand) of every whole text.

    A text's ids with ``end_id`` are cut into pieces of ``capacity`` ids; the
    last may be shorter. A null text is an empty one. Repeated rows give their
    pieces each.
    """
    shared = broadcast_vocabulary(docs.sparkSession, vocabulary_path)
    end = np.array([end_id], "<u4").tobytes()
    width = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder = WordCoder(shared.value)
        for batch in joined_batches(batches, CODED_BYTES):
            rows = []
            coded = coder.encode_all(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), coded):
                ids += end
                for piece, at in enumerate(range(0, len(ids), width)):
                    rows.append((doc_id, piece, at // 4, ids[at : at + width]))
            doc_ids, numbers, starts, contents = zip(*rows)
            columns = {
                "doc_id": doc_ids,
                "piece": numbers,
                "start": starts,
                "length": [len(x) // 4 for x in contents],
                "ids_crc32": [zlib.crc32(x) for x in contents],
            }
            yield columns | ({"ids": contents} if keep_ids else {})

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_task(kept, cut, schema + (", ids binary" if keep_ids else ""))


@tidy
def pack(pieces: DataFrame, capacity: int = CAPACITY, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` of 1 to ``capacity``.

    Offsets in a sequence are gapless from 0. Rows as long as the capacity have
    a sequence of their own, with a negative number. An empty table gives an
    empty result.
    """
    pieces = stored(pieces.withColumn("piece_no", F.monotonically_increasing_id()), "pieces")
    short = pieces.where(F.col("length") < capacity).select("piece_no", "length")
    placed = _Packer(pieces.sparkSession, capacity, rows_per_task).place(short)
    inside = Window.partitionBy("bin").orderBy("piece_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.select(
        "piece_no",
        F.col("bin").alias("sequence_id"),
        F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"),
    )
    whole = pieces.where(F.col("length") == capacity).select(
        "piece_no",
        (-1 - F.col("piece_no")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return pieces.join(offsets.unionByName(whole), "piece_no").drop("piece_no")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of packed pieces with their ids; at most one capacity of ids per row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(parts.alias("parts"))

    def flatten(batch: pa.RecordBatch) -> dict:
        rows = batch.column("parts").to_pylist()
        ids = [np.frombuffer(b"".join(p["ids"] for p in row), "<u4").astype(np.int32) for row in rows]
        return {"sequence_id": batch.column("sequence_id"), "ids": ids}

    return map_batches(joined, flatten, "sequence_id long, ids array<int>")


def sweep_matches(closes: list[int], opens: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Which ranges' left-over items take which earlier ranges' left-over gaps.

    ``closes`` and ``opens`` count the items and gaps that each range left.
    Gives (range of items, first item, how many, range of gaps, first gap):
    items count up, gaps count down from the last one left.
    """
    free: list[list[int]] = []
    found = []
    for here, (items, gaps) in enumerate(zip(closes, opens)):
        first = 0
        while first < items and free:
            there, left = free[-1]
            n = min(items - first, left)
            found.append((here, first, n, there, left - 1))
            first += n
            free[-1][1] -= n
            if not free[-1][1]:
                free.pop()
        if gaps:
            free.append([here, gaps])
    return found


class _Packer:
    """The state between rounds: items left, gaps left, and what has been placed."""

    def __init__(self, spark: SparkSession, capacity: int, rows_per_task: int) -> None:
        self.spark, self.capacity, self.rows_per_task = spark, capacity, rows_per_task
        self.opened = 0
        self.placed: list[DataFrame] = []

    def open(self, count: int) -> DataFrame:
        ids = self.spark.range(self.opened, self.opened + count)
        self.opened += count
        return ids.select(
            F.col("id").alias("bin"), F.lit(self.capacity).cast("long").alias("gap")
        )

    def place(self, short: DataFrame) -> DataFrame:
        """(piece_no, length, bin) of all rows of (piece_no, length)."""
        whole = self._items(short)
        gaps = self.open(self._least(whole))
        high = self.capacity
        for share in BANDS:
            low = int(share * self.capacity)
            band = short.where((F.col("length") > low) & (F.col("length") <= high))
            gaps = self._band(band, gaps)
            high = low
        empty = short.select("*", F.lit(None).cast("long").alias("bin")).where("false")
        for part in self.placed:
            empty = empty.unionByName(part)
        return empty

    def _least(self, items) -> int:
        """Sequences that these items need at least."""
        return max(-(-items.total // self.capacity), items.large)

    def _items(self, items: DataFrame):
        return items.agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum("length"), F.lit(0)).alias("total"),
            F.coalesce(F.min("length"), F.lit(0)).alias("smallest"),
            F.coalesce(F.max("length"), F.lit(0)).alias("largest"),
            F.count(F.when(F.col("length") * 2 > self.capacity, 1)).alias("large"),
        ).first()

    def _band(self, items: DataFrame, gaps: DataFrame) -> DataFrame:
        """Place all items; the gaps that are left."""
        resting: list[DataFrame] = []
        progress, laid_badly = True, False
        now = self._items(items)
        while now.n:
            resting.append(gaps.where(F.col("gap") < now.smallest))
            gaps = gaps.where(F.col("gap") >= now.smallest)
            n_gaps = gaps.count()
            if not n_gaps or not progress:
                more = self._least(now)
                gaps, n_gaps = gaps.unionByName(self.open(more)), n_gaps + more
            small = now.largest <= SMALL * self.capacity
            lay = small and now.n > n_gaps and not laid_badly
            if lay:
                items, gaps = self._lay(items, gaps, now.n, n_gaps)
            else:
                items, gaps = self._sweep(items, gaps, now.n + n_gaps)
            left = self._items(items)
            laid_badly = lay and now.n - left.n < now.n / 2
            progress = left.n < now.n
            now = left
        for rest in resting:
            gaps = gaps.unionByName(rest)
        # Stored once a band, or every later round would read all rounds so far.
        return stored(gaps, "pack-resting") if resting else gaps

    def _keep(self, matched: DataFrame) -> None:
        self.placed.append(matched.select("piece_no", "length", "bin"))

    def _sweep(self, items: DataFrame, gaps: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
        """One item for each gap at most; the items and gaps that are left."""
        both = items.select(
            F.col("length").alias("size"), F.lit(1).alias("kind"), F.col("piece_no").alias("id")
        ).unionByName(
            gaps.select(F.col("gap").alias("size"), F.lit(0).alias("kind"), F.col("bin").alias("id"))
        )
        parts = tasks_for(rows, self.rows_per_task)
        order = (F.col("size").desc(), F.col("kind"), F.col("id"))
        dealt = both.repartitionByRange(parts, *order).sortWithinPartitions(*order)

        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            here = TaskContext.get().partitionId()
            free: list[tuple[int, int]] = []
            unmatched = 0
            for batch in batches:
                rows = []
                columns = (batch.column(i).to_pylist() for i in range(3))
                for size, kind, number in zip(*columns):
                    if kind == 0:
                        free.append((number, size))
                    elif free:
                        rows.append((number, size, *free.pop(), None))
                    else:
                        rows.append((number, size, None, None, unmatched))
                        unmatched += 1
                if rows:
                    yield out(rows, here)
            for start in range(0, len(free), 10_000):
                some = free[start : start + 10_000]
                yield out([(None, None, b, g, start + i) for i, (b, g) in enumerate(some)], here)

        def out(rows: list[tuple], here: int) -> dict:
            names = ("piece_no", "length", "bin", "gap", "place")
            return dict(zip(names, zip(*rows))) | {"range_no": [here] * len(rows)}

        swept = stored(
            map_task(
                dealt, match, "piece_no long, length long, bin long, gap long, place long, range_no int"
            ),
            "pack-sweep",
        )
        left_items, left_gaps = swept.where("bin is null"), swept.where("piece_no is null")
        self._keep(swept.where("place is null"))
        updated = swept.where("place is null").select("bin", (F.col("gap") - F.col("length")).alias("gap"))
        matches = self._matches(swept)
        if not matches:
            return (
                left_items.select("piece_no", "length"),
                left_gaps.select("bin", "gap").unionByName(updated).where("gap > 0"),
            )
        # At most two rows per range.
        runs = F.broadcast(
            self.spark.createDataFrame(
                matches, "range_no int, first long, n long, gap_range int, gap_place long"
            )
        )
        in_run = (left_items["range_no"] == runs["range_no"]) & left_items["place"].between(
            runs["first"], runs["first"] + runs["n"] - 1
        )
        wanted = left_items.join(runs, in_run, "left").select(
            "piece_no",
            "length",
            F.col("gap_range").alias("range_no"),
            (F.col("gap_place") - F.col("place") + F.col("first")).alias("place"),
        )
        # Items that no run takes have no key, so they stay out of the join.
        without = wanted.where("place is null").select(
            "piece_no",
            "length",
            F.lit(None).cast("long").alias("bin"),
            F.lit(None).cast("long").alias("gap"),
        )
        resolved = stored(
            wanted.where("place is not null")
            .join(left_gaps.select("range_no", "place", "bin", "gap"), ["range_no", "place"], "full")
            .drop("range_no", "place")
            .unionByName(without),
            "pack-resolve",
        )
        taken = resolved.where("piece_no is not null and bin is not null")
        self._keep(taken)
        gaps_left = (
            resolved.where("piece_no is null")
            .select("bin", "gap")
            .unionByName(taken.select("bin", (F.col("gap") - F.col("length")).alias("gap")))
            .unionByName(updated)
        )
        return (
            resolved.where("bin is null").select("piece_no", "length"),
            gaps_left.where("gap > 0"),
        )

    def _matches(self, swept: DataFrame) -> list[tuple[int, int, int, int, int]]:
        """From two counts per range, which are few."""
        counts = (
            swept.where("place is not null")
            .groupBy("range_no")
            .agg(F.count("piece_no").alias("items"), F.count("bin").alias("gaps"))
            .collect()
        )
        last = max((r.range_no for r in counts), default=-1) + 1
        closes, opens = [0] * last, [0] * last
        for r in counts:
            closes[r.range_no], opens[r.range_no] = r["items"], r["gaps"]
        return sweep_matches(closes, opens)

    def _lay(
        self, items: DataFrame, gaps: DataFrame, n_items: int, n_gaps: int
    ) -> tuple[DataFrame, DataFrame]:
        """Items into the gaps they fall into when both are laid end to end."""
        laid_items = running_sums(
            items,
            [F.col("length").desc(), F.col("piece_no")],
            {"at": "length"},
            rows=n_items,
            rows_per_task=self.rows_per_task,
            purpose="pack-items",
        )
        laid_gaps = running_sums(
            gaps,
            [F.col("gap").desc(), F.col("bin")],
            {"at": "gap"},
            rows=n_gaps,
            rows_per_task=self.rows_per_task,
            purpose="pack-gaps",
        )
        block = BLOCK * self.capacity
        first = F.floor(F.col("at") / block).cast("long")
        last = F.floor((F.col("at") + F.col("gap") - 1) / block).cast("long")
        # A gap that reaches into a second block is known there too.
        both = laid_gaps.select(
            F.explode(F.array_distinct(F.array(first, last))).alias("block"),
            "at",
            F.lit(0).alias("kind"),
            F.col("bin").alias("id"),
            F.col("gap").alias("size"),
        ).unionByName(
            laid_items.select(
                first.alias("block"),
                "at",
                F.lit(1).alias("kind"),
                F.col("piece_no").alias("id"),
                F.col("length").alias("size"),
            )
        )
        parts = tasks_for(n_items + n_gaps, self.rows_per_task)
        dealt = both.repartition(parts, "block").sortWithinPartitions("block", "at", "kind", "id")

        def fall(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            block, end, into = None, 0, None
            for batch in batches:
                rows = []
                columns = (batch.column(i).to_pylist() for i in range(5))
                for here, at, kind, number, size in zip(*columns):
                    if here != block:
                        block, end, into = here, 0, None
                    if kind == 0:
                        into, end = number, at + size
                    else:
                        fits = into is not None and at + size <= end
                        rows.append((number, size, into if fits else None))
                if rows:
                    yield dict(zip(("piece_no", "length", "bin"), zip(*rows)))

        fallen = stored(map_task(dealt, fall, "piece_no long, length long, bin long"), "pack-lay")
        placed = fallen.where("bin is not null")
        self._keep(placed)
        used = placed.groupBy("bin").agg(F.sum("length").alias("used"))
        gaps_left = stored(
            gaps.join(used, "bin", "left").select(
                "bin", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap")
            ),
            "pack-gaps-left",
        )
        return (
            fallen.where("bin is null").select("piece_no", "length"),
            gaps_left.where("gap > 0"),
        )

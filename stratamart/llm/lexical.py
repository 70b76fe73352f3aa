"""Ranked lexical search of whole texts, by grouping documents with the same presence mask.

A pass over the texts keeps, per document, its number of terms and how often it
holds each query term. From these come the corpus counts and the terms' weights.
A second pass reads the kept rows in blocks. In a block every query term has a
bitmap of the documents that hold it. For an item the bitmaps of its terms,
turned, give each document's mask of matched terms; documents are grouped by
equal masks. The most that any document of a group can score follows from its
mask and the best share of each term in the block. Groups are scored exactly in
descending order of this maximum, until it is below the item's k-th best score.
A task keeps its best documents of each item from block to block, so later
blocks stop sooner, and gives at most k rows per item.

Queries are worked on in blocks of a bounded number of (item, term) pairs, so
what is broadcast does not grow with the number of queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.operators.storage import drop_scratch, scratch_path

from .common import map_task, stored, tasks_for

TOP = 10
PAIRS_PER_BLOCK = 1_000_000  # (item, term) pairs that are broadcast at once
DOCS_PER_BLOCK = 8192
POSTINGS_PER_BLOCK = 4_000_000
MASKS_AT_A_TIME = 64  # documents, at least, that are scored before the bound is looked at again
TASKS_PER_SLICE = 1000  # of which the best rows meet in one group before all meet

# ASCII capitals are lowered; other ASCII bytes than letters and digits end a term.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, with repeats: runs of ASCII letters and digits and of all else."""
    return text.translate(_TERM_BYTES).split()


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of the best ``top`` rows of ``docs`` for each item.

    Scores are those of op11's contract: only rows above 0 count, equal scores
    go by ascending doc_id, a null doc_id last. A null text has no terms; a
    document or item without terms, or an empty table, gives no rows. Repeated
    document rows are ranked each; rows that share an item_id (null is one, too)
    are one item with the terms of all of them. Other columns are not read.
    """
    spark = docs.sparkSession
    pairs = stored(_item_terms(items).distinct(), "search-items")
    blocks = tasks_for(pairs.count(), PAIRS_PER_BLOCK)
    found = None
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block
        best = _search(docs, _collect(pairs.where(mine)), top, spark)
        found = best if found is None else found.unionByName(best)
    return found


def _item_terms(items: DataFrame) -> DataFrame:
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist())
            rows = [(item, term) for item, text in rows if text for term in set(terms_of(text))]
            yield {"item_id": [r[0] for r in rows], "term": [r[1] for r in rows]}

    kept = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary"))
    return map_task(kept, split, "item_id long, term binary")


@dataclass(frozen=True)
class _Query:
    """Items of a block of queries, with the numbers of their terms."""

    numbers: dict[bytes, int]
    items: list[tuple[int | None, np.ndarray]]


def _collect(pairs: DataFrame) -> _Query:
    numbers: dict[bytes, int] = {}
    items: dict[int | None, list[int]] = {}
    for row in pairs.collect():
        number = numbers.setdefault(bytes(row.term), len(numbers))
        items.setdefault(row.item_id, []).append(number)
    return _Query(numbers, [(i, np.sort(np.array(t, np.int64))) for i, t in items.items()])


def _search(docs: DataFrame, query: _Query, top: int, spark: SparkSession) -> DataFrame:
    """The best rows for a block of queries."""
    path = scratch_path(spark, "search-postings")
    postings = _postings(docs, query)
    postings.write.parquet(path)
    postings = spark.read.schema(postings.schema).parquet(path)
    counts = postings.agg(
        F.count(F.when(F.col("n") > 0, 1)).alias("docs"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("terms"),
    ).first()
    # At most as many rows as the block of queries has terms.
    holding = dict(
        postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    )
    weights = np.zeros(len(query.numbers), np.int64)
    for term, df in holding.items():
        weights[term] = math.floor(1000 * math.log((2 * counts.docs + 2) / (2 * df + 1)))
    shared = spark.sparkContext.broadcast((query.items, weights))
    averages = (counts.docs, counts.terms)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = shared.value
        leaders = {number: _Leaders(top) for number in range(len(items))}
        for block in _blocks(batches):
            _score_block(_Block(block, averages), items, weight, leaders)
        task = TaskContext.get().partitionId()
        for number, leader in leaders.items():
            if len(leader.scores):
                yield leader.rows(items[number][0], task)

    schema = "item_id long, slice int, doc_id long, score long"
    candidates = postings.where(F.size("terms") > 0).mapInArrow(best, schema)
    # Stored, since the kept postings go once the candidates are known.
    candidates = stored(candidates, "search-best")
    drop_scratch(spark, path)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["item_id", "slice"], ["item_id"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        candidates = candidates.withColumn("rank", rank).where(F.col("rank") <= top)
    return candidates.select("item_id", "rank", "doc_id", "score")


def _postings(docs: DataFrame, query: _Query) -> DataFrame:
    """(doc_id, n, terms, counts): a document's number of terms, and its query terms with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(query.numbers)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        number = shared.value.get
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column("text").to_pylist():
                words = terms_of(text or b"")
                known = [x for x in map(number, words) if x is not None]
                found, often = np.unique(np.array(known, np.int32), return_counts=True)
                sizes.append(len(words))
                terms.append(found)
                counts.append(often.astype(np.int32))
            yield {"doc_id": batch.column("doc_id"), "n": sizes, "terms": terms, "counts": counts}

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary"))
    return map_task(kept, count, "doc_id long, n long, terms array<int>, counts array<int>")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """A task's rows in blocks of bounded size."""
    waiting, rows, postings = [], 0, 0
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            waiting.append(part)
            rows += part.num_rows
            postings += len(part.column("terms").flatten())
            if rows >= DOCS_PER_BLOCK or postings >= POSTINGS_PER_BLOCK:
                yield pa.Table.from_batches(waiting)
                waiting, rows, postings = [], 0, 0
    if waiting:
        yield pa.Table.from_batches(waiting)


class _Leaders:
    """The best rows of an item so far."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.no_id = np.empty(0, bool)

    def least(self) -> int:
        """What a further row must score at least."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        able = scores >= self.least()
        scores = np.concatenate([self.scores, scores[able]])
        ids = np.concatenate([self.ids, ids[able]])
        no_id = np.concatenate([self.no_id, no_id[able]])
        order = np.lexsort((ids, no_id, -scores))[: self.top]
        self.scores, self.ids, self.no_id = scores[order], ids[order], no_id[order]

    def rows(self, item: int | None, task: int) -> pa.RecordBatch:
        n = len(self.scores)
        columns = {
            "item_id": pa.array([item] * n, pa.int64()),
            "slice": pa.array([task // TASKS_PER_SLICE] * n, pa.int32()),
            "doc_id": pa.array(self.ids, pa.int64(), mask=self.no_id),
            "score": pa.array(self.scores, pa.int64()),
        }
        return pa.RecordBatch.from_pydict(columns)


class _Block:
    """Postings of a block of documents, by document and as one bitmap per term."""

    def __init__(self, rows: pa.Table, averages: tuple[int, int]) -> None:
        rows = rows.combine_chunks()
        lists = rows.column("terms").combine_chunks()
        terms = lists.flatten().to_numpy()
        tf = rows.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
        n = rows.column("n").to_numpy()
        per_doc = np.asarray(lists.value_lengths())
        self.docs = len(n)
        self.starts = np.concatenate([[0], np.cumsum(per_doc)])
        owner = np.repeat(np.arange(self.docs), per_doc)
        documents, all_terms = averages
        length = 10 + np.array([90 * int(x) * documents // all_terms for x in n], np.int64)
        #: What each posting adds to a score, for a weight of one.
        self.share = (1_000_000_000 * tf) // (1000 * tf + 8 * length[owner])
        #: Numbers of the terms in this block, and each posting's place among them.
        self.terms, self.place = np.unique(terms, return_inverse=True)
        order = np.argsort(self.place, kind="stable")
        place, owner = self.place[order], owner[order]
        self.most = np.zeros(len(self.terms), np.int64)
        np.maximum.at(self.most, self.place, self.share)
        width = -(-self.docs // 8)
        byte = place * width + owner // 8
        first = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1]]))
        bitmaps = np.zeros(len(self.terms) * width, np.uint8)
        bitmaps[byte[first]] = np.bitwise_or.reduceat((128 >> (owner % 8)).astype(np.uint8), first)
        self.bitmaps = bitmaps.reshape(len(self.terms), width)
        ids = rows.column("doc_id").combine_chunks()
        self.no_id = np.asarray(ids.is_null())
        self.ids = ids.fill_null(0).to_numpy()

    def masks(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Presence of some terms (a row each), the documents' groups by mask, one document per group."""
        presence = np.unpackbits(self.bitmaps[places], axis=1, count=self.docs)
        packed = np.packbits(presence, axis=0)
        groups = np.zeros(self.docs, np.int64)
        for at in range(0, len(packed), 4):
            word = np.zeros(self.docs, np.int64)
            for row in packed[at : at + 4]:
                word = word << 8 | row
            _, groups = np.unique(groups << 32 | word, return_inverse=True)
        _, one = np.unique(groups, return_index=True)
        return presence, groups, one

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of documents, with a weight for each term of the block."""
        sizes = self.starts[docs + 1] - self.starts[docs]
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        at = np.arange(sizes.sum()) + np.repeat(self.starts[docs] - begins, sizes)
        return np.add.reduceat(weight[self.place[at]] * self.share[at], begins)


def _score_block(
    block: _Block,
    items: list[tuple[int | None, np.ndarray]],
    weights: np.ndarray,
    leaders: dict[int, _Leaders],
) -> None:
    for number, (_, terms) in enumerate(items):
        places = np.searchsorted(block.terms, terms)
        places = places[places < len(block.terms)]
        places = places[np.isin(block.terms[places], terms)]
        if not len(places):
            continue
        weight = np.zeros(len(block.terms), np.int64)
        weight[places] = weights[block.terms[places]]
        leader = leaders[number]
        if int(np.dot(weight, block.most)) < leader.least():
            continue
        presence, groups, one = block.masks(places)
        bound = (weight[places] * block.most[places]) @ presence[:, one].astype(np.int64)
        order = np.argsort(-bound, kind="stable")
        members = np.argsort(groups, kind="stable")
        ends = np.cumsum(np.bincount(groups, minlength=len(one)))
        begins = np.concatenate([[0], ends[:-1]])
        at = 0
        while at < len(order) and bound[order[at]] >= leader.least():
            some = []
            while at < len(order) and sum(map(len, some)) < MASKS_AT_A_TIME:
                if bound[order[at]] < leader.least():
                    break
                group = order[at]
                some.append(members[begins[group] : ends[group]])
                at += 1
            docs = np.concatenate(some)
            leader.add(block.scores(docs, weight), block.ids[docs], block.no_id[docs])

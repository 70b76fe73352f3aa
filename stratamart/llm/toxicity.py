"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes.

A text's features are the character n-grams of its distinct words, each once.
The naive Bayes log-count ratio of a feature says how much likelier it is in a
toxic text; a logistic regression is trained on the features scaled by these
ratios and by the length of the resulting vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_batches, map_task
from .labels import label_counts, labelled_sample, usable_labels

SHORTEST, LONGEST = 3, 6
BUCKETS = 1 << 20
SLICE = 1 << 13  # buckets whose counts travel in one row

# ASCII that is neither letter, digit nor apostrophe separates words, as white space does.
_SEPARATORS = bytes(
    b if b >= 128 or chr(b).isalnum() or b == 0x27 else 0x20 for b in range(256)
)
_FACTOR = np.uint32(0x01000193)
_MIX = np.uint32(0x9E3779B1)


def ngram_buckets(text: str | None) -> np.ndarray:
    """Hash buckets of the n-grams of the distinct words of ``text``, repeats included.

    A word carries a mark at either end, so n-grams know where words begin and end.
    """
    words = set((text or "").lower().encode().translate(_SEPARATORS).split())
    if not words:
        return np.empty(0, np.uint32)
    raw = np.frombuffer(b"\x01" + b"\x02\x01".join(sorted(words)) + b"\x02", np.uint8)
    ends = np.flatnonzero(raw == 2)
    place = np.arange(len(raw))
    left = ends[np.searchsorted(ends, place)] - place + 1  # bytes up to the word's end
    wide = raw.astype(np.uint32)
    found, rolling = [], wide.copy()
    for n in range(2, LONGEST + 1):
        rolling = rolling[:-1] * _FACTOR + wide[n - 1 :]
        if n >= SHORTEST:
            h = rolling[left[: len(rolling)] >= n] + np.uint32(n)
            h = (h ^ (h >> np.uint32(15))) * _MIX
            found.append(h >> np.uint32(12))
        if len(rolling) < 2:
            break
    return np.concatenate(found) if found else np.empty(0, np.uint32)


@dataclass(frozen=True)
class ToxicityModel:
    """Chosen buckets with their ratios and weights; or one score for every text."""

    buckets: np.ndarray
    ratios: np.ndarray
    weights: np.ndarray
    intercept: float
    constant: float | None = None

    def plain(self) -> tuple:
        """What a broadcast can carry: it is unpickled without this package."""
        return self.buckets, self.ratios, self.weights, self.intercept, self.constant


class _Scorer:
    def __init__(self, model: ToxicityModel) -> None:
        self.model = model
        self.place = np.full(BUCKETS, -1, np.int32)
        self.place[model.buckets] = np.arange(len(model.buckets), dtype=np.int32)
        self.seen = np.zeros(len(model.buckets), bool)

    def features(self, text: str | None) -> np.ndarray:
        found = self.place[ngram_buckets(text)]
        found = found[found >= 0]
        self.seen[found] = True
        chosen = np.flatnonzero(self.seen)
        self.seen[found] = False
        return chosen

    def score(self, text: str | None) -> float:
        m = self.model
        if m.constant is not None:
            return m.constant
        chosen = self.features(text)
        x = m.ratios[chosen]
        z = m.intercept + float(m.weights[chosen] @ x) / (float(np.sqrt(x @ x)) + 1e-9)
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _count_presence(sample: DataFrame) -> DataFrame:
    """(bucket, zeros, ones): in how many texts of each label a bucket occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts = np.zeros((2, BUCKETS), np.int32)
        for batch in batches:
            rows = zip(batch.column("label").to_pylist(), batch.column("text").to_pylist())
            for label, text in rows:
                counts[label, np.unique(ngram_buckets(text))] += 1
        for number in np.flatnonzero(counts.any(axis=0).reshape(-1, SLICE).any(axis=1)):
            piece = counts[:, number * SLICE : (number + 1) * SLICE]
            yield {
                "slice": [int(number)],
                "zeros": [piece[0].tobytes()],
                "ones": [piece[1].tobytes()],
            }

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        zeros, ones = (
            np.sum([np.frombuffer(x, np.int32) for x in rows[name]], axis=0)
            for name in ("zeros", "ones")
        )
        kept = np.flatnonzero(zeros + ones)
        buckets = kept + int(rows["slice"].iloc[0]) * SLICE
        return pd.DataFrame({"bucket": buckets, "zeros": zeros[kept], "ones": ones[kept]})

    sliced = map_task(
        sample.select("label", "text"), count, "slice int, zeros binary, ones binary"
    )
    # At most BUCKETS / SLICE groups of one row per task.
    return sliced.groupBy("slice").applyInPandas(add, "bucket int, zeros long, ones long")


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    texts_per_label: int = 8000,
    features: int = 1 << 15,
    least_texts: int = 3,
    rounds: int = 5,
) -> ToxicityModel:
    """Learn from ``labels.toxic`` of documents that are not held out.

    At most ``texts_per_label`` documents of each label are used, whichever come
    first by a hash of the id. Of the buckets found in ``least_texts`` or more,
    the ``features`` with the largest ratio for their spread are kept; only
    these reach the driver. With no label of one kind every score is the share
    of label 1, and 0.5 with no labels at all.
    """
    usable = usable_labels(docs, labels, "toxic")
    zeros, ones = label_counts(usable)
    none = np.empty(0)
    if not zeros or not ones:
        return ToxicityModel(
            none.astype(int), none, none, 0.0, ones / (zeros + ones) if zeros + ones else 0.5
        )
    sample = labelled_sample(docs, usable, texts_per_label)
    n0, n1 = min(zeros, texts_per_label), min(ones, texts_per_label)
    ratio = F.log(((F.col("ones") + 1) / (n1 + 2)) / ((F.col("zeros") + 1) / (n0 + 2)))
    spread = F.sqrt(1 / (F.col("ones") + 1) + 1 / (F.col("zeros") + 1))
    chosen = (
        _count_presence(sample)
        .where(F.col("zeros") + F.col("ones") >= least_texts)
        .select("bucket", ratio.alias("ratio"), F.abs(ratio / spread).alias("strength"))
        .orderBy(F.desc("strength"), "bucket")
        .limit(features)
        .select("bucket", "ratio")
        .toPandas()
        .sort_values("bucket")
    )
    buckets, ratios = chosen["bucket"].to_numpy(int), chosen["ratio"].to_numpy(float)
    blank = ToxicityModel(buckets, ratios, np.zeros(len(buckets)), 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(blank.plain())

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        scorer = _Scorer(ToxicityModel(*shared.value))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield {
                "doc_id": batch.column("doc_id"),
                "label": batch.column("label"),
                "features": [scorer.features(t).astype(np.int32).tobytes() for t in texts],
            }

    rows = map_task(
        sample.select("doc_id", "label", "text"), extract, "doc_id long, label int, features binary"
    )
    # Sorted: the fit must not depend on the order in which tasks end.
    examples = sorted((r.doc_id, r.label, bytes(r.features)) for r in rows.collect())
    x = [np.frombuffer(found, np.int32) for _, _, found in examples]
    y = [label for _, label, _ in examples]
    weights, intercept = _descend(x, y, ratios, rounds)
    # The sample holds other shares of the labels than all usable labels do.
    sampled = max(1, sum(y)) / max(1, len(y) - sum(y))
    intercept += float(np.log(ones / zeros) - np.log(sampled))
    return ToxicityModel(buckets, ratios, weights, intercept)


def _descend(
    x: list[np.ndarray], y: list[int], ratios: np.ndarray, rounds: int, rate: float = 0.5
) -> tuple[np.ndarray, float]:
    """Logistic regression by adaptive stochastic gradient steps in a fixed random order."""
    weights, squares = np.zeros(len(ratios)), np.full(len(ratios), 1e-8)
    intercept, square = 0.0, 1e-8
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            chosen = x[i]
            v = ratios[chosen]
            v = v / (np.sqrt(v @ v) + 1e-9)
            p = 1 / (1 + np.exp(-np.clip(intercept + weights[chosen] @ v, -40, 40)))
            error = p - y[i]
            step = error * v + 1e-6 * weights[chosen]
            squares[chosen] += step * step
            weights[chosen] -= rate * step / np.sqrt(squares[chosen])
            square += error * error
            intercept -= rate * error / np.sqrt(square)
    return weights, float(intercept)


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``, repeated rows each.

    Every whole text is read. A null text counts as an empty one, which has no
    feature and gets the intercept's score. Empty tables give an empty result;
    a null doc_id counts as not held out, and nothing is learnt from it. Other
    columns of ``docs`` are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels).plain())
    cache: list[_Scorer] = []

    def score(batch: pa.RecordBatch) -> dict:
        if not cache:
            cache.append(_Scorer(ToxicityModel(*model.value)))
        scores = [cache[0].score(text) for text in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "score": scores}

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(kept, score, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )

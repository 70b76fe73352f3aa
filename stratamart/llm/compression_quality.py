"""Quality by compression: which dictionary suits a text better, the good or the bad one?

One zstandard dictionary is built from texts labelled good and one from texts
labelled bad. A text is compressed whole with each. The difference of the two
sizes, normalised by the text's size and by the larger compressed size, is
turned into a probability by a logistic fit on other labelled texts; that fit
also knows the better of the two compression ratios and the logarithm of the
size, since a difference means less in a short or a repetitive text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, map_batches
from .labels import label_counts, labelled_sample, usable_labels

LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries, logistic weights and, for want of labels, the score of every text."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    constant: float | None = None

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        return _compressor(self.good), _compressor(self.bad)


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL,
        dict_data=data,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )


def _sizes(compressors, text: str | None) -> tuple[int, int, int]:
    raw = (text or "").encode()
    good, bad = compressors
    return len(good.compress(raw)), len(bad.compress(raw)), len(raw)


def _features(sizes: np.ndarray) -> np.ndarray:
    """Rows of 1, the two normalised differences with their squares, ratio, size."""
    good, bad, raw = sizes.astype(float).T
    raw = np.maximum(raw, 1)
    by_size = np.clip(10 * (bad - good) / raw, -3, 3)
    by_larger = np.clip(10 * (bad - good) / np.maximum(good, bad), -5, 5)
    ratio = np.minimum(3 * np.minimum(good, bad) / raw, 6)
    columns = [
        np.ones_like(raw),
        by_size,
        by_larger,
        by_size * np.abs(by_size),
        by_larger * np.abs(by_larger),
        ratio,
        np.log(raw) / 3,
    ]
    return np.stack(columns, axis=1)


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by damped Newton steps."""
    w = np.zeros(x.shape[1])
    ridge = 1e-2

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + ridge / 2 * (v @ v))

    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        hessian = (x.T * (weight * p * (1 - p))) @ x + ridge * np.eye(len(w))
        step, size, now = np.linalg.solve(hessian, gradient), 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    dictionary_texts: int = 2000,
    calibration_texts: int = 4000,
    dictionary_bytes: int = 112_640,
) -> QualityModel:
    """Learn from ``labels.quality`` of documents that are not held out.

    Of each label at most ``dictionary_texts`` + ``calibration_texts`` documents
    are used, whichever come first by a hash of the id: half of those there
    are, at most ``dictionary_texts``, for the dictionary and the others to calibrate.
    Only the dictionary texts, and of the others three numbers each, reach the
    driver. With no label of one kind every score is the share of label 1, and
    0.5 with no labels at all.
    """
    usable = usable_labels(docs, labels, "quality")
    zeros, ones = label_counts(usable)
    if not zeros or not ones:
        return QualityModel(b"", b"", (), ones / (zeros + ones) if zeros + ones else 0.5)
    sample = labelled_sample(docs, usable, dictionary_texts + calibration_texts)
    first = {value: max(1, min(dictionary_texts, n // 2)) for value, n in ((0, zeros), (1, ones))}
    in_dictionary = F.col("place") < F.when(F.col("label") == 1, first[1]).otherwise(first[0])
    rows = sample.where(in_dictionary).select("label", "place", "text").collect()
    texts = {
        value: [
            (r.text or "").encode()
            for r in sorted((r for r in rows if r.label == value), key=lambda r: r.place)
        ]
        for value in (0, 1)
    }
    dictionaries = {value: _dictionary(texts[value], dictionary_bytes) for value in (0, 1)}
    model = QualityModel(dictionaries[1], dictionaries[0], ())
    rest = sample if min(zeros, ones) < 2 else sample.where(~in_dictionary)

    def sizes(batch: pa.RecordBatch) -> dict:
        compressors = model.compressors()
        found = [_sizes(compressors, text) for text in batch.column("text").to_pylist()]
        good, bad, raw = zip(*found)
        return {"label": batch.column("label"), "good": good, "bad": bad, "raw": raw}

    measured = map_batches(
        rest.select("label", "text"), sizes, "label int, good long, bad long, raw long"
    ).collect()
    # Sorted: the fit must not depend on the order in which tasks end.
    ordered = sorted((r.label, r.good, r.bad, r.raw) for r in measured)
    y = np.array([r[0] for r in ordered], float)
    x = _features(np.array([r[1:] for r in ordered]))
    # Each label weighs as it does among all usable labels.
    share = ones / (zeros + ones)
    weight = np.where(
        y == 1, share * len(y) / max(1, y.sum()), (1 - share) * len(y) / max(1, (1 - y).sum())
    )
    return QualityModel(dictionaries[1], dictionaries[0], tuple(_fit(x, y, weight)))


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary; with too few texts to train one, the texts themselves."""
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[:size] or b"\n"


def with_quality(docs: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 as column ``name``, replacing one of that name.

    Every whole text is compressed. A null text counts as an empty one, which
    gets the score the calibration gives to size 0. Rows are neither moved nor dropped.
    """
    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    cache: list = []

    def score(batch: pa.RecordBatch) -> dict:
        if model.constant is not None:
            scores = np.full(batch.num_rows, model.constant)
        else:
            if not cache:
                cache.append(model.compressors())
            sizes = [_sizes(cache[0], text) for text in batch.column("text").to_pylist()]
            z = _features(np.array(sizes)) @ np.array(model.weights)
            scores = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return dict(zip(batch.schema.names, batch.columns)) | {name: scores}

    return map_batches(docs, score, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``, repeated rows each.

    Empty tables give an empty result; a null doc_id counts as not held out,
    and nothing is learnt from it. Other columns of ``docs`` are not read.
    """
    model = fit_quality(docs, labels)
    scored = with_quality(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def empty_score(model: QualityModel) -> float:
    """The score of a text without a byte."""
    if model.constant is not None:
        return model.constant
    z = _features(np.array([_sizes(model.compressors(), "")])) @ np.array(model.weights)
    return 1 / (1 + math.exp(-float(z[0])))

"""Labelled documents to learn from, in bounded number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out


def usable_labels(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of the documents whose label may be learnt.

    Left out: held-out ids, null ids and labels, ids with contradicting labels,
    and ids that have no document.
    """
    known = (
        labels.where(~held_out() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .where("label = other")
        .select("doc_id", F.col("label").cast("int").alias("label"))
    )
    return known.join(docs.select("doc_id"), "doc_id", "left_semi")


def label_counts(usable: DataFrame) -> tuple[int, int]:
    """How many documents are labelled 0 and 1."""
    row = usable.agg(
        F.coalesce(F.sum(1 - F.col("label")), F.lit(0)).alias("zeros"),
        F.coalesce(F.sum("label"), F.lit(0)).alias("ones"),
    ).first()
    return row.zeros, row.ones


def labelled_sample(docs: DataFrame, usable: DataFrame, per_label: int) -> DataFrame:
    """(place, label, doc_id, text) of at most ``per_label`` documents of each label.

    Which ones is settled by a hash of the id. ``place`` counts from 0 inside
    each label. A repeated id gives one row, with its smallest text.
    """
    spark = docs.sparkSession
    chosen = []
    for value in (0, 1):
        ids = usable.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id")
        rows = ids.select("doc_id").limit(per_label).collect()
        chosen += [(row.doc_id, value, place) for place, row in enumerate(rows)]
    few = spark.createDataFrame(chosen, "doc_id long, label int, place int")
    # At most twice ``per_label`` short rows, so the documents are not moved.
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(few), "doc_id")
        .groupBy("doc_id", "label", "place")
        .agg(F.min("text").alias("text"))
    )

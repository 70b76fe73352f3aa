"""Token ids in ORC: run-length coded integers, row indexes, Bloom filters on document ids.

One row per document in ascending order of ids. ORC writes the ids' integers
in run-length encoding, an index entry with the smallest and largest doc_id
for every few rows, and a Bloom filter on doc_id. A reader takes stripes in
parallel and skips those that cannot hold the documents asked for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import joined_batches, map_batches, map_task, tasks_for
from .scan import running_sums
from .tokens import CODED_BYTES, WordCoder, broadcast_vocabulary

SCHEMA = "doc_id long, ids array<int>, row_no long"


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary_path: str,
    end_id: int,
    bytes_per_file: int = 128 << 20,
    stripe_bytes: int = 16 << 20,
    index_rows: int = 1000,
) -> None:
    """Write the ids of every whole text, ``end_id`` last, in ascending doc_id order.

    Files and their rows follow the order of doc_id, nulls first; rows that share
    one go by a hash of the text, so that the sample for the ranges holds no texts. A null
    text is an empty one and has the end id alone. Repeated rows are written each.
    """
    spark = docs.sparkSession
    shared = broadcast_vocabulary(spark, vocabulary_path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Exact bytes of text: one aggregate over the scan.
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    dealt = rows.repartitionByRange(tasks_for(total, bytes_per_file), *order)
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder = WordCoder(shared.value)
        for batch in joined_batches(batches, CODED_BYTES):
            found = [ids + end for ids in coder.encode_all(batch.column("text").to_pylist())]
            offsets = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
            values = np.frombuffer(b"".join(found), "<u4").astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield {"doc_id": batch.column("doc_id"), "ids": ids}

    coded = map_task(dealt.sortWithinPartitions(*order, "text"), encode, "doc_id long, ids array<int>")
    (
        coded.withColumn("row_no", F.monotonically_increasing_id())
        .write.option("compression", "zstd")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", index_rows)
        .option("orc.create.index", "true")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """(doc_id, ids, row_no); of the documents asked for, if any are named.

    The condition goes down to the files, whose indexes and Bloom filters skip
    stripes and groups of rows.
    """
    found = spark.read.schema(SCHEMA).orc(path)
    return found if doc_ids is None else found.where(F.col("doc_id").isin(list(doc_ids)))


def token_digests(stored_tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of stored documents; start counts ids before it."""

    def digest(batch: pa.RecordBatch) -> dict:
        ids = batch.column("ids")
        offsets = ids.offsets.to_numpy()
        values = ids.values.to_numpy().astype("<u4")
        crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        return {
            "doc_id": batch.column("doc_id"),
            "row_no": batch.column("row_no"),
            "n_tokens": np.diff(offsets).astype(np.int64),
            "ids_crc32": np.array(crc, np.int64),
        }

    digests = map_batches(
        stored_tokens, digest, "doc_id long, row_no long, n_tokens long, ids_crc32 long"
    )
    summed = running_sums(digests, [F.col("row_no")], {"start": "n_tokens"}, purpose="token-starts")
    return summed.select("doc_id", "start", "n_tokens", "ids_crc32")

"""WARC archives written and read back with boundary-chain verification.

A reader that takes parts of a file in parallel sees the magic of a record
anywhere, also inside payloads. Here the magic only makes a candidate: tasks
give each candidate's offset and, from its header's length, the offset of its
successor. From the file's start the chain of successors is followed, inside
the part a task has read by a scan, between parts by pointer jumping, which
doubles the length of known jumps each round. Only candidates on the chain are
records.

The text source cuts files at the magic and never cuts a record's bytes, reads
plain files in parts, and leaves compressed ones whole to one task each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_task, stored

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URI = "urn:page:"
BIN = 1 << 20  # bytes of a file that one key of the join of chunks with records stands for


def write_archives(
    pages: DataFrame,
    path: str,
    least_bytes: int = 1000,
    date: str = "2024-01-01T00:00:00Z",
    compression: str = "gzip",
) -> None:
    """Write a record per row of ``pages`` (page_id, url, html), a file per task.

    Of rows with equal payloads of ``least_bytes`` or more, that with the largest page_id
    is a response and the others are revisits that refer to it; shorter payloads are
    all responses, as are rows that repeat that page_id with the payload. A null
    html is an empty payload, and a null url is left out. An empty table gives no record.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace("url", r"[\r\n]+", " ").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).select(
        "page_id",
        "url",
        "html",
        F.octet_length("html").cast("long").alias("n_bytes"),
        F.sha1(F.col("html").cast("binary")).alias("digest"),
    )
    # Payloads that need no partner get keys of their own, so they spread.
    alone = F.concat(F.lit("page-"), F.coalesce(F.col("page_id").cast("string"), F.col("digest")))
    key = F.when(F.col("n_bytes") >= least_bytes, F.col("digest")).otherwise(alone)
    keyed = rows.withColumn("key", key)
    owners = (
        keyed.where(F.col("n_bytes") >= least_bytes)
        .groupBy("key")
        .agg(F.max("page_id").alias("owner"), F.count("*").alias("n"))
        .where("n > 1")
        .select("key", "owner")
    )
    judged = keyed.join(owners, "key", "left").withColumn(
        "refers_to", F.when(~F.col("owner").eqNullSafe(F.col("page_id")), F.col("owner"))
    )
    revisit = F.col("refers_to").isNotNull()

    def uri(column: str) -> Column:
        return F.concat(F.lit(f"<{RECORD_URI}"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))

    def line(name: str, value: Column | str, when: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))
        return text if when is None else F.when(when, text).otherwise("")

    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", uri("page_id")),
        line("WARC-Date", date),
        line("WARC-Target-URI", F.coalesce("url", F.lit("")), F.col("url").isNotNull()),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Refers-To", uri("refers_to"), revisit),
        line("WARC-Profile", REVISIT_PROFILE, revisit),
        line("Content-Type", "text/html; charset=utf-8"),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")),
        F.lit("\r\n"),
        F.when(revisit, "").otherwise(F.col("html")),
        F.lit(END[:-1]),  # the sink ends each record with the line feed that is left
    )
    judged.select(record.alias("value")).write.option("lineSep", "\n").option(
        "compression", compression
    ).text(path)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """What stands after each magic: (file, block, chunk_no, value), in order within a block."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("chunk_no"),
            "value",
        )
    )


def _field(name: str, pattern: str) -> Column:
    found = F.regexp_extract("header", rf"(?i)(?:^|\r\n){name}:[ \t]*{pattern}", 1)
    return F.when(found != "", found)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """A row per chunk with its offset in the file and, if it begins like a record, its successor.

    Payloads that end in their chunk have their digest taken here, so that only
    offsets and header fields travel.
    """
    split = _chunks(spark, path).select(
        "*",
        F.octet_length("value").cast("long").alias("n_bytes"),
        F.when(F.instr("value", END) > 0, F.substring_index("value", END, 1)).alias("header"),
    )
    parsed = split.select(
        "*",
        (F.octet_length("header") + len(END)).cast("long").alias("header_bytes"),
        _field("Content-Length", r"(\d{1,18})").cast("long").alias("content"),
    )
    payload = F.expr("substring(cast(value AS binary), cast(header_bytes + 1 AS int), cast(content AS int))")
    whole = F.col("n_bytes") >= F.col("header_bytes") + F.col("content") + len(END)
    chunks = stored(
        parsed.select(
            "file",
            "block",
            "chunk_no",
            "n_bytes",
            "header_bytes",
            "content",
            F.when(whole, F.sha1(payload)).alias("read_digest"),
            _field("WARC-Type", r"([a-z]+)").alias("record_type"),
            _field("WARC-Record-ID", rf"<{RECORD_URI}(-?\d+)>").cast("long").alias("page_id"),
            _field("WARC-Target-URI", r"([^\r\n]*)").alias("url"),
            _field("WARC-Refers-To", rf"<{RECORD_URI}(-?\d+)>").cast("long").alias("refers_to"),
            _field("WARC-Payload-Digest", r"sha1:([0-9a-f]{40})").alias("named_digest"),
        ),
        "warc-chunks",
    )
    taken = F.col("n_bytes") + len(MAGIC)
    inside = Window.partitionBy("file", "block").orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        chunks.groupBy("file", "block")
        .agg(F.sum(taken).alias("all_bytes"))
        .select("file", "block", F.coalesce(F.sum("all_bytes").over(before), F.lit(0)).alias("block_offset"))
    )
    offset = F.col("block_offset") + F.coalesce(F.sum(taken).over(inside), F.lit(0)) - len(MAGIC)
    return stored(
        chunks.join(blocks, ["file", "block"])
        .withColumn("offset", offset)
        .withColumn(
            "next",
            F.col("offset") + len(MAGIC) + F.col("header_bytes") + F.col("content") + len(END),
        ),
        "warc-candidates",
    )


def reachable(found: DataFrame) -> DataFrame:
    """The candidates on the chain from each file's start: their file, block and chunk_no."""
    dealt = (
        found.select("file", "block", "chunk_no", "offset", "next")
        .repartition("file", "block")
        .sortWithinPartitions("file", "block", "offset")
    )

    def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
        last, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] != last:
                    if rows:
                        yield last, rows
                    last, rows = row[:2], []
                rows.append(row[2:])
        if rows:
            yield last, rows

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """Where the chain from each candidate leaves its block."""
        for (file, _), rows in by_block(batches):
            left: dict[int, int] = {}
            for row in reversed(rows):
                offset, following = row[1], row[2]
                if following is not None:
                    left[offset] = left.get(following, following)
            if left:
                yield {"file": [file] * len(left), "offset": list(left), "jump": list(left.values())}

    many = found.groupBy("file").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0] or 0
    starts = found.where("next is not null and offset = 0").select("file", "offset").distinct()
    entries = starts
    if many > 1:
        jumps = stored(map_task(dealt, exits, "file string, offset long, jump long"), "warc-jumps")
        length = 1
        while length < many:
            reached = entries.join(jumps, ["file", "offset"]).select("file", F.col("jump").alias("offset"))
            entries = stored(entries.unionByName(reached).distinct(), "warc-entries")
            length *= 2
            if length < many:
                onward = jumps.select("file", F.col("offset").alias("jump"), F.col("jump").alias("further"))
                jumps = stored(
                    jumps.join(onward, ["file", "jump"], "left").select(
                        "file", "offset", F.coalesce("further", "jump").alias("jump")
                    ),
                    "warc-jumps",
                )

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """The chain inside a block from where it enters."""
        for (file, block), rows in by_block(batches):
            kept, expected = [], None
            for chunk_no, offset, following, enters in rows:
                if following is not None and (enters or offset == expected):
                    kept.append(chunk_no)
                    expected = following
            if kept:
                yield {"file": [file] * len(kept), "block": [block] * len(kept), "chunk_no": kept}

    marked = (
        found.select("file", "block", "chunk_no", "offset", "next")
        .join(entries.withColumn("enters", F.lit(True)), ["file", "offset"], "left")
        .select("file", "block", "chunk_no", "offset", "next", F.col("enters").isNotNull().alias("enters"))
        .repartition("file", "block")
        .sortWithinPartitions("file", "block", "offset")
    )
    return map_task(marked, follow, "file string, block long, chunk_no long")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, next, record_type, page_id, url, refers_to, payload_bytes, payload_digest).

    One row per verified record. Digests are taken of the bytes read; a revisit
    has those of the response it refers to, found by page and digest. A payload
    whose digest is not the one its header names makes the read fail.
    """
    found = candidates(spark, path)
    records = stored(
        found.join(reachable(found), ["file", "block", "chunk_no"], "left_semi"), "warc-records"
    )
    cut = records.where("read_digest is null")
    digests = _digests_of_cut(spark, path, found, cut) if cut.take(1) else None
    if digests is not None:
        records = (
            records.join(digests, ["file", "offset"], "left")
            .withColumn("read_digest", F.coalesce("read_digest", "joined_digest"))
            .drop("joined_digest")
        )
    records = records.withColumn("record_type", F.coalesce("record_type", F.lit("")))
    is_revisit = F.col("record_type") == "revisit"
    checked = F.when(
        F.col("named_digest").isNull() | (F.col("named_digest") == F.col("read_digest")),
        F.col("read_digest"),
    ).otherwise(
        F.raise_error(F.concat(F.lit("payload digest differs at "), "file", F.lit(":"), "offset"))
    )
    kept = ["file", "offset", "next", "record_type", "page_id", "url", "refers_to"]
    whole = records.where(~is_revisit).select(
        *kept, F.col("content").alias("payload_bytes"), checked.alias("payload_digest")
    )
    targets = whole.groupBy(
        F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("named_digest")
    ).agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = records.where(is_revisit).join(targets, ["refers_to", "named_digest"], "left")
    return whole.unionByName(
        revisits.select(*kept, "payload_bytes", F.col("named_digest").alias("payload_digest"))
    )


def _digests_of_cut(spark: SparkSession, path: str, found: DataFrame, cut: DataFrame) -> DataFrame:
    """(file, offset, joined_digest) of records that hold a magic, from all their chunks."""
    bins = F.explode(F.sequence(F.floor(F.col("start") / BIN), F.floor(F.col("next") / BIN)))
    spans = cut.select("file", F.col("offset").alias("start"), "next", "header_bytes", "content").withColumn(
        "bin", bins
    )
    parts = (
        found.select("file", "block", "chunk_no", "offset", F.floor(F.col("offset") / BIN).alias("bin"))
        .join(spans, ["file", "bin"])
        .where((F.col("offset") >= F.col("start")) & (F.col("offset") < F.col("next")))
        .select("file", "block", "chunk_no", "offset", "start", "header_bytes", "content")
    )
    texts = _chunks(spark, path).join(parts, ["file", "block", "chunk_no"])
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct("offset", "value"))), lambda x: x["value"]
    )
    joined = texts.groupBy("file", "start", "header_bytes", "content").agg(
        F.array_join(ordered, MAGIC).alias("text")
    )
    payload = F.expr("substring(cast(text AS binary), cast(header_bytes + 1 AS int), cast(content AS int))")
    return joined.select("file", F.col("start").alias("offset"), F.sha1(payload).alias("joined_digest"))

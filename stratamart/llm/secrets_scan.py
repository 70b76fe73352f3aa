"""Secrets in whole texts, judged by how many repositories and owners hold them.

A pass over the texts finds the spans of three fixed patterns, and besides them
long tokens that look random. Each span's value is numbered by a 128-bit hash.
Over the whole corpus the hashes are counted by distinct repositories and
distinct owners: a value that several owners hold is a widely copied example, a
value of a single owner that looks random is taken for a live credential, and
the rest stays undecided. The spans of the patterns are kept whatever the
verdict. The method adds the tokens that it finds to be live.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_task, stored

# The kinds in the order in which they are listed, and their patterns.
KINDS = ("assign", "access", "hex", "token")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
# Whole runs of ``[0-9a-f]``, of which only the long ones count.
HEX = re.compile(rf"[0-9a-f]{{{LEAST_HEX},}}")
# What the first pattern cannot do without, in lower case.
NAMES = ("passw", "secret", "token", "key")
# A run that may be a token; the same characters as above without dots, which end sentences.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")

EXAMPLE_OWNERS = 3  # so many owners make a value a copied example
LIVE_BITS = 3.0  # entropy per character from which a value looks random
EVERYWHERE = 10_000  # a value with more than this share (one in so many) of all spans is looked up apart

FIELDS = ("kind", "start", "stop", "value", "base", "random")
SPAN = "struct<kind:string,start:int,stop:int,value:binary,base:boolean,random:boolean>"


def base_spans(text: str) -> Iterator[tuple[str, int, int, str]]:
    """(kind, start, stop, value) of the three patterns; places count code points."""
    lowered = text.lower()
    if any(name in lowered for name in NAMES):
        for match in ASSIGN.finditer(text):
            if len(match[2]) >= LEAST_ASSIGNED:
                yield "assign", match.start(), match.end(), match[2]
    if "AKIA" in text:
        for match in ACCESS.finditer(text):
            if len(match[0]) >= LEAST_ACCESS:
                yield "access", match.start(), match.end(), match[0]
    for match in HEX.finditer(text):
        yield "hex", match.start(), match.end(), match[0]


def looks_random(value: str) -> bool:
    """Letters and digits with many different characters: what generated credentials have."""
    if not (re.search("[0-9]", value) and re.search("[A-Za-z]", value)):
        return False
    n = len(value)
    return -sum(c / n * log2(c / n) for c in Counter(value).values()) >= LIVE_BITS


def spans_of(text: str) -> list[tuple]:
    """The fields of SPAN for all patterns' spans, and for random-looking tokens that touch none of them."""
    found = [(*span, True) for span in base_spans(text)]
    taken = sorted((start, stop) for _, start, stop, _, _ in found)
    at = 0
    for match in TOKEN.finditer(text):
        start, stop = match.span()
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if (at == len(taken) or taken[at][0] >= stop) and looks_random(match[0]):
            found.append(("token", start, stop, match[0], False))
    return [
        (kind, start, stop, hashlib.blake2b(value.encode(), digest_size=16).digest(), base, looks_random(value))
        for kind, start, stop, value, base in found
    ]


def find_spans(docs: DataFrame, repository: str | None = None, owner: str = "source") -> DataFrame:
    """(row_no, doc_id, repository, owner, spans) of every row, stored.

    Without a ``repository`` column each row is a repository of its own.
    """
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row_no"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        (F.lit(None) if repository is None else F.col(repository)).cast("string").alias("repository"),
        F.col(owner).cast("string").alias("owner"),
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            columns = {n: batch.column(n) for n in ("row_no", "doc_id", "repository", "owner")}
            texts = batch.column("text").to_pylist()
            yield columns | {"spans": [[dict(zip(FIELDS, s)) for s in spans_of(t or "")] for t in texts]}

    schema = f"row_no long, doc_id long, repository string, owner string, spans array<{SPAN}>"
    found = stored(map_task(numbered, scan, schema), "secret-spans")
    if repository is None:
        found = found.withColumn("repository", F.col("row_no").cast("string"))
    return found


def ownership(found: DataFrame) -> DataFrame:
    """(value, spans, repositories, owners, verdict) of each value over the whole corpus.

    Null repositories and owners count as one of their own each. Counting is by
    (value, owner, repository) first, so a value that is everywhere is no hot
    key; then by (value, owner), then by value, each with partial sums.
    """
    spans = found.select(
        F.explode("spans").alias("span"),
        F.coalesce("repository", F.lit("")).alias("repository"),
        F.coalesce("owner", F.lit("")).alias("owner"),
    ).select("span.value", "span.random", "repository", "owner")
    each = spans.groupBy("value", "owner", "repository").agg(
        F.count("*").alias("spans"), F.max("random").alias("random")
    )
    # A repository may have several owners, so it is counted apart from them.
    by_repository = each.groupBy("value", "repository").agg(
        F.sum("spans").alias("spans"), F.max("random").alias("random")
    )
    repositories = by_repository.groupBy("value").agg(
        F.sum("spans").alias("spans"),
        F.count("*").alias("repositories"),
        F.max("random").alias("random"),
    )
    owners = each.select("value", "owner").distinct().groupBy("value").agg(F.count("*").alias("owners"))
    verdict = (
        F.when(F.col("owners") >= EXAMPLE_OWNERS, "example")
        .when((F.col("owners") == 1) & F.col("random"), "live")
        .otherwise("undecided")
    )
    return repositories.join(owners, "value").select(
        "value", "spans", "repositories", "owners", verdict.alias("verdict")
    )


def secret_spans(docs: DataFrame, repository: str | None = None, owner: str = "source") -> DataFrame:
    """(doc_id, spans) of every row: its spans in order, with kind, place, base, counts and verdict.

    Spans of the patterns are all there; a token only if it is live. Null and
    empty texts have none. Repeated rows give a row each, and count as different
    repositories unless a ``repository`` column is named. Rows without an owner
    have a common one. An empty table gives an empty result; columns that are
    not named are not read.
    """
    found = find_spans(docs, repository, owner)
    values = stored(ownership(found), "secret-values")
    spans = found.select("row_no", F.explode("spans").alias("span")).select("row_no", "span.*")
    total = values.agg(F.coalesce(F.sum("spans"), F.lit(0))).first()[0]
    # At most EVERYWHERE values hold more than this share each: few enough to broadcast.
    common = F.col("spans") * EVERYWHERE > total
    few = values.where(common).withColumnRenamed("spans", "occurrences")
    many = values.where(~common).withColumnRenamed("spans", "occurrences")
    in_few = spans.join(F.broadcast(few), "value")
    in_many = spans.join(F.broadcast(few.select("value")), "value", "left_anti").join(many, "value")
    judged = in_few.unionByName(in_many).where(F.col("base") | (F.col("verdict") == "live"))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    span = F.struct(
        "start", order.alias("place"), "stop", "kind", "base", "occurrences", "repositories", "owners", "verdict"
    )
    per_row = judged.groupBy("row_no").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    nothing = F.array().cast(per_row.schema["spans"].dataType)
    rows = found.select("row_no", "doc_id").join(per_row, "row_no", "left")
    return rows.select("doc_id", F.coalesce("spans", nothing).alias("spans"))


def secret_digests(judged: DataFrame) -> DataFrame:
    """The columns of op13's contract from ``secret_spans``, with the numbers of live and copied values' spans."""
    base = F.filter("spans", lambda s: s["base"])

    def written(spans: F.Column) -> F.Column:
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
        return F.array_join(parts, ",")

    def number(field: str, value: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s[field] == value)).cast("long")

    counts = [number("kind", kind).alias(f"n_{kind}") for kind in KINDS[:3]]
    return judged.select(
        "doc_id",
        *counts,
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        number("verdict", "live").alias("n_live"),
        number("verdict", "example").alias("n_example"),
    )

"""A training corpus from raw documents, in five stages.

Each stage takes the documents its predecessor kept and, but for the last,
returns documents with the same columns; its result is written as Parquet and
read again before the next stage starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import stored, table
from stratamart.llm.compression_quality import fit_quality, with_quality
from stratamart.llm.jaccard import jaccard_components
from stratamart.llm.mixing import mix
from stratamart.llm.packing import document_pieces, pack
from stratamart.llm.quality_rules import quality_rules
from stratamart.llm.queries import vocabulary_path

QUALITY_THRESHOLD = 0.3
END_ID = 1


def drop_low_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the compression classifier takes for good.

    All documents stay if none can be learnt from with label 0, or none with label 1: there is no classifier then.
    """
    model = fit_quality(docs, table(spark, folder, "labels"))
    if model.constant is not None:
        return docs
    score = "quality_score_of_this_stage"
    return with_quality(docs, model, score).where(F.col(score) >= QUALITY_THRESHOLD).drop(score)


def drop_rule_breakers(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that break no quality rule.

    Each row is judged by itself: null and empty texts go (they have fewer than
    ten words), repeated rows stay or go together, an empty table stays one.
    Other columns are carried along whatever their names.
    """
    row = F.struct(*[F.col(f"`{name}`").alias(name) for name in docs.columns]).alias("row")
    judged = quality_rules(docs, carry=row).select("row", "kept", F.rand().alias("drawn"))
    # With the drawn number the filter stays above the projection; the optimizer would
    # otherwise copy all counts into it and compute them twice. No row has a negative one.
    return judged.where("kept and drawn >= 0").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id.

    Of rows that repeat an id one stays, with the smallest text (null first);
    rows without an id all stay, and so do null and empty texts. An empty table
    stays one. Other columns may be of any type.
    """
    groups = stored(jaccard_components(docs).select("doc_id", "component_id"), "near-copies")
    dropped = groups.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(dropped, "doc_id", "left_anti").select([f"`{name}`" for name in docs.columns])
    repeated = groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if not repeated.take(1):
        return kept
    alone = kept.where("doc_id is null")
    names = [f"`{name}`" for name in docs.columns]
    first = F.min_by(F.struct(*names), F.struct("text")).alias("row")
    one_each = kept.where("doc_id is not null").groupBy("doc_id").agg(first).select("row.*")
    return alone.unionByName(one_each).select(names)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Null and empty texts have no words and are never taken, nor is anything of
    an empty table. Rows that repeat an id, source and text are taken alike; a
    null id or source is one like others. Other columns are carried along.
    """
    key = ["doc_id", "source", "text_hash"]
    taken = mix(docs).where("copies > 0").select(*key, "copies").distinct()
    hashed = docs.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = [hashed[name].eqNullSafe(taken[name]) for name in key]
    return (
        hashed.join(taken, same)
        .select(*[hashed[f"`{name}`"] for name in docs.columns], F.explode(F.expr("sequence(1, copies)")))
        .drop("col")
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents with their sequence and place, as the packing operator gives them.

    Null and empty texts are one piece with the end id alone, repeated rows give
    their pieces each, an empty table none. Other columns are left behind.
    """
    return pack(document_pieces(docs, vocabulary_path(), END_ID))


STAGES = [
    ("quality classifier", drop_low_quality),
    ("quality rules", drop_rule_breakers),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

# The trained classifier, the compressed sizes and the packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The result of the last stage over the table ``documents``."""
    docs = table(spark, folder, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, folder), f"stage-{number}")
    return docs

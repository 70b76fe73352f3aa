"""One query per operator, over the whole table it is meant for, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratamart.operators.storage import scratch_path

from .common import table
from .compression_quality import quality_scores
from .conversation_repair import damage, repair_report
from .jaccard import jaccard_components
from .lexical import ranked_search
from .licences import licence_scan
from .mixing import mix
from .oracles import OP2, OP8, OP11
from .packing import document_pieces, pack
from .quality_rules import quality_rules
from .secrets_scan import secret_digests, secret_spans
from .token_orc import read_tokens, token_digests, write_tokens
from .toxicity import toxicity_scores
from .vector_links import vector_links
from .warc import read_archives, write_archives


# The vocabulary of the token operators.
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(document_pieces(table(spark, folder, "documents"), vocabulary_path(), end_id=1))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op3_warc_chain(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, folder, "pages"), path)
    return read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_token_orc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-orc")
    write_tokens(table(spark, folder, "documents"), path, vocabulary_path(), end_id=2)
    return token_digests(read_tokens(spark, path))


def op5_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licence_scan(table(spark, folder, "documents"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_spherical_caps(spark: SparkSession, folder: str) -> DataFrame:
    return vector_links(table(spark, folder, "embeddings"))


def op8_fair_queueing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))


def op10_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_presence_masks(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return repair_report(damage(conversations), conversations.select("conv_id"))


def op13_secret_ownership(spark: SparkSession, folder: str) -> DataFrame:
    return secret_digests(secret_spans(table(spark, folder, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_quality_rules": op2_quality_rules,
    "op3_warc_chain": op3_warc_chain,
    "op4_token_orc": op4_token_orc,
    "op5_licence_scan": op5_licence_scan,
    "op6_toxicity": op6_toxicity,
    "op7_spherical_caps": op7_spherical_caps,
    "op8_fair_queueing": op8_fair_queueing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_compression_quality": op10_compression_quality,
    "op11_presence_masks": op11_presence_masks,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_secret_ownership": op13_secret_ownership,
}

ORACLES: dict[str, str] = {
    "op2_quality_rules": OP2,
    "op8_fair_queueing": OP8,
    "op11_presence_masks": OP11,
}

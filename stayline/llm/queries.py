"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    decontaminate,
    embedding_dedup,
    pii,
    prefix_trie,
    quality_fm,
    quality_rules,
    ranked_search,
    secret_scan,
    simhash,
    suffix_dedup,
    tool_calls,
    toxicity,
)
from .learning import fold
from .oracle import ORACLE
from .tables import table

__all__ = ["ORACLE", "QUERIES"]

TOXIC_FROM = 0.7
GOOD_FROM = 0.3


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = toxicity.fit(docs, labels)
    return toxicity.score(docs, weights, {"doc_id": "bigint"}).select(
        "doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def linked_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calls and results that the turns of all conversations give."""
    messages = tool_calls.messages_from(table(spark, sf_dir, "conversations"))
    return tool_calls.link(messages, tool_calls.SCHEMAS)


def rule_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_fm.fit(docs, labels)
    return quality_fm.score(docs, model, {"doc_id": "bigint"}).select(
        "doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"),
    )


def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"), {
        "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string",
    })


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item it holds."""
    return decontaminate.findings(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).drop("key")


def simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


def bpe_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(
        table(spark, sf_dir, "documents"), vocabulary_path(), {"doc_id": "bigint"},
        {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    )


def best_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    return ranked_search.best_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50
    )


def conversation_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations."""
    return prefix_trie.prefix_nodes(table(spark, sf_dir, "conversations"))


def vector_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors of cosine 0.95 and more."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": secrets,
    "op2_chat_tool_calls": linked_tool_calls,
    "op3_toxicity": toxicity_scores,
    "op4_quality_rules": rule_verdicts,
    "op5_quality_classifier": quality_scores,
    "op6_suffix_dedup": repeated_bytes,
    "op7_decontamination": benchmark_passages,
    "op8_simhash_near_dedup": simhash_classes,
    "op9_pii": personal_data,
    "op10_bpe": bpe_digests,
    "op11_ranked_search": best_documents,
    "op12_prefix_trie": conversation_prefixes,
    "op13_embedding_dedup": vector_classes,
}

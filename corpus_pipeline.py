"""From raw documents to token ids, stage by stage.

Each stage judges all rows its predecessor kept and is written before the next
one reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import bpe, decontaminate, secret_scan, simhash, toxicity
from stayline.llm.queries import TOXIC_FROM, vocabulary_path
from stayline.llm.tables import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the cutoff."""
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    keep = {f.name: f.dataType.simpleString() for f in docs.schema}
    scored = toxicity.score(docs, weights, keep, name="__score")
    return scored.where(F.col("__score") < TOXIC_FROM).select(*keep)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.one_per_group(docs, shingle=3, radius=2)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    return secret_scan.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, packed as little-endian 32-bit integers."""
    return bpe.encode(
        docs, vocabulary_path(), {"doc_id": "bigint"},
        {"n_tokens": "bigint", "ids": "binary", "ids_sha256": "string",
         "decoded_sha256": "string"},
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("secret_scan", redact_secrets),
    ("bpe", tokenize),
]

ORACLE_SQL = None  # scores, fingerprints and token ids have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

"""What the two classifiers share: a bounded labelled sample and hashed words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_ROWS = 12_000  # documents a model is fitted on, at most
MAX_BYTES = 256_000_000  # their features together; one document may have a sixteenth of it


def fold(modulus: int) -> Column:
    """The fold of a document by the check sum of its id; NULL for a NULL id."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_rows: int = MAX_ROWS
) -> DataFrame:
    """``doc_id, text, label`` of at most ``max_rows`` labelled documents.

    The ids come first in the order of a hash of the id, so the sample does not
    depend on how rows are stored; it is bounded, hence broadcast to the scan of
    the documents. An id with two labels counts as the larger, a repeated
    document once, with its smallest text.
    """
    ids = (
        labels.where(learn & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    return (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(ids), "doc_id")
        .groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    )


def within_bytes(rows: DataFrame, *features: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The written ``rows`` of a sample whose binary ``features`` fit into ``max_bytes``.

    They are taken in the order of a hash of the id until the bytes are used up; rows of more
    than a sixteenth of them are left out. Only ids and sizes of the sample's rows, which are
    bounded in number, meet in one task and are broadcast.
    """
    size = sum((F.octet_length(name).cast("bigint") for name in features), F.lit(0).cast("bigint"))
    so_far = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    fits = (
        rows.select("doc_id", size.alias("size")).where(F.col("size") <= max_bytes // 16)
        .withColumn("so_far", F.sum("size").over(so_far)).where(F.col("so_far") <= max_bytes)
        .select("doc_id")
    )
    return rows.join(F.broadcast(fits), "doc_id")


def word_hasher():
    """Texts to arrays of 32-bit word hashes: ASCII lower case, ASCII marks split words."""
    from zlib import crc32

    import numpy as np

    marks = bytes(
        b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256)
    )

    def hashes(text: str | None) -> np.ndarray:
        words = (text or "").encode().translate(marks).split()
        return np.fromiter(map(crc32, words), dtype=np.uint64, count=len(words))

    return hashes


def slots(values, salt: int, bits: int):
    """Places of hashed values in a table of ``2 ** bits``."""
    import numpy as np

    mixed = (values ^ np.uint64(salt * 0x9E3779B1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - bits)).astype(np.int32)

"""Hand-off to an outside reviewer or model: batches and JSON payloads."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import json_text, stable_bucket

ROWS_PER_BUCKET = 10_000


def buckets_for(rows: int) -> int:
    """Buckets that keep each sorting task near ``ROWS_PER_BUCKET`` rows."""
    return max(1, math.ceil(rows / ROWS_PER_BUCKET))


def agent_batches(
    users: DataFrame, batch_size: int = 20, buckets: int | None = None
) -> DataFrame:
    """Deals users into batches of at most ``batch_size``.

    User ids are unique and hashed, so the buckets are even and every task
    numbers its own bucket. Their number follows the row count, so ``users``
    should be a stored table unless ``buckets`` is given.
    """
    buckets = buckets_for(users.count()) if buckets is None else buckets
    bucket = stable_bucket(F.col("user_id"), buckets)
    order = Window.partitionBy("bucket").orderBy("user_id")
    return users.withColumn("bucket", bucket).withColumn(
        "batch_no", F.floor((F.row_number().over(order) - 1) / batch_size).cast("bigint")
    )


def agent_payloads(batches: DataFrame, fields: list[str]) -> DataFrame:
    """One text per batch: one JSON object per user and line."""
    line = json_text(F.struct(*fields))
    entry = F.struct(F.col("user_id"), line.alias("payload"))
    return batches.groupBy("bucket", "batch_no").agg(
        F.count("*").alias("users"),
        F.array_join(F.sort_array(F.collect_list(entry)).getField("payload"), "\n")
        .alias("payload"),
    )

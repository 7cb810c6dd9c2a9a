"""CSV sources. Files land as text, so that one bad value rejects one row only."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.ingest import (
    MALFORMED, Split, all_rejects, checked_rows, keyed_rows, lost_users, owned_rows,
    split_checked, split_keyed, split_owned, split_rejects, usage_key,
)
from ..schemas import TABLE_RULES
from ..session import written
from .snapshots import Snapshots


def landing_schema(table: str) -> T.StructType:
    names = [*TABLE_RULES[table].schema.names, MALFORMED]
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


def read_landing(spark: SparkSession, path: str, table: str) -> DataFrame:
    """All fields as text; lines with a wrong field count keep their raw line.

    A header that does not name the columns in their order fails the load.
    """
    return (
        spark.read.schema(landing_schema(table))
        .option("header", True)
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .csv(path)
    )


def load_users(spark: SparkSession, path: str) -> Split:
    return split_rejects(read_landing(spark, path, "users"), "users")


def load_feature_usage(spark: SparkSession, path: str) -> Split:
    accepted, rejects = split_rejects(
        read_landing(spark, path, "feature_usage"), "feature_usage"
    )
    return Split(accepted.withColumn("id", usage_key()), rejects)


def load_support_tickets(spark: SparkSession, path: str) -> Split:
    return split_rejects(read_landing(spark, path, "support_tickets"), "support_tickets")


class Loaded(NamedTuple):
    users: DataFrame
    feature_usage: DataFrame
    support_tickets: DataFrame
    rejects: DataFrame


def load_all(
    spark: SparkSession, users_csv: str, usage_csv: str, tickets_csv: str
) -> Loaded:
    """Users first, then both children, which must name a loaded user; keys load once.

    Each file is read and checked once, and each further step is stored with its verdict on
    every row: rows loaded and rejects are both read from there.
    """
    return _load(spark, users_csv, usage_csv, tickets_csv, None)


def _load(
    spark: SparkSession, users_csv: str, usage_csv: str, tickets_csv: str, index: KeyIndex | None
) -> Loaded:
    def read(path: str, table: str) -> Split:
        checked = written(checked_rows(read_landing(spark, path, table), table), f"checked-{table}")
        return split_checked(checked, table)

    users, usage = read(users_csv, "users"), read(usage_csv, "feature_usage")
    tickets = read(tickets_csv, "support_tickets")
    usage = Split(usage.accepted.withColumn("id", usage_key()), usage.rejects)
    parts = [users.rejects, usage.rejects, tickets.rejects]

    def keyed(rows: DataFrame, table: str) -> DataFrame:
        keys = None if index is None else index.keys(table)
        split = split_keyed(written(keyed_rows(rows, table, keys), f"keyed-{table}"), table)
        parts.append(split.rejects)
        return split.accepted

    people, asked = keyed(users.accepted, "users"), keyed(tickets.accepted, "support_tickets")
    known = people.select("user_id")
    if index is not None:
        known = known.union(index.keys("users"))
    lost = written(lost_users([usage.accepted, asked], known), "lost-users")

    def owned(rows: DataFrame, table: str) -> DataFrame:
        split = split_owned(written(owned_rows(rows, lost), f"owned-{table}"), table)
        parts.append(split.rejects)
        return split.accepted

    uses, asked = owned(usage.accepted, "feature_usage"), owned(asked, "support_tickets")
    return Loaded(people, uses, asked, all_rejects(parts))


class KeyIndex:
    """The primary keys of all loads, so that a further one is checked without the rows of those
    before it.

    Keys lie sorted, in files with a bloom filter of their own; a load's keys join them, and
    Spark filters the index by a bloom filter of the load where that is smaller. Each load
    publishes its keys with its own list, so a load that dies leaves the index as it was.
    """

    TABLES = ("users", "support_tickets")

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.snapshots = spark, Snapshots(spark, root)

    def keys(self, table: str) -> DataFrame:
        """``key`` of every row loaded so far."""
        state = self.snapshots.current()
        folders = [self.snapshots.folder(t, w) for (t, _), w in state.parts.items() if t == table]
        if not folders:
            return self.spark.createDataFrame([], "key string")
        return self.spark.read.schema("key string").parquet(*folders)

    def holds(self, table: str, *keys: str) -> list[str]:
        """Which of a few keys are loaded; bloom filters skip the files without them."""
        return [r.key for r in self.keys(table).where(F.col("key").isin(*keys)).collect()]

    def load(self, name: str, users_csv: str, usage_csv: str, tickets_csv: str) -> Loaded:
        """A further load, named ``name``: keys of earlier loads are rejected, children may name
        users of earlier loads. Its rows are stored, then its keys are published."""
        state = self.snapshots.current()
        if any(part == name for _, part in state.parts):
            raise ValueError(f"load {name} is published already")
        loaded = _load(self.spark, users_csv, usage_csv, tickets_csv, self)
        put = {}
        for table in self.TABLES:
            put[table, name], folder = self.snapshots.new_folder(table)
            keys = getattr(loaded, table).select(F.col(TABLE_RULES[table].primary_key).alias("key"))
            keys.repartitionByRange("key").sortWithinPartitions("key").write.option(
                "parquet.bloom.filter.enabled#key", "true"
            ).parquet(folder)
        self.snapshots.publish(state, put)
        return loaded

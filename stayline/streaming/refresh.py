"""Live refresh: changed users, tickets and feature use update the scores of touched users.

History sits in folders by batch and user bucket, each file sorted by user. A
micro-batch stores its rows, reads only the buckets of the users it touches,
rescores those users and stores their scores. Each batch owns its folders and
replaces them when it is retried, so a lost executor or a restarted query
changes nothing. No streaming state is held: its size follows the batch, not
the history. ``buckets`` bounds what a touched user costs; choose it so that a
bucket holds about as many users as a batch touches (``buckets_for``).

Rows of users that are not known yet are stored and named in the batch's
rejects; when the user arrives, they count.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import adoption_ordinal
from ..operators import scoring
from ..operators.summary import user_facts
from ..rules import ScoringRules
from ..schemas import CHURN_SCORES, FEATURE_USAGE, STATUSES, SUPPORT_TICKETS, USERS

SEED = -1  # batch number of the rows that were there before the stream
KEYS = {
    "users": ["user_id"], "support_tickets": ["ticket_id"],
    "feature_usage": ["user_id", "feature"],
}
VERSION = "version"  # order of changes in their source, such as an offset or a time in ms
USERS_PER_BUCKET = 1000
SCHEMAS = {"users": USERS, "support_tickets": SUPPORT_TICKETS, "feature_usage": FEATURE_USAGE}


def buckets_for(users: int) -> int:
    return max(1, -(-users // USERS_PER_BUCKET))


def change_stream(
    tickets: DataFrame | None = None, usage: DataFrame | None = None,
    users: DataFrame | None = None, clock: DataFrame | None = None,
) -> DataFrame:
    """One stream of all kinds of change, so that one query orders its batches.

    ``clock`` has dates in ``as_of``; live scores move on to the last one of a batch.

    A ``version`` column (bigint) orders the changes of one batch; without one
    the more advanced of two versions is taken to be the later.
    """
    parts = [
        df.select(
            F.lit(kind).alias("kind"),
            F.struct(*(SCHEMAS[kind].names if kind in SCHEMAS else ["as_of"])).alias(kind),
            (F.col(VERSION) if VERSION in df.columns else F.lit(None)).cast("bigint")
            .alias(VERSION),
        )
        for kind, df in (
            ("support_tickets", tickets), ("feature_usage", usage), ("users", users),
            ("clock", clock),
        ) if df is not None
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def _progress(table: str) -> Column:
    """Between unnumbered changes of one batch the more advanced one wins."""
    if table == "users":
        return F.struct("signup_date")
    if table == "feature_usage":
        return F.struct("last_used_date", adoption_ordinal(F.col("adoption_level")))
    rank = F.lit(0)
    for i, status in enumerate(STATUSES, start=1):
        rank = F.when(F.col("status") == status, i).otherwise(rank)
    return F.struct(rank, "resolved_date")


def latest(rows: DataFrame, table: str, *more: str) -> DataFrame:
    """Last version per key; copies of one key collapse before the shuffle.

    The keys leave as they were grouped, so that a later grouping by them needs no new shuffle,
    and no column is carried twice."""
    keys, names = KEYS[table], SCHEMAS[table].names
    version = F.struct(
        F.col("batch_id"), F.col(VERSION), _progress(table).alias("progress"),
        F.struct(*[c for c in names if c not in keys]).alias("row"),
    )
    return rows.groupBy(*keys).agg(F.max(version).alias("v")).select(
        *[c if c in keys else f"v.row.{c}" for c in names], f"v.{VERSION}", *[f"v.{c}" for c in more]
    )


class ScoreRefresh:
    """Keeps scores current under ``root``; ``buckets`` grows with the user base."""

    def __init__(
        self, spark: SparkSession, root: str, as_of: dt.date, buckets: int = 64,
        rules: ScoringRules = ScoringRules(),
    ):
        self.spark, self.root, self.as_of = spark, root.rstrip("/"), as_of
        self.buckets, self.rules = buckets, rules

    def _write(self, table: str, df: DataFrame, batch_id: int) -> None:
        bucket = F.pmod(F.xxhash64("user_id"), F.lit(self.buckets)).cast("int")
        (
            df.withColumn("bucket", bucket)
            .hint("rebalance", "bucket")  # few files per folder, large folders split
            .sortWithinPartitions("bucket", "user_id")
            .write.mode("overwrite").partitionBy("bucket")
            .parquet(f"{self.root}/{table}/batch_id={batch_id}")
        )

    def _read(self, table: str, upto: int, buckets: list[int] | None = None) -> DataFrame:
        schema = T.StructType([
            *SCHEMAS[table].fields, T.StructField(VERSION, T.LongType()),
            T.StructField("batch_id", T.IntegerType()), T.StructField("bucket", T.IntegerType()),
        ])
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        rows = rows.where(F.col("batch_id") <= upto)
        return rows if buckets is None else rows.where(F.col("bucket").isin(*buckets))

    def _score(self, users: DataFrame, usage: DataFrame, tickets: DataFrame, batch_id: int):
        run_ts = dt.datetime.combine(self.as_of, dt.time())
        facts = user_facts(users, usage, tickets, self.as_of)
        scores = scoring.churn_scores(scoring.score_users(facts, self.rules, run_ts))
        scores.write.mode("overwrite").parquet(f"{self.root}/scores/batch_id={batch_id}")

    def seed(self, users: DataFrame, usage: DataFrame, tickets: DataFrame) -> None:
        """Store the tables as they are before the stream, and score everyone."""
        for table, df in (
            ("users", users), ("feature_usage", usage), ("support_tickets", tickets)
        ):
            numbered = df.select(*SCHEMAS[table].names, F.lit(None).cast("bigint").alias(VERSION))
            self._write(table, numbered, SEED)
        stored = [
            self._read(t, SEED).select(*SCHEMAS[t].names)
            for t in ("users", "feature_usage", "support_tickets")
        ]
        self._score(*stored, SEED)

    def process(self, changes: DataFrame, batch_id: int) -> None:
        """One micro-batch; safe to repeat."""
        touched = None
        for table in KEYS:
            if table not in changes.columns:
                continue
            rows = changes.where(F.col("kind") == table).select(f"{table}.*", VERSION)
            self._write(
                table, latest(rows.withColumn("batch_id", F.lit(batch_id)), table), batch_id
            )
            keys = (
                self._read(table, batch_id).where(F.col("batch_id") == batch_id)
                .select("user_id", "bucket")
            )
            touched = keys if touched is None else touched.unionByName(keys)
        # Stored: five steps read it, and its size decides how they join.
        path = f"{self.root}/touched/batch_id={batch_id}"
        touched.distinct().write.mode("overwrite").parquet(path)
        touched = self.spark.read.schema("user_id string, bucket int").parquet(path)
        # At most one number per bucket reaches the driver.
        hit = [row.bucket for row in touched.select("bucket").distinct().collect()]
        if not hit:
            return
        ids = touched.select("user_id")

        def current(table: str) -> DataFrame:
            rows = self._read(table, batch_id, hit).join(ids, "user_id", "left_semi")
            return latest(rows, table).drop(VERSION)

        users = current("users")
        self._score(users, current("feature_usage"), current("support_tickets"), batch_id)
        ids.join(users.select("user_id"), "user_id", "left_anti").select(
            "user_id", F.lit("unknown_user").alias("reason")
        ).write.mode("overwrite").parquet(f"{self.root}/rejects/batch_id={batch_id}")

    def rejects(self) -> DataFrame:
        """Users that changes named before they were known, by batch."""
        schema = "user_id string, reason string, batch_id int"
        return self.spark.read.schema(schema).parquet(f"{self.root}/rejects")

    def start(self, changes: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        return (
            changes.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def current_scores(self) -> DataFrame:
        """Last score of every user."""
        schema = T.StructType([*CHURN_SCORES.fields, T.StructField("batch_id", T.IntegerType())])
        names = CHURN_SCORES.names
        return (
            self.spark.read.schema(schema).parquet(f"{self.root}/scores")
            .groupBy(F.col("user_id").alias("_user"))
            .agg(F.max_by(F.struct(*names), "batch_id").alias("row"))
            .select("row.*")
        )

    def compact(self, new_root: str, upto: int) -> "ScoreRefresh":
        """Fold all batches up to ``upto`` into a fresh seed under a new folder."""
        fresh = ScoreRefresh(self.spark, new_root, self.as_of, self.buckets, self.rules)
        fresh.seed(
            latest(self._read("users", upto), "users"),
            latest(self._read("feature_usage", upto), "feature_usage"),
            latest(self._read("support_tickets", upto), "support_tickets"),
        )
        return fresh

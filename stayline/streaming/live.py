"""Scores that follow changes: what a batch costs depends on what it changes.

The state of a user is a multiset of facts, ``(user_id, fact, label, level, number, n)``: a
ticket is one by category, priority while it is open, and rating; a use is one by feature,
adoption level and day. A change of a ticket or of a use adds the fact of its new version and
takes back that of the version before, so counts, minima, maxima and averages follow from the
sums of ``n`` without any history. A batch reads the former versions of the rows it changes and
the facts of the users it touches.

Time changes scores too: a user's idle days cross a bound of the point table on a day that is
known in advance. The due table holds that day; when the date advances, the users due since
are read by date and scored again, nobody else.

All tables are segments of rows in folders by bucket of a hash, listed by snapshots: a batch
writes new segments and publishes them together with its number, so a repeated batch changes
nothing and a killed one leaves the state as it was. When ``FAN`` segments of one level have
gathered they are merged into one of the next, so a bucket is read from few segments and a
row is rewritten a few times only. Rows are bucketed by their own key: tickets of one account
are spread over all buckets, and its facts stay as few as its different kinds of ticket and use.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import adoption_ordinal, days_between, domain_masks, is_open, joined_or_null
from ..operators import scoring
from ..operators.summary import _or_all, _values, user_profile
from ..rules import AdviceRules, ScoringRules
from ..schemas import CATEGORIES, FEATURE_USAGE, SUPPORT_TICKETS, USERS
from ..sources.snapshots import Snapshot, Snapshots
from .refresh import KEYS, SCHEMAS, VERSION, latest

FAN = 8  # segments of one level that are merged
MAX_BUCKETS = 4096  # folders of a segment; a batch brings at most as many numbers to the driver
IDLE = "days_since_last_activity"
COUNTS = (
    "total_tickets", "open_tickets", "critical_open_tickets", "open_critical", "open_high",
    "open_other",
)
LISTS = ("features", "adopted", "categories")
JOINED = {"features_list": "features", "ticket_categories": "categories"}
TICKET, USE, NAMED = 1, 2, 3  # facts; the last marks users to be scored
FEW = 100_000  # rows naming users whose facts are picked out before they are dealt; of more, their buckets are dealt
CRITICAL, HIGH, OTHER = 1, 2, 3  # levels of open tickets; others have none

_STAMP = [T.StructField("batch_id", T.LongType())]
_VERSIONED = [T.StructField(VERSION, T.LongType()), *_STAMP]
FACTS = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("fact", T.IntegerType()),
    T.StructField("label", T.StringType()), T.StructField("level", T.IntegerType()),
    T.StructField("number", T.IntegerType()), T.StructField("n", T.LongType()),
])
SCORED = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("score", T.LongType()),
    T.StructField("risk_level", T.StringType()), T.StructField("last_activity", T.DateType()), *_STAMP,
])
DUE = T.StructType([
    T.StructField("user_id", T.StringType()), *_STAMP, T.StructField("due_date", T.DateType()),
])
STORED = {
    **{name: T.StructType([*SCHEMAS[name].fields, *_VERSIONED]) for name in KEYS},
    "facts": FACTS, "scores": SCORED, "due": DUE,
}
BUCKET_BY = {**KEYS, "facts": ["user_id"], "scores": ["user_id"]}


def _fact(table: str) -> list[Column]:
    """The fact that a row of a child table is."""
    if table == "support_tickets":
        priority = F.col("priority")
        kind = F.when(priority == "Critical", CRITICAL).when(priority == "High", HIGH).otherwise(OTHER)
        fact, label, level = TICKET, F.col("category"), F.when(is_open(F.col("status")), kind)
        number = F.col("csat_score")
    else:
        fact, label, level = USE, F.col("feature"), adoption_ordinal(F.col("adoption_level"))
        number = F.unix_date("last_used_date")
    return [F.col("user_id"), F.lit(fact).alias("fact"), label.alias("label"), level.alias("level"),
            number.alias("number")]


def _counted(facts: DataFrame, sign: int) -> DataFrame:
    """Facts that are added (``sign`` 1) or taken back (-1); a use of which nothing is known is none."""
    told = F.coalesce("label", F.col("level").cast("string"), F.col("number").cast("string"))
    return facts.where((F.col("fact") == TICKET) | told.isNotNull()).withColumn("n", F.lit(sign).cast("bigint"))


def summed(facts: DataFrame) -> DataFrame:
    """One row per user and fact; what has been taken back is gone. Without labels if there are none."""
    by = [c for c in FACTS.names if c in facts.columns and c != "n"]
    return facts.groupBy(*by).agg(F.sum("n").alias("n")).where("n <> 0")


def figures(facts: DataFrame, *more: Column) -> DataFrame:
    """Per-user figures, named as in the summary, and ``more`` ones, from summed facts."""
    level, number, n = F.col("level"), F.col("number"), F.col("n")
    ticket, use = F.col("fact") == TICKET, F.col("fact") == USE
    count = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0).cast("bigint"))
    rated = count(ticket & number.isNotNull())
    total = F.sum(F.when(ticket, number.cast("bigint") * n))
    return facts.groupBy("user_id").agg(
        F.date_from_unix_date(F.max(F.when(use, number))).alias("last_activity"),
        F.min(F.when(use, level)).alias("worst_adoption_level"),
        F.max(F.when(use, level)).alias("best_adoption_level"),
        count(ticket).alias("total_tickets"),
        count(ticket & level.isNotNull()).alias("open_tickets"),
        count(ticket & level.isin(CRITICAL, HIGH)).alias("critical_open_tickets"),
        count(ticket & (level == CRITICAL)).alias("open_critical"),
        count(ticket & (level == HIGH)).alias("open_high"),
        count(ticket & (level == OTHER)).alias("open_other"),
        F.min(F.when(ticket, number)).alias("worst_csat"),
        F.when(rated > 0, F.round(total / rated, 1)).alias("avg_csat"),
        F.max(F.col("fact") == NAMED).alias("named"), *more,
    )


def figures_and_lists(facts: DataFrame, advice: AdviceRules) -> DataFrame:
    """Figures, features and categories. Known values are bits of masks; others have a branch of
    their own, whose join adaptive execution drops where there are none."""
    label, ticket, use = F.col("label"), F.col("fact") == TICKET, F.col("fact") == USE
    adopted = use & (F.col("level") >= advice.adopted_from)
    lists = {
        "features": (use, advice.catalogue), "adopted": (adopted, advice.catalogue),
        "categories": (ticket, CATEGORIES),
    }
    masks = [
        mask for name, (held, domain) in lists.items()
        for mask in _or_all(name, [F.when(held, bit) for bit in domain_masks(label, domain)])
    ]
    unlisted = (use & ~label.isin(*advice.catalogue)) | (ticket & ~label.isin(*CATEGORIES))
    others = facts.where(unlisted).groupBy("user_id").agg(*[
        F.collect_set(F.when(held, label)).alias(f"more_{name}") for name, (held, _) in lists.items()
    ])
    out = figures(facts, *masks).join(others, "user_id", "left")
    kept = [c for c in out.columns if not c.startswith(tuple(lists)) and not c.startswith("more_")]
    return out.select(*kept, *[
        _values(name, f"more_{name}", domain, False).alias(name) for name, (_, domain) in lists.items()
    ])


def crossings(rules: ScoringRules) -> list[int]:
    """The numbers of idle days at which points change."""
    days = set()
    for rule in rules.points:
        if rule.metric == IDLE:
            days |= {d for d in (rule.low, None if rule.high is None else rule.high + 1) if d is not None}
            if rule.per_unit or rule.equals is not None:
                raise ValueError("idle days may give points by ranges only")
    return sorted(days)


class LiveScores:
    """Scores under ``root``, kept current through changes and the passing of days."""

    def __init__(
        self, spark: SparkSession, root: str, buckets: int = 64,
        rules: ScoringRules = ScoringRules(), advice: AdviceRules = AdviceRules(),
    ):
        if not 0 < buckets <= MAX_BUCKETS:
            raise ValueError(f"buckets: 1 to {MAX_BUCKETS}")
        self.spark, self.buckets, self.rules, self.advice = spark, buckets, rules, advice
        self.snapshots = Snapshots(spark, root)
        self.days = crossings(rules)
        self.lists = any(r.metric in (*LISTS, *JOINED) for r in rules.points)

    # Segments ------------------------------------------------------------------------

    def _bucket(self, table: str) -> Column:
        return F.pmod(F.xxhash64(*BUCKET_BY[table]), F.lit(self.buckets)).cast("int")

    def _store(self, table: str, rows: DataFrame) -> tuple[str, DataFrame]:
        """Rows as a new segment: its write id, and the rows as they are stored."""
        write, folder = self.snapshots.new_folder(table)
        rows = rows.select(*STORED[table].names)
        by = "due_date"
        if table != "due":
            rows, by = rows.withColumn("bucket", self._bucket(table)), "bucket"
        rows.hint("rebalance", by).sortWithinPartitions(by).write.partitionBy(by).parquet(folder)
        return write, self._load(table, [folder])

    def _load(self, table: str, folders: list[str]) -> DataFrame:
        schema = STORED[table]
        if table != "due":
            schema = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        if not folders:
            return self.spark.createDataFrame([], schema)
        base = f"{self.snapshots.root}/{table}"
        schema = T.StructType([*schema.fields, T.StructField("write", T.StringType())])
        return self.spark.read.schema(schema).option("basePath", base).parquet(*folders).drop("write")

    def _rows(self, table: str, state: Snapshot, buckets: list[int] | None = None) -> DataFrame:
        folders = [self.snapshots.folder(t, w) for (t, _), w in state.parts.items() if t == table]
        rows = self._load(table, folders)
        return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))

    def _state(self) -> tuple[Snapshot, dict]:
        state = self.snapshots.current()
        return state, json.loads(state.note) if state.note else {}

    @property
    def as_of(self) -> dt.date:
        """The date the stored scores are of."""
        return dt.date.fromisoformat(self._state()[1]["as_of"])

    def _publish(self, state: Snapshot, written: dict[str, str], batch_id: int, serial: int, as_of: dt.date):
        put = {(table, f"0-{serial:012d}"): write for table, write in written.items()}
        note = json.dumps({"as_of": as_of.isoformat(), "batch": batch_id, "serial": serial})
        self._merge(self.snapshots.publish(state, put, note=note), as_of)

    def _merge(self, state: Snapshot, as_of: dt.date) -> None:
        """Merges the segments of a level once there are enough of them."""
        put, drop = {}, []
        for table in STORED:
            level = 0
            while True:
                held = {**state.parts, **put}
                parts = sorted(p for t, p in held if t == table and p.startswith(f"{level}-") and (t, p) not in drop)
                if len(parts) < FAN:
                    break
                rows = self._load(table, [self.snapshots.folder(table, held[table, p]) for p in parts])
                write, _ = self._store(table, self._merged(table, rows, as_of))
                drop += [(table, p) for p in parts]
                level += 1
                put[table, f"{level}-{parts[-1].partition('-')[2]}"] = write
        if put:
            put = {key: write for key, write in put.items() if key not in drop}
            self.snapshots.publish(state, put, drop)

    def _merged(self, table: str, rows: DataFrame, as_of: dt.date) -> DataFrame:
        if table == "facts":
            return summed(rows)
        if table in KEYS:
            return latest(rows, table, "batch_id")
        if table == "due":
            rows = rows.where(F.col("due_date") > F.lit(as_of))
        return self._last_by_user(rows, STORED[table].names)

    @staticmethod
    def _last_by_user(rows: DataFrame, names: list[str]) -> DataFrame:
        return (
            rows.groupBy(F.col("user_id").alias("_user"))
            .agg(F.max_by(F.struct(*names), "batch_id").alias("row")).select("row.*")
        )

    # Changes and days ----------------------------------------------------------------

    def seed(self, users: DataFrame, usage: DataFrame, tickets: DataFrame, as_of: dt.date) -> None:
        """Stores the tables as they are before the stream, and scores everyone."""
        changes = {"users": users, "feature_usage": usage, "support_tickets": tickets}
        state, note = self._state()
        if note:
            raise RuntimeError("seeded already")
        self._apply(state, {t: df.withColumn(VERSION, F.lit(None).cast("bigint"))
                            for t, df in changes.items()}, -1, 0, as_of)

    def process(self, changes: DataFrame, batch_id: int) -> None:
        """One micro-batch of ``change_stream``; a repeated one changes nothing."""
        state, note = self._state()
        if batch_id <= note["batch"]:
            return
        as_of = dt.date.fromisoformat(note["as_of"])
        clock = F.max("clock.as_of") if "clock" in changes.columns else F.lit(None).cast("date")
        kinds = {r.kind: r.moved for r in changes.groupBy("kind").agg(clock.alias("moved")).collect()}
        moved = kinds.get("clock")
        if moved and moved > as_of:
            self.advance(moved)
            state, note = self._state()
            as_of = moved
        rows = {
            table: changes.where(F.col("kind") == table).select(f"{table}.*", VERSION)
            for table in KEYS if table in kinds
        }
        self._apply(state, rows, batch_id, note["serial"] + 1, as_of)

    def _apply(
        self, state: Snapshot, changes: dict[str, DataFrame], batch_id: int, serial: int,
        as_of: dt.date,
    ) -> None:
        written, delta, touched = {}, None, None
        for table, rows in changes.items():
            rows = rows.withColumn("batch_id", F.lit(serial).cast("bigint"))
            written[table], new = self._store(table, latest(rows, table, "batch_id"))
            if table == "users":
                touched = new.select("user_id", "bucket")
                continue
            parts = [_counted(new.select(*_fact(table)), 1)]
            if any(t == table for t, _ in state.parts):
                parts.append(_counted(self._replaced(table, state, new), -1))
            for part in parts:
                delta = part if delta is None else delta.unionByName(part)
        if delta is not None:
            written["facts"], stored = self._store("facts", summed(delta))
            ids = stored.select("user_id", "bucket")
            touched = ids if touched is None else touched.unionByName(ids)
        if touched is None:
            return
        now = Snapshot(state.version, {
            **state.parts, **{(t, f"0-{serial:012d}"): w for t, w in written.items()}
        }, "", {})
        written |= self._score(now, touched, serial, as_of)
        self._publish(state, written, batch_id, serial, as_of)

    def _replaced(self, table: str, state: Snapshot, new: DataFrame) -> DataFrame:
        """The facts of the last versions before ``new``. A segment has a key once."""
        keys = KEYS[table]
        met = [r.bucket for r in new.select("bucket").distinct().collect()]
        before = self._rows(table, state, met).join(new.select(*keys), keys, "left_semi")
        last = F.max_by(F.struct(*_fact(table)), "batch_id").alias("last")
        return before.groupBy(*keys).agg(last).select("last.*")

    def advance(self, to: dt.date) -> None:
        """Moves the date on: users whose idle days cross a bound by then are scored again."""
        state, note = self._state()
        since = dt.date.fromisoformat(note["as_of"])
        if to <= since:
            return
        serial = note["serial"] + 1
        due = self._rows("due", state).where(
            (F.col("due_date") > F.lit(since)) & (F.col("due_date") <= F.lit(to))
        ).select("user_id", self._bucket("users").alias("bucket"))
        written = self._score(state, due, serial, to, since)
        self._publish(state, written, note["batch"], serial, to)

    def _facts(self, state: Snapshot, users: DataFrame | None = None, lists: bool = True) -> DataFrame:
        """Profile, figures and, with ``lists``, features and categories of the named users, or of
        all known."""
        facts, people = self._rows("facts", state), self._rows("users", state)
        if users is not None:
            met = {r.bucket: r["count"] for r in users.groupBy("bucket").count().collect()}
            users = users.select("user_id").distinct()
            facts, people = (rows.where(F.col("bucket").isin(list(met))) for rows in (facts, people))
            if sum(met.values()) <= FEW:
                facts, people = (rows.join(users, "user_id", "left_semi") for rows in (facts, people))
            marks = users.select("user_id", F.lit(NAMED).alias("fact"), F.lit(1).cast("bigint").alias("n"))
            facts = facts.unionByName(marks, allowMissingColumns=True)
        facts = facts.select(*[c for c in FACTS.names if lists or c != "label"])
        # Dealt by user at once, for the sums, the figures and the join: a segment has few rows of a user.
        sums = summed(facts.repartition("user_id"))
        found = figures_and_lists(sums, self.advice) if lists else figures(sums)
        # A segment has a user once; column by column, for those not needed are not read.
        last = people.groupBy("user_id").agg(*[
            F.max_by(c, "batch_id").alias(c) for c in USERS.names if c != "user_id"
        ])
        profile, how = user_profile(last), "left"
        if users is not None:
            found, how = found.where("named"), "inner"
        zero, none = F.lit(0).cast("bigint"), F.array().cast("array<string>")
        out = profile.join(found.drop("named"), "user_id", how).withColumns(
            {c: F.coalesce(c, zero) for c in COUNTS}
        )
        if not lists:
            return out
        return out.withColumns({c: F.coalesce(c, none) for c in LISTS}).withColumns({
            name: joined_or_null(F.col(c)) for name, c in JOINED.items()
        })

    def _score(
        self, state: Snapshot, users: DataFrame, serial: int, as_of: dt.date,
        since: dt.date | None = None,
    ) -> dict[str, str]:
        """Segments with the scores of the users and the days they are next due."""
        facts = self._facts(state, users, self.lists).withColumn(IDLE, days_between(as_of, F.col("last_activity")))
        if since is not None:  # a date that a later use has put off is not due
            before = days_between(since, F.col("last_activity"))
            crossed = F.lit(False)
            for day in self.days:
                crossed = crossed | ((before < day) & (F.col(IDLE) >= day))
            facts = facts.where(crossed)
        written = {}
        written["scores"], stored = self._store("scores", scoring.score_users(facts, self.rules).withColumn(
            "batch_id", F.lit(serial).cast("bigint")
        ))
        none = F.lit(None).cast("date")
        idle = days_between(as_of, F.col("last_activity"))
        next_due = F.least(none, none, *[
            F.when(idle < day, F.date_add("last_activity", day)) for day in self.days
        ])
        written["due"], _ = self._store(
            "due", stored.withColumn("due_date", next_due).where("due_date IS NOT NULL")
        )
        return written

    # Readers -------------------------------------------------------------------------

    def current_scores(self) -> DataFrame:
        """Last score of every user."""
        return self._last_by_user(
            self._rows("scores", self._state()[0]), ["user_id", "score", "risk_level"]
        )

    def current_facts(self) -> DataFrame:
        """Profile and figures of every user, as of the stored date."""
        state, note = self._state()
        as_of = dt.date.fromisoformat(note["as_of"])
        return self._facts(state).withColumn(IDLE, days_between(as_of, F.col("last_activity")))

    def unknown_users(self) -> DataFrame:
        """Users with facts but no profile; they are scored once their profile arrives."""
        state = self._state()[0]
        known = self._rows("users", state).select("user_id")
        return summed(self._rows("facts", state)).select("user_id").distinct().join(
            known, "user_id", "left_anti"
        )

    def start(self, changes: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        return (
            changes.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

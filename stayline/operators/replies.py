"""Model replies to rows. Input: ``reply_id``, ``raw`` (one reply text per row).

The reply text sits in one of several envelopes, maybe inside code fences. An
unreadable reply or row goes to the rejects with a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import (
    first_non_empty, not_empty, strip_fences, trim_all, with_computed,
)
from ..rules import ScoringRules
from ..schemas import AT_RISK_LEVELS, URGENCIES
from ..session import written
from .ingest import Split
from .scoring import classify

# Where a reply's text may sit, tried in this order
ENVELOPES = ("$.output[0].content[0].text", "$.message.content", "$.text")

STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
SCORING_FIELDS = ("user_id", "score", "risk_level", "reasons")
RECOMMENDATION_FIELDS = ("user_id", "risk_level", "urgency", "recommendation", "reasoning")
REPORT_FIELDS = (
    "title", "executive_summary", "key_metrics", "top_risk_clients", "action_items",
)
REJECT_COLUMNS = ("kind", "reply_id", "position", "user_id", "reason")


def read_replies(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines files with ``reply_id`` and ``raw``."""
    return spark.read.schema("reply_id string, raw string").json(path)


def _with_text(replies: DataFrame) -> DataFrame:
    """Adds ``text``. Every envelope is looked into once a reply: the steps are columns of their
    own, as an expression that names another one twice would run it twice."""
    places = [f"place_{i}" for i in range(len(ENVELOPES))]
    found = with_computed(replies, {
        name: F.get_json_object("raw", path) for name, path in zip(places, ENVELOPES, strict=True)
    })
    text = trim_all(strip_fences(first_non_empty(*map(F.col, places), F.col("raw"))))
    return with_computed(found, {"text": text}).drop(*places)


def _with_json_value(texts: DataFrame) -> DataFrame:
    """Adds ``value``, the text if it is exactly one JSON value, else NULL.

    Read as the only entry of an array: trailing text makes that fail.
    """
    array = F.concat(F.lit("["), F.col("text"), F.lit("]"))
    read = with_computed(texts, {"entries": F.from_json(array, "array<string>", STRICT)})
    value = F.when(F.size("entries") == 1, F.element_at("entries", 1))
    return with_computed(read, {"value": value})


def _fields(value: Column, names: tuple[str, ...]) -> Column:
    return F.from_json(value, ", ".join(f"{n} string" for n in names), STRICT)


def _with_value(replies: DataFrame) -> DataFrame:
    """Each reply once, however often it was delivered; ``reply_key`` tells apart different
    texts under one id."""
    once = replies.dropDuplicates(["reply_id", "raw"])
    return _with_json_value(_with_text(once)).select(
        "reply_id", F.xxhash64("raw").alias("reply_key"), "value"
    )


def _whole_number(text: Column) -> Column:
    """JSON numbers such as 45, 45.0 or 4.5e1 as a whole number; NULL for any other."""
    number = text.try_cast("decimal(38,10)")
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def read_scoring_replies(
    replies: DataFrame, rules: ScoringRules = ScoringRules()
) -> DataFrame:
    """One row per element; ``reason`` tells what is wrong, NULL if nothing is.

    An empty text is a fine reason: it is what a score of 0 has.
    """
    value = F.col("value")
    is_array = value.startswith("[")
    rows = _with_value(replies).select(
        "reply_id", "reply_key",
        F.when(value.isNull(), "bad_json").when(~is_array, "not_array").alias("failure"),
        F.posexplode_outer(
            F.when(is_array, F.from_json(value, "array<string>", STRICT))
        ).alias("position", "element"),
    )
    # An empty array holds no rows and is no fault.
    rows = rows.where(F.col("failure").isNotNull() | F.col("position").isNotNull())
    element = F.col("element")
    parsed = with_computed(
        rows, {"f": F.when(element.startswith("{"), _fields(element, SCORING_FIELDS))}
    )
    score = _whole_number(F.col("f.score"))
    incomplete = _incomplete("f", ("user_id", "score", "risk_level")) | F.col("f.reasons").isNull()
    reason = (
        F.when(F.col("failure").isNotNull(), F.col("failure"))
        .when(F.col("f").isNull(), "not_object")
        .when(incomplete, "missing_field")
        .when(score.isNull(), "bad_score")
        .when(F.col("f.risk_level") != classify(score, rules), "level_mismatch")
    )
    return parsed.select(
        "reply_id", "reply_key", "position", "f.user_id", score.alias("score"), "f.risk_level", "f.reasons",
        reason.alias("reason"),
    )


def _incomplete(struct: str, names: tuple[str, ...]) -> Column:
    missing = F.lit(False)
    for name in names:
        missing = missing | ~not_empty(F.col(f"{struct}.{name}"))
    return missing


def _identity_checked(rows: DataFrame, users: DataFrame) -> DataFrame:
    """Marks unknown users, and every readable row after a user's first.

    First rows come from an aggregate, so an id repeated endlessly collapses
    map-side. They are joined back by their place, which is unique: no task
    meets all rows of one id.
    """
    place = F.struct("reply_id", "reply_key", "position")
    first = (
        rows.where("reason IS NULL")
        .groupBy("user_id")
        .agg(F.min(place).alias("place"))
        .join(users.select("user_id", F.lit(True).alias("known")), "user_id", "left")
        .select("place.*", F.coalesce("known", F.lit(False)).alias("known"))
    )
    reason = F.coalesce(
        F.col("reason"),
        F.when(F.col("known").isNull(), "repeated_user").when(~F.col("known"), "unknown_user"),
    )
    return (
        rows.join(first, ["reply_id", "reply_key", "position"], "left")
        .withColumn("reason", reason).drop("known")
    )


def _split(rows: DataFrame, kind: str, columns: tuple[str, ...]) -> Split:
    rejects = rows.where("reason IS NOT NULL").select(
        F.lit(kind).alias("kind"), *REJECT_COLUMNS[1:]
    )
    return Split(rows.where("reason IS NULL").select("reply_id", *columns), rejects)


def parse_scoring_replies(
    replies: DataFrame, users: DataFrame, rules: ScoringRules = ScoringRules()
) -> Split:
    """Accepted rows and rejects. The replies are parsed once, into a written table."""
    rows = written(read_scoring_replies(replies, rules), "parsed-scores")
    return _split(_identity_checked(rows, users), "scoring", SCORING_FIELDS)


def read_recommendation_replies(replies: DataFrame) -> DataFrame:
    value = F.col("value")
    parsed = with_computed(
        _with_value(replies),
        {"f": F.when(value.startswith("{"), _fields(value, RECOMMENDATION_FIELDS))},
    )
    reason = (
        F.when(value.isNull(), "bad_json")
        .when(F.col("f").isNull(), "not_object")
        .when(_incomplete("f", RECOMMENDATION_FIELDS), "missing_field")
        .when(~F.col("f.risk_level").isin(*AT_RISK_LEVELS), "bad_risk_level")
        .when(~F.col("f.urgency").isin(*URGENCIES), "bad_urgency")
    )
    return parsed.select(
        "reply_id", "reply_key", F.lit(0).alias("position"), "f.*", reason.alias("reason")
    )


def parse_recommendation_replies(replies: DataFrame, users: DataFrame) -> Split:
    """Accepted rows and rejects. The replies are parsed once, into a written table."""
    rows = written(read_recommendation_replies(replies), "parsed-advice")
    return _split(_identity_checked(rows, users), "recommendation", RECOMMENDATION_FIELDS)


def parse_report_reply(replies: DataFrame) -> DataFrame:
    """First reply by id; the two structured fields stay JSON text."""
    first = replies.orderBy("reply_id").limit(1)
    rows = _with_value(first).where(F.col("value").startswith("{"))
    return with_computed(rows, {"f": _fields(F.col("value"), REPORT_FIELDS)}).select(
        "f.*", F.lit("ai_agent").alias("generated_by")
    )

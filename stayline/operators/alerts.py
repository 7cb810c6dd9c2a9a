"""Alert queue, digest and the filterable alerts table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import (
    is_at_risk, not_empty, plural_s, shorten, spanish_long_date,
)
from ..schemas import RISK_LEVELS


# The headline of the alert mail
HEADLINE = ("Se identificaron ", " cliente", " que requieren contacto inmediato")


def join_results(scores: DataFrame, recommendations: DataFrame, users: DataFrame) -> DataFrame:
    """Stored results side by side, one row per scored user."""
    advice = recommendations.select("user_id", "urgency", "recommendation", "reasoning")
    profile = users.select("user_id", "plan", "country", "mrr_usd")
    return scores.join(profile, "user_id").join(advice, "user_id", "left")


def alert_queue(results: DataFrame) -> DataFrame:
    """Users to contact today."""
    return results.where(not_empty(F.col("urgency")) & (F.col("urgency") == "inmediata")).select(
        "user_id", "score", "risk_level", "urgency", "plan", "mrr_usd", "recommendation",
    )


def alert_digest(queue: DataFrame, as_of: dt.date) -> DataFrame:
    """One summary row of the queue; no row if nothing is urgent."""
    total = F.col("total")
    return (
        queue.agg(
            F.count("*").alias("total"),
            *[F.count(F.when(F.col("risk_level") == level, 1)).alias(level)
              for level in RISK_LEVELS],
        )
        .where("total > 0")
        .withColumns({
            "date_text": spanish_long_date(F.lit(as_of)),
            "headline": F.concat(
                F.lit(HEADLINE[0]), total.cast("string"), F.lit(HEADLINE[1]),
                plural_s(total), F.lit(HEADLINE[2]),
            ),
        })
    )


def alerts_table(results: DataFrame, width: int = 80) -> DataFrame:
    return results.where(is_at_risk(F.col("risk_level"))).select(
        "user_id", "score", "risk_level", "urgency", "country", "plan", "mrr_usd",
        shorten(F.col("recommendation"), width).alias("recommendation_short"),
    )


def alerts_filtered(
    alerts: DataFrame, *, risk_level: str | None = None, urgency: str | None = None,
    country: str | None = None, plan: str | None = None,
) -> DataFrame:
    wanted = {"risk_level": risk_level, "urgency": urgency, "country": country, "plan": plan}
    for column, value in wanted.items():
        if value is not None:
            alerts = alerts.where(F.col(column) == value)
    return alerts


def alerts_search(alerts: DataFrame, text: str, exact: bool = False) -> DataFrame:
    user = F.col("user_id")
    return alerts.where(user == text if exact else user.contains(text))

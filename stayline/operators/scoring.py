"""Rule points, total score, risk level and reasons, all as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import run_timestamp, with_computed
from ..rules import PointRule, ScoringRules

SCORE_COLUMNS = ("user_id", "score", "risk_level", "reasons", "analyzed_at")


def _fires(rule: PointRule) -> Column:
    metric = F.col(rule.metric)
    if rule.equals is not None:
        return metric == rule.equals
    cond = F.lit(True)
    if rule.low is not None:
        cond = cond & (metric >= rule.low)
    if rule.high is not None:
        cond = cond & (metric <= rule.high)
    return cond & metric.isNotNull()


def _points(rule: PointRule) -> Column:
    points = F.lit(rule.points).cast("bigint")
    return points * F.col(rule.metric) if rule.per_unit else points


def _text(rule: PointRule) -> Column:
    head, mark, tail = rule.detail.partition("{n}")
    if not mark:
        return F.lit(rule.detail)
    return F.concat(F.lit(head), F.col(rule.metric).cast("string"), F.lit(tail))


def _first_match(rules: tuple[PointRule, ...], value, default) -> Column:
    chain = F
    for rule in rules:
        chain = chain.when(_fires(rule), value(rule))
    return chain.otherwise(default)


def signal_points(rules: ScoringRules, signal: str) -> Column:
    """Points of one signal; a missing figure gives 0."""
    return _first_match(rules.of(signal), _points, F.lit(0).cast("bigint"))


def signal_detail(rules: ScoringRules, signal: str) -> Column:
    return _first_match(rules.of(signal), _text, F.lit(None).cast("string"))


def classify(score: Column, rules: ScoringRules) -> Column:
    return (
        F.when(score >= rules.high_from, "alto")
        .when(score >= rules.medium_from, "medio")
        .otherwise("bajo")
    )


def score_users(
    facts: DataFrame, rules: ScoringRules = ScoringRules(), run_ts: dt.datetime | None = None
) -> DataFrame:
    """Adds ``points_<signal>``, ``score``, ``risk_level``, ``reasons`` and ``analyzed_at``."""
    signals = rules.signals()
    scored = with_computed(
        facts, {f"points_{signal}": signal_points(rules, signal) for signal in signals}
    )
    total = F.lit(0).cast("bigint")
    for signal in signals:
        total = total + F.col(f"points_{signal}")
    return scored.withColumn("score", total).withColumns(
        {
            "risk_level": classify(F.col("score"), rules),
            "reasons": F.concat_ws(", ", *[_reason_line(rules, s) for s in signals]),
            "analyzed_at": run_timestamp(run_ts),
        }
    )


def _reason_line(rules: ScoringRules, signal: str) -> Column:
    points = F.col(f"points_{signal}")
    line = F.concat(signal_detail(rules, signal), F.lit(" (+"), points.cast("string"), F.lit(")"))
    return F.when(points > 0, line)


def churn_scores(scored: DataFrame) -> DataFrame:
    return scored.select(*SCORE_COLUMNS)


def churn_reasons(scored: DataFrame, rules: ScoringRules = ScoringRules()) -> DataFrame:
    """One row per user and fired signal; the points of a user add up to the score."""
    rows = F.array(*[
        F.struct(
            F.lit(signal).alias("signal"),
            signal_detail(rules, signal).alias("detail"),
            F.col(f"points_{signal}").alias("points"),
        )
        for signal in rules.signals()
    ])
    return scored.select("user_id", F.inline(rows)).where("points > 0")


def risk_factor_counts(scored: DataFrame, rules: ScoringRules = ScoringRules()) -> DataFrame:
    """Users per signal and their share of all scored users, in one aggregate."""
    signals = rules.signals()
    totals = scored.agg(
        F.count("*").alias("scored"),
        *[F.count(F.when(F.col(f"points_{s}") > 0, 1)).alias(s) for s in signals],
    )
    rows = F.array(*[
        F.struct(F.lit(s).alias("signal"), F.col(s).alias("users"),
                 (F.col(s) / F.col("scored")).alias("share"))
        for s in signals
    ])
    return totals.where("scored > 0").select(F.inline(rows)).where("users > 0")

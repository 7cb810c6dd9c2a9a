"""The chained run: scores, then recommendations, then alerts and the report."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import is_at_risk, run_timestamp
from ..operators import alerts, recommend, report, scoring
from ..operators.summary import by_score, user_facts
from ..rules import AdviceRules, ScoringRules
from ..sources.tables import ResultTables, save_clustered

RUN_PROFILE = (
    "user_id", "country", "plan", "mrr_usd", "risk_level", "score", "reasons",
    "days_since_last_activity", "worst_adoption_level", "best_adoption_level", "features",
    "adopted", "total_tickets", "open_tickets", "critical_open_tickets", "open_critical",
    "worst_csat", "analyzed_at",
)


class RunTables(NamedTuple):
    churn_scores: DataFrame
    recommendations: DataFrame
    alert_queue: DataFrame
    alert_digest: DataFrame
    weekly_reports: DataFrame


def run_analysis(
    tables: ResultTables, users: DataFrame, usage: DataFrame, tickets: DataFrame,
    as_of: dt.date, rules: ScoringRules = ScoringRules(), advice: AdviceRules = AdviceRules(),
    run_id: str = "weekly", closed: bool = False, scores: DataFrame | None = None,
    recommendations: DataFrame | None = None,
) -> RunTables:
    """Runs every step for one date and stores the result tables.

    The base tables are read and shuffled once: the scored profiles are written
    first, and all later steps read that table. All tables of the run are published
    together; a repeated run of the same date replaces its rows. ``closed`` is for tables that passed the quality jobs.

    ``scores`` and ``recommendations`` may come from parsed replies instead of
    the rules; then only users with a given score are analysed.
    """
    with tables.publishing():
        return _run(
            tables, users, usage, tickets, as_of, rules, advice, run_id, closed, scores,
            recommendations,
        )


def _run(
    tables: ResultTables, users: DataFrame, usage: DataFrame, tickets: DataFrame,
    as_of: dt.date, rules: ScoringRules, advice: AdviceRules, run_id: str, closed: bool,
    scores: DataFrame | None, recommendations: DataFrame | None,
) -> RunTables:
    run_ts = dt.datetime.combine(as_of, dt.time())
    facts = user_facts(users, usage, tickets, as_of, advice, closed)
    if scores is None:
        scored = scoring.score_users(facts, rules, run_ts)
    else:
        given = scores.select("user_id", "score", "risk_level", "reasons")
        scored = facts.join(given, "user_id").withColumn("analyzed_at", run_timestamp(run_ts))
    profiles = tables.write_run("risk_profiles", scored.select(*RUN_PROFILE), as_of)
    scores = tables.write_run("churn_scores", scoring.churn_scores(profiles), as_of)
    # For readers: profiles sorted for lookups by user, risky users from the highest score down.
    save_clustered(profiles, tables.stage("profile_lookup", as_of), ["user_id"])
    tables.write_run("risk_list", by_score(scores.where(is_at_risk(F.col("risk_level")))), as_of)

    if recommendations is None:
        fit = tables.write_run("feature_fit", recommend.feature_fit(profiles, advice), as_of)
        results = recommend.advise(profiles, advice, run_ts, fit)
        recs = tables.write_run("recommendations", recommend.recommendations(results), as_of)
        cube_input = recommend.with_urgency(profiles, advice)
        top = report.top_risk_clients(
            recommend.advise(report.top_scores(profiles), advice, run_ts, fit)
        )
    else:
        given = recommendations.withColumn("created_at", run_timestamp(run_ts))
        recs = tables.write_run(
            "recommendations", given.select(*recommend.RECOMMENDATION_COLUMNS), as_of
        )
        results = cube_input = alerts.join_results(scores, recs, profiles)
        top = report.top_risk_from_tables(scores, profiles, recs)

    queue = tables.write_run("alert_queue", alerts.alert_queue(results), as_of)
    digest = tables.write_run("alert_digest", alerts.alert_digest(queue, as_of), as_of)

    doc = report.report_struct(cube_input, tickets, top)
    weekly = report.weekly_report(doc, as_of, run_id, run_ts)
    reports = tables.write_run("weekly_reports", weekly, as_of, report=run_id)
    return RunTables(scores, recs, queue, digest, reports)


def run_contents(run: RunTables) -> DataFrame:
    """The stored rows of one run as ``table_name, row_key, content``."""
    def rows(table: str, key: str, *fields: str) -> DataFrame:
        content = F.concat_ws("|", *[F.col(f).cast("string") for f in fields])
        return getattr(run, table).select(
            F.lit(table).alias("table_name"), F.col(key).cast("string").alias("row_key"),
            content.alias("content"),
        )

    return (
        rows("churn_scores", "user_id", "score", "risk_level", "reasons")
        .unionByName(rows("recommendations", "user_id", "risk_level", "urgency",
                          "recommendation", "reasoning"))
        .unionByName(rows("alert_queue", "user_id", "score", "urgency", "plan", "recommendation"))
        .unionByName(rows("alert_digest", "date_text", "total", "headline"))
        .unionByName(rows("weekly_reports", "report_date", "title", "executive_summary",
                          "action_items"))
    )

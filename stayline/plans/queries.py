"""Named queries over the test tables, one per operator."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import is_open, is_urgent_open
from ..operators import (
    agreement, alerts, dashboard, drift, handoff, history, ingest, quality, recommend, replies,
    report, resolution, scoring, summary,
)
from ..schemas import SUPPORT_TICKETS, USERS
from ..session import shared_dir, written
from ..sources import csv_files, testdata
from ..sources.tables import LOOKUPS, ResultTables, save_lookup, upsert
from ..sources.testdata import AS_OF, Inputs
from ..streaming.live import LiveScores
from ..streaming.refresh import SCHEMAS, ScoreRefresh, change_stream
from . import analysis

RUN_TS = dt.datetime.combine(AS_OF, dt.time())
EARLIER = AS_OF - dt.timedelta(days=30)
RUN_DAYS = (AS_OF - dt.timedelta(days=60), EARLIER, AS_OF)
STREAM_FROM = dt.date(1998, 1, 1)
LIVE_DAYS = (dt.date(2001, 7, 1), dt.date(2001, 8, 15), dt.date(2001, 10, 1))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str, fn: Query) -> None:
    """Amounts leave the named queries as DOUBLE, the one type all engines print alike."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        return df.withColumns({
            f.name: F.col(f.name).cast("double")
            for f in df.schema if isinstance(f.dataType, T.DecimalType)
        })

    QUERIES[name] = run


def query(fn: Query) -> Query:
    register(fn.__name__, fn)
    return fn


def _facts(inputs: Inputs, as_of: dt.date = AS_OF) -> DataFrame:
    """The open form, which takes any feature and category: what a user gets by default."""
    return summary.user_facts(*inputs, as_of)


def _scored(inputs: Inputs, as_of: dt.date = AS_OF) -> DataFrame:
    return scoring.score_users(_facts(inputs, as_of), run_ts=RUN_TS)


def _stored_profiles(spark: SparkSession, inputs: Inputs, as_of: dt.date = AS_OF) -> DataFrame:
    """Scored users, written once: the steps behind read them several times."""
    return written(_scored(inputs, as_of), "profiles")


def _advised(spark: SparkSession, inputs: Inputs, as_of: dt.date = AS_OF) -> DataFrame:
    return recommend.advise(_stored_profiles(spark, inputs, as_of), run_ts=RUN_TS)


def _urgency(inputs: Inputs) -> DataFrame:
    """Results with urgency only: the cube needs no advice text."""
    return recommend.with_urgency(_scored(inputs))


def _cube(inputs: Inputs) -> DataFrame:
    return report.report_cube(_urgency(inputs))


# Sources and ingest ---------------------------------------------------------------


def _as_csv(spark: SparkSession, df: DataFrame) -> str:
    """The table as CSV files with a header, on shared storage."""
    path = shared_dir(spark, "csv")
    df.write.option("header", True).csv(path)
    return path


@query
def load_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _as_csv(spark, testdata.load(spark, sf_dir).users)
    return csv_files.load_users(spark, path).accepted


@query
def load_feature_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _as_csv(spark, testdata.load(spark, sf_dir).feature_usage)
    return csv_files.load_feature_usage(spark, path).accepted.drop("id")  # any unique number


@query
def load_support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _as_csv(spark, testdata.load(spark, sf_dir).support_tickets)
    return csv_files.load_support_tickets(spark, path).accepted


@query
def clean_ticket_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = testdata.raw_tickets(testdata.load(spark, sf_dir))
    return ingest.clean_blanks(raw, SUPPORT_TICKETS)


@query
def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = testdata.raw_tickets(testdata.load(spark, sf_dir))
    return ingest.split_rejects(raw, "support_tickets").rejects


@query
def ingest_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = testdata.raw_tickets(testdata.load(spark, sf_dir))
    accepted, rejects = ingest.split_rejects(raw, "support_tickets")
    return ingest.profile(accepted, rejects, exact=accepted.columns)


@query
def load_all_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of all three files with every kind of fault: rejects and rows loaded."""
    inputs = testdata.load(spark, sf_dir)
    tickets = testdata.faulty(inputs).support_tickets.selectExpr(*testdata.columns(testdata.RAW_TICKETS))
    loaded = csv_files.load_all(
        spark, _as_csv(spark, inputs.users.unionAll(inputs.users.where("plan = 'Plus'"))),
        _as_csv(spark, inputs.feature_usage), _as_csv(spark, tickets),
    )
    counts = [
        df.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("table_name"), F.lit("").alias("row_key"),
            F.lit("*").alias("column_name"), F.concat(F.lit("loaded "), F.col("n")).alias("reason"),
        ) for name, df in loaded._asdict().items() if name != "rejects"
    ]
    out = loaded.rejects.drop("raw_value")
    for part in counts:
        out = out.unionByName(part)
    return out


@query
def load_twice_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of the older tickets, then one of all: what the second load refuses, and rows."""
    inputs = testdata.load(spark, sf_dir)
    index = csv_files.KeyIndex(spark, shared_dir(spark, "keys"))
    early = inputs.support_tickets.where(F.col("created_date") < F.lit(STREAM_FROM))
    usage = _as_csv(spark, inputs.feature_usage)
    paying = inputs.users.where("plan <> 'Free'")
    first = index.load("first", _as_csv(spark, inputs.users), usage, _as_csv(spark, early))
    second = index.load("second", _as_csv(spark, paying), usage, _as_csv(spark, inputs.support_tickets))
    out = second.rejects.drop("raw_value")
    for load, loaded in (("first", first), ("second", second)):
        for name, df in loaded._asdict().items():
            if name != "rejects":
                out = out.unionByName(df.agg(F.count("*").alias("n")).select(
                    F.lit(name).alias("table_name"), F.lit(load).alias("row_key"),
                    F.lit("*").alias("column_name"), F.concat(F.lit("loaded "), F.col("n")).alias("reason"),
                ))
    return out


# Integrity rules -------------------------------------------------------------------


def _checked_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    inputs = testdata.load(spark, sf_dir)
    advised = _advised(spark, inputs)
    return {
        **testdata.faulty(inputs)._asdict(),
        "churn_scores": scoring.churn_scores(advised),
        "recommendations": recommend.recommendations(advised),
        "weekly_reports": report.weekly_report(_report(spark, inputs), AS_OF, "weekly", RUN_TS),
    }


@query
def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(_checked_tables(spark, sf_dir))


@query
def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.orphans(_checked_tables(spark, sf_dir))


@query
def dq_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(_checked_tables(spark, sf_dir))


@query
def dq_domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.domain_violations(_checked_tables(spark, sf_dir))


@query
def dq_range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.range_violations(testdata.faulty(testdata.load(spark, sf_dir))._asdict())


@query
def dq_id_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.id_format(testdata.faulty(testdata.load(spark, sf_dir))._asdict())


@query
def dq_free_plan_mrr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.free_plan_mrr(testdata.faulty(testdata.load(spark, sf_dir)).users)


@query
def dq_ticket_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ticket_lifecycle(
        testdata.faulty(testdata.load(spark, sf_dir)).support_tickets
    )


# Projections, predicates, joins, per-user aggregates -------------------------------


@query
def user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.user_profile(testdata.load(spark, sf_dir).users)


@query
def adoption_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    usage = testdata.faulty(testdata.load(spark, sf_dir)).feature_usage
    return summary.usage_with_ordinal(usage).select(
        "user_id", "feature", "adoption_level", "adoption_rank"
    )


@query
def open_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.load(spark, sf_dir).support_tickets.where(is_open(F.col("status")))


@query
def urgent_open_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.load(spark, sf_dir).support_tickets.where(
        is_urgent_open(F.col("status"), F.col("priority"))
    )


@query
def users_features_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = testdata.load(spark, sf_dir)
    return summary.left_join_on_user(inputs.users, inputs.feature_usage)


@query
def users_tickets_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = testdata.load(spark, sf_dir)
    return summary.left_join_on_user(inputs.users, inputs.support_tickets)


@query
def user_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.user_summary(*testdata.load(spark, sf_dir), AS_OF)


@query
def user_inactivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    usage = summary.usage_by_user(testdata.load(spark, sf_dir).feature_usage, AS_OF)
    return usage.select("user_id", "last_activity", "days_since_last_activity")


@query
def user_adoption_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    usage = summary.usage_by_user(testdata.load(spark, sf_dir).feature_usage, AS_OF)
    return usage.select("user_id", "worst_adoption_level", "best_adoption_level")


@query
def user_features_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = testdata.faulty(testdata.load(spark, sf_dir))
    usage = summary.usage_by_user(inputs.feature_usage, AS_OF)  # holds unlisted features too
    return usage.select("user_id", summary.joined_or_null(F.col("features")).alias("features_list"))


@query
def user_ticket_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(testdata.load(spark, sf_dir)).select("user_id", "ticket_categories")


@query
def user_ticket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(testdata.load(spark, sf_dir)).select(
        "user_id", "total_tickets", "open_tickets", "critical_open_tickets",
        *summary.SPLIT_COUNTS,
    )


@query
def repeated_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unchecked tickets, many of them twice: each counts once."""
    tickets = testdata.faulty(testdata.load(spark, sf_dir)).support_tickets
    return summary.tickets_by_user(tickets).select(
        "user_id", "total_tickets", "open_tickets", "critical_open_tickets", "open_critical",
        "open_high", "worst_csat", "avg_csat",
    )


@query
def user_csat(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = testdata.load(spark, sf_dir).support_tickets
    return summary.tickets_by_user(tickets).select("user_id", "worst_csat", "avg_csat")


# Scoring ---------------------------------------------------------------------------


def _signal_query(name: str, *signals: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        scored = _scored(testdata.load(spark, sf_dir))
        return scored.select("user_id", *[f"points_{signal}" for signal in signals])

    register(name, run)


_signal_query("score_inactivity", "inactividad")
_signal_query("score_adoption", "adopcion")
_signal_query("score_open_tickets", "tickets_criticos", "tickets_altos", "tickets_otros")
_signal_query("score_csat", "csat")
_signal_query("score_plan", "plan")
_signal_query("score_ticket_volume", "volumen_tickets")


@query
def churn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(testdata.load(spark, sf_dir)).select("user_id", "score", "risk_level")


@query
def churn_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.churn_reasons(_scored(testdata.load(spark, sf_dir)))


@query
def churn_reasons_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(testdata.load(spark, sf_dir)).select(
        "user_id", "score", "risk_level", "reasons"
    )


@query
def churn_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = _stored_profiles(spark, testdata.load(spark, sf_dir))
    detail = summary.churn_detail(
        scoring.churn_scores(profiles), profiles.select(*summary.SUMMARY_COLUMNS)
    )
    return detail.withColumn("analyzed_at", F.col("analyzed_at").cast("string"))


# Recommendations and alerts ----------------------------------------------------------


@query
def recommendation_urgency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _urgency(testdata.load(spark, sf_dir)).where("urgency IS NOT NULL").select(
        "user_id", "risk_level", "urgency"
    )


@query
def recommendation_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.recommendation_actions(_scored(testdata.load(spark, sf_dir)))


@query
def feature_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.feature_gap(_facts(testdata.load(spark, sf_dir)))


@query
def feature_gap_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.feature_gap_ranked(written(_facts(testdata.load(spark, sf_dir)), "facts"))


@query
def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = recommend.recommendations(_advised(spark, testdata.load(spark, sf_dir)))
    return recs.drop("created_at")


@query
def alert_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_queue(_advised(spark, testdata.load(spark, sf_dir)))


@query
def alert_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _urgency(testdata.load(spark, sf_dir)).where(F.col("urgency") == "inmediata")
    return alerts.alert_digest(results, AS_OF)


@query
def alerts_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alerts_table(_advised(spark, testdata.load(spark, sf_dir)))


@query
def alerts_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = alerts.alerts_table(_advised(spark, testdata.load(spark, sf_dir)))
    return alerts.alerts_filtered(
        table, risk_level="alto", urgency="esta_semana", country="México", plan="Free"
    )


@query
def alerts_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alerts_search(alerts.alerts_table(_advised(spark, testdata.load(spark, sf_dir))), "104")


# Report and dashboard ----------------------------------------------------------------


@query
def risk_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.risk_distribution(_cube(testdata.load(spark, sf_dir)))


@query
def urgency_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.urgency_distribution(_cube(testdata.load(spark, sf_dir)))


@query
def risk_by_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.risk_by_plan(_cube(testdata.load(spark, sf_dir)))


@query
def risk_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.risk_by_country(_cube(testdata.load(spark, sf_dir)))


@query
def avg_score_by_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.avg_score_by_plan(_cube(testdata.load(spark, sf_dir)))


@query
def mrr_at_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.mrr_at_risk(_cube(testdata.load(spark, sf_dir)))


@query
def report_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_rollup(_cube(testdata.load(spark, sf_dir)))


@query
def open_tickets_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.open_tickets_summary(testdata.load(spark, sf_dir).support_tickets)


@query
def top_risk_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(_stored_profiles(spark, testdata.load(spark, sf_dir)))


def _top(profiles: DataFrame) -> DataFrame:
    fit = recommend.feature_fit(profiles)
    return report.top_risk_clients(
        recommend.advise(report.top_scores(profiles), run_ts=RUN_TS, fit=fit)
    )


def _report(spark: SparkSession, inputs: Inputs, as_of: dt.date = AS_OF) -> DataFrame:
    profiles = _stored_profiles(spark, inputs, as_of)
    return report.report_struct(
        recommend.with_urgency(profiles), inputs.support_tickets, _top(profiles)
    )


@query
def report_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON document, read back into plain text columns for comparison."""
    doc = report.report_metrics(_report(spark, testdata.load(spark, sf_dir))).select(
        F.from_json(
            "metrics",
            "total_users bigint, risk_distribution map<string,bigint>, "
            "urgency_distribution map<string,bigint>, "
            "risk_by_plan array<struct<plan:string,risk_level:string,cnt:bigint>>, "
            "risk_by_country array<struct<country:string,risk_level:string,cnt:bigint>>, "
            "avg_score_by_plan array<struct<plan:string,avg_score:string,total:bigint>>, "
            "top_10_risk_clients array<struct<user_id:string,score:bigint,urgency:string>>, "
            "total_mrr_at_risk decimal(20,2), "
            "open_tickets_summary struct<total_open:bigint,critical_open:bigint,"
            "high_open:bigint>",
        ).alias("d")
    )

    def text(column: str, *fields: str):
        line = lambda x: F.concat_ws(":", *[x[f].cast("string") for f in fields])
        return F.array_join(F.transform(column, line), ",").alias(column.split(".")[-1])

    def pairs(column: str):
        return F.array_join(
            F.transform(
                F.map_entries(column),
                lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")),
            ), ","
        ).alias(column.split(".")[-1])

    return doc.select(
        "d.total_users", pairs("d.risk_distribution"), pairs("d.urgency_distribution"),
        text("d.risk_by_plan", "plan", "risk_level", "cnt"),
        text("d.risk_by_country", "country", "risk_level", "cnt"),
        text("d.avg_score_by_plan", "plan", "avg_score", "total"),
        text("d.top_10_risk_clients", "user_id", "score", "urgency"),
        "d.total_mrr_at_risk", "d.open_tickets_summary.*",
    )


@query
def report_key_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_key_metrics(_report(spark, testdata.load(spark, sf_dir)))


@query
def dashboard_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.dashboard_kpis(_report(spark, testdata.load(spark, sf_dir)))


def _flat_report(reports: DataFrame) -> DataFrame:
    return reports.select(
        "report_date", "run_id", "title", "executive_summary", "key_metrics.*",
        F.array_join("top_risk_clients.user_id", ",").alias("top_users"), "action_items",
        "generated_by",
    )


@query
def weekly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = report.weekly_report(_report(spark, testdata.load(spark, sf_dir)), AS_OF, "weekly", RUN_TS)
    return _flat_report(row)


@query
def report_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of two run dates, two of them on one date, stored and read back, latest first."""
    inputs = testdata.load(spark, sf_dir)
    tables = ResultTables(spark, shared_dir(spark, "reports"))
    for day, names in ((EARLIER, ("weekly",)), (AS_OF, ("weekly", "extra", "extra"))):
        doc = _report(spark, inputs, day)
        for name in names:
            tables.write_run(
                "weekly_reports", report.weekly_report(doc, day, name, RUN_TS), day, report=name
            )
    return _flat_report(report.report_history(tables.read("weekly_reports")))


@query
def risk_factor_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.risk_factor_counts(_scored(testdata.load(spark, sf_dir)))


@query
def user_detail_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.user_detail_features(testdata.load(spark, sf_dir).feature_usage, AS_OF)


@query
def user_detail_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = testdata.load(spark, sf_dir)
    return dashboard.user_detail_tickets(inputs.users, inputs.support_tickets)


@query
def user_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested document with its lists as text; pages of four tickets."""
    inputs = testdata.load(spark, sf_dir)
    profiles = _stored_profiles(spark, inputs)
    pages = dashboard.user_360(
        profiles, inputs.feature_usage, inputs.support_tickets, AS_OF, page_size=4
    )
    feature = lambda f: F.concat_ws(
        ":", f.feature, f.adoption_level, f.days_since_use.cast("string"))
    ticket = lambda t: F.concat_ws(
        ":", t.ticket_id, t.category, t.priority, t.status, t.created_date.cast("string"),
        t.csat_score.cast("string"))
    return pages.withColumns({
        "features": F.array_join(F.transform("features", feature), ","),
        "tickets": F.array_join(F.transform("tickets", ticket), ","),
    })


# Hand-off, replies, result tables ----------------------------------------------------


@query
def agent_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = _stored_profiles(spark, testdata.load(spark, sf_dir))
    return handoff.agent_batches(profiles.select("user_id", "score", "risk_level"))


@query
def agent_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _stored_profiles(spark, testdata.load(spark, sf_dir))
    fields = [
        "user_id", "country", "plan", "days_since_last_activity", "worst_adoption_level",
        "features_list", "total_tickets", "open_tickets", "critical_open_tickets",
        "worst_csat", "ticket_categories",
    ]
    return handoff.agent_payloads(handoff.agent_batches(facts.select(*fields)), fields)


def _wrapped(text: Column, style: Column) -> Column:
    """Reply text in one of the five envelope forms, chosen by ``style``."""
    fenced = F.concat(F.lit("```json\n"), text, F.lit("\n```"))
    style = F.pmod(style, F.lit(5))
    return (
        F.when(style == 0, text)
        .when(style == 1, F.concat(F.lit("\n  "), fenced, F.lit("  \n")))
        .when(style == 2, F.to_json(F.struct(F.struct(fenced.alias("content")).alias("message"))))
        .when(style == 3, F.to_json(F.struct(text.alias("text"))))
        .otherwise(F.to_json(F.struct(F.array(F.struct(
            F.array(F.struct(fenced.alias("text"))).alias("content"))).alias("output"))))
    )


def _with_damage(whole: DataFrame) -> DataFrame:
    """Every whole reply, once more as delivered twice, and a copy whose end is lost."""
    cut = whole.select(
        F.concat("reply_id", F.lit("-cut")).alias("reply_id"),
        F.substring("text", F.lit(1), F.length("text") - 1).alias("raw"),
    )
    raw = whole.select("reply_id", "raw")
    return raw.unionByName(raw).unionByName(cut)


def scoring_replies(scored: DataFrame) -> DataFrame:
    """Canonical replies: one array per batch of users, and damaged copies."""
    batches = handoff.agent_batches(
        scored.select("user_id", F.col("score").cast("string").alias("score"), "risk_level",
                      "reasons")
    )
    # Some scores do not fit their level, and some elements lack a field.
    level = F.when(F.col("score") == "35", "alto").otherwise(F.col("risk_level"))
    reasons = F.when(F.col("score") != "50", F.col("reasons"))
    entry = F.struct("user_id", "score", level.alias("risk_level"), reasons.alias("reasons"))
    return _with_damage(
        batches.groupBy("bucket", "batch_no")
        .agg(F.to_json(F.sort_array(F.collect_list(entry))).alias("text"))
        .select(
            F.concat_ws("-", F.lpad(F.col("bucket").cast("string"), 4, "0"),
                        F.lpad(F.col("batch_no").cast("string"), 6, "0")).alias("reply_id"),
            "text", _wrapped(F.col("text"), F.col("bucket") + F.col("batch_no")).alias("raw"),
        )
    )


def recommendation_replies(advised: DataFrame) -> DataFrame:
    """One object per risky user, unknown and repeated ones among them, and damaged copies."""
    recs = recommend.recommendations(advised)
    style = F.col("style")
    one = F.to_json(F.struct(
        F.when((style == 1) & (F.col("risk_level") == "alto"), F.concat(F.lit("X"), "user_id"))
        .otherwise(F.col("user_id")).alias("user_id"),
        "risk_level", "urgency", "recommendation", "reasoning",
    ))
    copies = F.when(style == 2, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return _with_damage(
        recs.withColumn("style", F.substring("user_id", -1, 1).cast("int"))
        .withColumn("copy", F.explode(copies))
        .select(
            F.concat_ws("-", "user_id", F.col("copy").cast("string")).alias("reply_id"),
            one.alias("text"), _wrapped(one, style).alias("raw"),
        )
    )


def _stored(spark: SparkSession, canned: DataFrame) -> DataFrame:
    """Replies as they arrive: JSON lines files on shared storage."""
    path = shared_dir(spark, "replies")
    canned.write.json(path)
    return replies.read_replies(spark, path)


def _parsed_scores(spark: SparkSession, inputs: Inputs, profiles: DataFrame) -> ingest.Split:
    canned = _stored(spark, scoring_replies(profiles))
    return replies.parse_scoring_replies(canned, inputs.users)


def _parsed_advice(spark: SparkSession, inputs: Inputs, profiles: DataFrame) -> ingest.Split:
    canned = _stored(spark, recommendation_replies(recommend.advise(profiles, run_ts=RUN_TS)))
    return replies.parse_recommendation_replies(canned, inputs.users)


@query
def parse_scoring_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = testdata.load(spark, sf_dir)
    return _parsed_scores(spark, inputs, _stored_profiles(spark, inputs)).accepted


@query
def parse_recommendation_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = testdata.load(spark, sf_dir)
    return _parsed_advice(spark, inputs, _stored_profiles(spark, inputs)).accepted


@query
def reply_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = testdata.load(spark, sf_dir)
    profiles = _stored_profiles(spark, inputs)
    scores, advice = _parsed_scores(spark, inputs, profiles), _parsed_advice(spark, inputs, profiles)
    return scores.rejects.unionByName(advice.rejects)


@query
def parse_report_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly report as a fenced reply, parsed back."""
    row = report.weekly_report(_report(spark, testdata.load(spark, sf_dir)), AS_OF, "weekly", RUN_TS)
    text = F.to_json(F.struct(
        "title", "executive_summary",
        F.struct("key_metrics.total_analyzed", "key_metrics.high_risk").alias("key_metrics"),
        F.transform("top_risk_clients", lambda c: F.struct(c.user_id, c.score))
        .alias("top_risk_clients"),
        "action_items",
    ))
    raw = row.select(F.lit("1").alias("reply_id"), _wrapped(text, F.lit(2)).alias("raw"))
    return replies.parse_report_reply(_stored(spark, raw))


@query
def insert_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of two run dates stored side by side, one of them run twice."""
    inputs = testdata.load(spark, sf_dir)
    tables = ResultTables(spark, shared_dir(spark, "results"))
    for day in (EARLIER, AS_OF, AS_OF):
        tables.write_run("churn_scores", scoring.churn_scores(_scored(inputs, day)), day)
    return tables.read("churn_scores").select("run_date", "user_id", "score", "risk_level")


@query
def upsert_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-old scores, replaced for the users now at risk; the changes hold old versions too."""
    inputs = testdata.load(spark, sf_dir)
    old = scoring.churn_scores(_scored(inputs, EARLIER))
    new = scoring.churn_scores(_scored(inputs)).where("risk_level <> 'bajo'")
    changes = new.withColumn("version", F.lit(2)).unionByName(old.withColumn("version", F.lit(1)))
    return upsert(old, changes, version="version").select("user_id", "score", "risk_level")


@query
def run_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = ResultTables(spark, shared_dir(spark, "analysis"))
    run = analysis.run_analysis(tables, *testdata.load(spark, sf_dir), AS_OF)
    return analysis.run_contents(run)


@query
def risk_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The risky users as the run stores them for readers, highest score first."""
    tables = ResultTables(spark, shared_dir(spark, "analysis"))
    analysis.run_analysis(tables, *testdata.load(spark, sf_dir), AS_OF)
    return tables.read("risk_list").select("user_id", "score", "risk_level")


@query
def run_from_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chained run on scores and advice that were parsed from replies."""
    # Stored: the replies, the checks of their users and the run each read the tables.
    inputs = Inputs(*(
        written(df, f"replies-{name}") for name, df in testdata.load(spark, sf_dir)._asdict().items()
    ))
    profiles = _stored_profiles(spark, inputs)
    scores = _parsed_scores(spark, inputs, profiles).accepted
    advice = _parsed_advice(spark, inputs, profiles).accepted
    run = analysis.run_analysis(
        ResultTables(spark, shared_dir(spark, "analysis")), *inputs, AS_OF,
        scores=scores, recommendations=advice,
    )
    return analysis.run_contents(run)


@query
def top_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The riskiest clients by joining the stored scores and recommendations."""
    inputs = testdata.load(spark, sf_dir)
    tables = ResultTables(spark, shared_dir(spark, "analysis"))
    run = analysis.run_analysis(tables, *inputs, AS_OF)
    return report.top_risk_from_tables(run.churn_scores, inputs.users, run.recommendations)


@query
def stream_score_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old tickets as they were when opened, then all tickets arrive as a stream, and users
    whose plan has changed since."""
    inputs = testdata.load(spark, sf_dir)
    root = shared_dir(spark, "stream")
    schema = SUPPORT_TICKETS
    early = F.col("created_date") < F.lit(STREAM_FROM)
    # At most four deliveries each of old and new tickets: larger tables make larger batches, not more.
    inputs.support_tickets.withColumn(
        "arrival", F.when(early, "early").otherwise("late")
    ).coalesce(4).write.partitionBy("arrival").parquet(f"{root}/incoming")
    stored = spark.read.schema(schema).parquet(f"{root}/incoming/arrival=early")
    as_opened = stored.withColumns({
        "status": F.lit("Open"),
        "resolved_date": F.lit(None).cast("date"),
        "resolution_hours": F.lit(None).cast("int"),
        "csat_score": F.lit(None).cast("int"),
    })
    refresh = ScoreRefresh(spark, f"{root}/state", AS_OF, buckets=8)
    moved = inputs.users.withColumn("plan", F.when(F.col("plan") == "Plus", "Free").otherwise(F.col("plan")))
    refresh.seed(moved, inputs.feature_usage, as_opened)
    inputs.users.write.parquet(f"{root}/users")
    incoming = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 4)
        .option("recursiveFileLookup", True).parquet(f"{root}/incoming")
    )
    people = spark.readStream.schema(USERS).parquet(f"{root}/users")
    changes = change_stream(tickets=incoming, users=people)
    refresh.start(changes, f"{root}/checkpoint").awaitTermination()
    return refresh.current_scores().select("user_id", "score", "risk_level")


def _as_opened(tickets: DataFrame) -> DataFrame:
    return tickets.withColumns({
        "status": F.lit("Open"),
        "resolved_date": F.lit(None).cast("date"),
        "resolution_hours": F.lit(None).cast("int"),
        "csat_score": F.lit(None).cast("int"),
    })


def _live(spark: SparkSession, sf_dir: str) -> LiveScores:
    """Scores of an earlier date, of tickets as they were opened, old plans and first use only;
    then changes and dates arrive as a stream: late tickets, reopened and closed again, plans,
    the last use of every feature, and the days in between."""
    inputs = testdata.load(spark, sf_dir)
    root = shared_dir(spark, "live")
    users, usage, tickets = (
        written(df, f"live-{name}") for name, df in inputs._asdict().items()
    )
    late = F.col("created_date") >= F.lit(STREAM_FROM)
    live = LiveScores(spark, f"{root}/state", buckets=8)
    live.seed(
        users.withColumn("plan", F.when(F.col("plan") == "Plus", "Free").otherwise(F.col("plan"))),
        usage.withColumn("last_used_date", F.least("last_used_date", F.lit(LIVE_DAYS[0])))
        .withColumn("adoption_level", F.lit("activated")),
        _as_opened(tickets.where(~late)), LIVE_DAYS[0],
    )
    numbered = lambda df, n: df.withColumn("version", F.lit(n).cast("bigint"))
    steps = (
        change_stream(
            tickets=numbered(tickets, 2).unionByName(numbered(_as_opened(tickets), 1)),
            clock=spark.createDataFrame([(LIVE_DAYS[1],)], "as_of date"),
        ),
        change_stream(
            usage=usage, users=users, clock=spark.createDataFrame([(LIVE_DAYS[2],)], "as_of date")
        ),
        change_stream(
            tickets=_as_opened(tickets.where(late)), clock=spark.createDataFrame([(AS_OF,)], "as_of date")
        ),
        change_stream(tickets=tickets.where(late)),
    )
    columns = "kind string, version bigint"
    for kind, schema in SCHEMAS.items():
        columns += f", {kind} {schema.simpleString()}"
    columns += ", clock struct<as_of: date>"
    for number, step in enumerate(steps):  # each step, of any number of files, is one batch
        step.write.parquet(f"{root}/incoming/step={number}")
        incoming = (
            spark.readStream.schema(columns).option("recursiveFileLookup", True).parquet(f"{root}/incoming")
        )
        live.start(incoming, f"{root}/checkpoint").awaitTermination()
    return live


@query
def live_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores, and the figures behind them, from facts that were added and taken back."""
    live = _live(spark, sf_dir)
    figures = live.current_facts().select(*summary.SUMMARY_COLUMNS, *summary.SPLIT_COUNTS)
    return live.current_scores().join(figures, "user_id")


# History, agreement, resolution times, drift -------------------------------------------


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of three run dates, published one after the other and read back."""
    inputs = Inputs(*(
        written(df, f"runs-{name}") for name, df in testdata.load(spark, sf_dir)._asdict().items()
    ))
    tables = ResultTables(spark, shared_dir(spark, "runs"))
    for day in RUN_DAYS:
        tables.write_run("churn_scores", scoring.churn_scores(_scored(inputs, day)), day)
    return tables.read("churn_scores")


@query
def risk_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.risk_history(_runs(spark, sf_dir))


@query
def risk_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.risk_transitions(_runs(spark, sf_dir))


@query
def time_in_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.time_in_band(history.risk_history(_runs(spark, sf_dir)), AS_OF)


def _both_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(testdata.load(spark, sf_dir))
    return written(
        scored.select("score", "risk_level", F.col("original_churn_score").alias("supplied")), "scores"
    )


@query
def score_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agreement.score_agreement(_both_scores(spark, sf_dir))


@query
def agreement_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agreement.agreement_deciles(_both_scores(spark, sf_dir))


@query
def resolution_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.resolution_hours(testdata.load(spark, sf_dir).support_tickets)


@query
def resolution_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches stored by the year of opening, merged, and held against the exact ranks."""
    tickets = written(testdata.load(spark, sf_dir).support_tickets, "tickets")
    tables = ResultTables(spark, shared_dir(spark, "hours"))
    years = sorted(r.y for r in tickets.select(F.year("created_date").alias("y")).distinct().collect())
    with tables.publishing():
        for year in years:
            day = dt.date(year, 12, 31)
            part = tickets.where(F.year("created_date") == year)
            tables.write_run("hours_sketches", resolution.hours_sketches(part, day), day)
    merged = resolution.hours_from_sketches(tables.read("hours_sketches"))
    errors = resolution.sketch_errors(tickets, written(merged, "estimates"))
    return errors.select("grouped_by", *resolution.DIMENSIONS, "tickets", *(
        (F.col(f"{name}_error") <= resolution.RANK_ERROR).alias(f"{name}_close")
        for name in ("p50", "p90", "p95")
    ))


@query
def features_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = testdata.load(spark, sf_dir)
    faulty = testdata.faulty(inputs)
    return quality.features_count_check(faulty.users, inputs.feature_usage)


def _load_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of the tickets of each year as a load of its own, stored and read back."""
    tickets = written(testdata.load(spark, sf_dir).support_tickets, "tickets")
    years = sorted(r.y for r in tickets.select(F.year("created_date").alias("y")).distinct().collect())
    return written(drift.all_loads([
        drift.load_profile(tickets.where(F.year("created_date") == year), str(year)) for year in years
    ]), "load-profiles")


@query
def profile_of_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged from the stored profiles; distinct values and medians as close or not to the truth."""
    merged = drift.merged_profile(_load_profiles(spark, sf_dir))
    tickets = testdata.load(spark, sf_dir).support_tickets
    true = ingest.profile(tickets, exact=tickets.columns).select(
        "column_name", F.col("distinct_values").alias("true_values")
    )
    close = F.abs(F.col("distinct_values") - F.col("true_values")) <= 0.05 * F.col("true_values")
    return merged.join(true, "column_name").select(
        "column_name", "loads", "rows", "nulls", "min_value", "max_value", "min_number", "max_number",
        close.alias("distinct_close"),
    )


@query
def profile_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.profile_drift(_load_profiles(spark, sf_dir)).select(
        "load", "column_name", "rows", "null_share", "null_share_before"
    )


@query
def ticket_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets in progress of one year, from the lookup layout of all tickets."""
    path = shared_dir(spark, "lookup")
    tickets = testdata.load(spark, sf_dir).support_tickets
    save_lookup(tickets, path, LOOKUPS["support_tickets"])
    return spark.read.schema(tickets.schema).parquet(path).where(
        (F.col("status") == "In_Progress") & (F.year("created_date") == STREAM_FROM.year)
    )

"""Roll-ups, the one-row metrics document and the weekly report row.

Every distribution comes from one small cube (plan, country, risk level,
urgency): the scored users are read and aggregated once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import (
    is_at_risk, is_open, json_text, null_if_empty, run_timestamp,
)

CUBE_KEYS = ("plan", "country", "risk_level", "urgency")


TITLE = "Reporte Semanal — "  # fixed value: how every report title begins


def report_cube(results: DataFrame) -> DataFrame:
    return results.groupBy(*CUBE_KEYS).agg(
        F.count("*").alias("cnt"),
        F.sum("score").alias("score_sum"),
        F.sum("mrr_usd").cast("decimal(20,2)").alias("mrr_sum"),
    )


def _count(cube: DataFrame, *keys: str) -> DataFrame:
    return cube.groupBy(*keys).agg(F.sum("cnt").alias("cnt"))


def risk_distribution(cube: DataFrame) -> DataFrame:
    return _count(cube, "risk_level")


def urgency_distribution(cube: DataFrame) -> DataFrame:
    return _count(cube.where("urgency IS NOT NULL"), "urgency")


def risk_by_plan(cube: DataFrame) -> DataFrame:
    return _count(cube, "plan", "risk_level")


def risk_by_country(cube: DataFrame) -> DataFrame:
    return _count(cube, "country", "risk_level")


def _avg_score() -> Column:
    return F.round(F.sum("score_sum") / F.sum("cnt"), 1)


def avg_score_by_plan(cube: DataFrame) -> DataFrame:
    return cube.groupBy("plan").agg(_avg_score().alias("avg_score"), F.sum("cnt").alias("total"))


def _mrr_at_risk() -> Column:
    risky = F.when(is_at_risk(F.col("risk_level")), F.col("mrr_sum"))
    return F.coalesce(F.sum(risky), F.lit(0)).cast("decimal(20,2)")


def mrr_at_risk(cube: DataFrame) -> DataFrame:
    return cube.agg(_mrr_at_risk().alias("mrr_at_risk"))


SETS = {
    "total": (),
    "risk": ("risk_level",),
    "urgency": ("urgency",),
    "plan": ("plan",),
    "plan_risk": ("plan", "risk_level"),
    "country_risk": ("country", "risk_level"),
}


def report_rollup(cube: DataFrame) -> DataFrame:
    """All distributions as grouping sets over the cube, tagged by set."""
    grouped = cube.groupingSets(
        [[F.col(k) for k in keys] for keys in SETS.values()], *CUBE_KEYS
    ).agg(
        F.sum("cnt").alias("cnt"),
        _avg_score().alias("avg_score"),
        _mrr_at_risk().alias("mrr_at_risk"),
        *[F.grouping(k).alias(f"g_{k}") for k in CUBE_KEYS],
    )
    tag = F
    for name, keys in SETS.items():
        tag = tag.when(
            F.concat(*[F.col(f"g_{k}").cast("string") for k in CUBE_KEYS])
            == "".join("0" if k in keys else "1" for k in CUBE_KEYS),
            name,
        )
    return grouped.select(tag.alias("grouping"), *CUBE_KEYS, "cnt", "avg_score", "mrr_at_risk")


TOP_FIELDS = (
    "user_id", "score", "risk_level", "reasons", "plan", "country", "mrr_usd", "urgency",
    "recommendation",
)


def top_scores(scored: DataFrame, n: int = 10) -> DataFrame:
    """The n highest scores; ties go by user id. Advice is written for these only."""
    return scored.orderBy(F.desc("score"), "user_id").limit(n)


def top_risk_clients(results: DataFrame, n: int = 10) -> DataFrame:
    return top_scores(results.select(*TOP_FIELDS), n)


def top_risk_from_tables(
    scores: DataFrame, users: DataFrame, recommendations: DataFrame, n: int = 10
) -> DataFrame:
    """The same from stored tables: n scores first, joins after."""
    known = scores.join(users.select("user_id"), "user_id", "left_semi")
    profile = users.select("user_id", "plan", "country", "mrr_usd")
    advice = recommendations.select("user_id", "urgency", "recommendation")
    top = F.broadcast(top_scores(known, n))  # n rows, on either use
    kept = profile.join(top, "user_id")
    written = advice.join(top.select("user_id"), "user_id", "left_semi")
    return top_risk_clients(kept.join(written, "user_id", "left"), n)


def open_tickets_summary(tickets: DataFrame) -> DataFrame:
    opened = is_open(F.col("status"))
    count_if = lambda cond: F.count(F.when(cond, 1))
    return tickets.agg(
        count_if(opened).alias("total_open"),
        count_if(opened & (F.col("priority") == "Critical")).alias("critical_open"),
        count_if(opened & (F.col("priority") == "High")).alias("high_open"),
    )


def _sorted_list(rows: Column, fields: list[Column | str], order: list[Column]) -> Column:
    """Array of structs in the given order; NULL if no row qualifies."""
    keyed = F.struct(F.struct(*order).alias("k"), F.struct(*fields).alias("v"))
    return null_if_empty(F.sort_array(F.collect_list(F.when(rows, keyed))).getField("v"))


def _object(rows: Column, key: str) -> Column:
    pairs = F.sort_array(F.collect_list(F.when(rows, F.struct(key, "cnt"))))
    return null_if_empty(F.map_from_entries(pairs))


def report_struct(results: DataFrame, tickets: DataFrame, top_clients: DataFrame) -> DataFrame:
    """The nine report figures as one row of typed columns.

    ``results`` needs the cube's columns only; ``top_clients`` are the few rows
    of ``top_risk_clients``. The lists hold one entry per group of the cube,
    never one per user.
    """
    def grouping(name: str) -> Column:
        return F.col("grouping") == name

    def first(name: str, column: str) -> Column:
        return F.max(F.when(grouping(name), F.col(column)))

    by_score = (-F.col("avg_score")).alias("o")
    top = top_clients.agg(
        _sorted_list(F.lit(True), list(TOP_FIELDS),
                     [(-F.col("score")).alias("o"), F.col("user_id")]).alias("top")
    )
    open_tickets = open_tickets_summary(tickets).select(
        F.struct("total_open", "critical_open", "high_open").alias("summary")
    )
    return report_rollup(report_cube(results)).agg(
        F.coalesce(first("total", "cnt"), F.lit(0)).alias("total_users"),
        _object(grouping("risk"), "risk_level").alias("risk_distribution"),
        _object(grouping("urgency") & F.col("urgency").isNotNull(), "urgency")
        .alias("urgency_distribution"),
        _sorted_list(grouping("plan_risk"), ["plan", "risk_level", "cnt"],
                     [F.col("plan"), F.col("risk_level")]).alias("risk_by_plan"),
        _sorted_list(grouping("country_risk"), ["country", "risk_level", "cnt"],
                     [F.col("country"), F.col("risk_level")]).alias("risk_by_country"),
        _sorted_list(grouping("plan"), ["plan", "avg_score", F.col("cnt").alias("total")],
                     [by_score, F.col("plan")]).alias("avg_score_by_plan"),
        F.coalesce(first("total", "mrr_at_risk"), F.lit(0)).cast("decimal(20,2)")
        .alias("total_mrr_at_risk"),
    ).select(
        "total_users", "risk_distribution", "urgency_distribution", "risk_by_plan",
        "risk_by_country", "avg_score_by_plan", top.scalar().alias("top_10_risk_clients"),
        "total_mrr_at_risk", open_tickets.scalar().alias("open_tickets_summary"),
    )


def report_metrics(report: DataFrame) -> DataFrame:
    """One row, one JSON column."""
    return report.select(json_text(F.struct(*report.columns)).alias("metrics"))


def _key_metrics() -> list[Column]:
    def counted(objects: str, key: str) -> Column:
        value = F.try_element_at(F.col(objects), F.lit(key))
        return F.coalesce(value, F.lit(0)).cast("bigint")

    return [
        F.col("total_users").alias("total_analyzed"),
        counted("risk_distribution", "alto").alias("high_risk"),
        counted("risk_distribution", "medio").alias("medium_risk"),
        counted("risk_distribution", "bajo").alias("low_risk"),
        counted("urgency_distribution", "inmediata").alias("immediate_action"),
        F.col("total_mrr_at_risk").alias("mrr_at_risk"),
        F.col("open_tickets_summary.critical_open").alias("critical_tickets_open"),
    ]


def report_key_metrics(report: DataFrame) -> DataFrame:
    return report.select(*_key_metrics())


def dashboard_kpis(report: DataFrame) -> DataFrame:
    return report_key_metrics(report).select(
        "total_analyzed", "high_risk", "medium_risk", "immediate_action"
    )


def weekly_report(
    report: DataFrame, report_date: dt.date, run_id: str, run_ts: dt.datetime | None = None
) -> DataFrame:
    """One report row; title, summary and action lines are filled templates."""
    def number(name: str) -> Column:
        return F.col(f"key_metrics.{name}").cast("string")

    clients = F.transform(
        "top_10_risk_clients",
        lambda c: F.struct(
            *[c[name].alias(name) for name in
              ("user_id", "score", "plan", "country", "mrr_usd", "recommendation")]
        ),
    )
    return report.select(F.struct(*_key_metrics()).alias("key_metrics"),
                         clients.alias("top_risk_clients")).select(
        F.lit(report_date).alias("report_date"),
        F.lit(run_id).alias("run_id"),
        F.concat(F.lit(TITLE), number("high_risk"),
                 F.lit(" clientes en riesgo alto")).alias("title"),
        F.concat(number("total_analyzed"), F.lit(" clientes analizados: "),
                 number("high_risk"), F.lit(" alto, "), number("medium_risk"),
                 F.lit(" medio, "), number("low_risk"), F.lit(" bajo. MRR en riesgo: "),
                 number("mrr_at_risk"), F.lit(" USD.")).alias("executive_summary"),
        "key_metrics",
        F.coalesce("top_risk_clients", F.array().cast(
            "array<struct<user_id:string,score:bigint,plan:string,country:string,"
            "mrr_usd:decimal(10,2),recommendation:string>>")).alias("top_risk_clients"),
        F.concat(F.lit("1. Contactar hoy a "), number("immediate_action"),
                 F.lit(" clientes\n2. Resolver "), number("critical_tickets_open"),
                 F.lit(" tickets critical abiertos\n3. Revisar "), number("medium_risk"),
                 F.lit(" clientes en riesgo medio")).alias("action_items"),
        F.lit("rules").alias("generated_by"),
        run_timestamp(run_ts).alias("created_at"),
    )


def report_history(reports: DataFrame) -> DataFrame:
    return reports.orderBy(F.desc("report_date"), F.desc("run_id"))

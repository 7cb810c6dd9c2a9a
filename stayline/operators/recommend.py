"""Urgency, candidate actions, unused features and the recommendation row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import is_at_risk, run_timestamp, with_computed
from ..rules import AdviceRules

RECOMMENDATION_COLUMNS = (
    "user_id", "risk_level", "urgency", "recommendation", "reasoning", "created_at",
)

# Action kinds with their texts, and the opening line per urgency
ACTION_TEXTS = {
    "escalamiento": "escalar {critical} tickets critical a ingeniería",
    "contacto_proactivo": "contacto proactivo por llamada, email o WhatsApp",
    "onboarding": "sesión de onboarding para {learn}",
    "oferta_upgrade": "oferta de upgrade con {offer}",
    "account_manager": "asignar account manager dedicado",
    "capacitacion_grupal": "invitar a webinar o capacitación grupal",
    "descuento_trial": "descuento o extensión de trial",
}
FOLLOW_UP = "dar seguimiento a {open} tickets abiertos"
SHOW_OFFER = "mostrar {offer}"
OPENINGS = {
    "inmediata": "Actuar hoy",
    "esta_semana": "Actuar en los próximos 5 días",
    "monitoreo": "Revisar en el próximo ciclo semanal",
}


def urgency(rules: AdviceRules = AdviceRules()) -> Column:
    level, worst = F.col("risk_level"), F.col("worst_csat")
    urgent = F.col("critical_open_tickets") > 0
    very_low = F.coalesce(worst <= rules.very_low_csat, F.lit(False))
    return (
        F.when((level == "alto") & (urgent | very_low), "inmediata")
        .when((level == "medio") & ~urgent & ~very_low, "monitoreo")
        .otherwise("esta_semana")
    )


def with_urgency(scored: DataFrame, rules: AdviceRules = AdviceRules()) -> DataFrame:
    """Adds ``urgency``; NULL for low-risk users."""
    risky = is_at_risk(F.col("risk_level"))
    return with_computed(scored, {"urgency": F.when(risky, urgency(rules))})


def action_conditions(rules: AdviceRules = AdviceRules()) -> dict[str, Column]:
    level, plan = F.col("risk_level"), F.col("plan")
    high, medium = level == "alto", level == "medio"
    low_adoption = F.col("worst_adoption_level") <= rules.low_adoption
    return {
        "escalamiento": F.col("open_critical") > 0,
        "contacto_proactivo": high,
        "onboarding": low_adoption,
        "oferta_upgrade": plan.isin(*rules.upgrade_plans)
        & (F.col("best_adoption_level") >= rules.upgrade_adoption)
        & (F.col("days_since_last_activity") <= rules.upgrade_max_idle),
        "account_manager": high & plan.isin(*rules.managed_plans),
        "capacitacion_grupal": medium & low_adoption,
        "descuento_trial": plan.isin(*rules.trial_plans),
    }


def _catalogue(rules: AdviceRules) -> Column:
    return F.array(*[F.lit(name) for name in rules.catalogue])


def feature_gap(facts: DataFrame, rules: AdviceRules = AdviceRules()) -> DataFrame:
    """Catalogue features a user has not touched, one row each."""
    return facts.select(
        "user_id", F.explode(F.array_except(_catalogue(rules), F.col("features"))).alias("feature")
    )


def feature_fit(facts: DataFrame, rules: AdviceRules = AdviceRules()) -> DataFrame:
    """Per plan, the features worth offering: enough of the plan's users adopted them.

    One row per plan present, with at most one entry per catalogue feature.
    """
    adopters = [
        F.count(F.when(F.array_contains("adopted", name), 1)).alias(f"f{i}")
        for i, name in enumerate(rules.catalogue)
    ]
    per_plan = facts.groupBy("plan").agg(F.count("*").alias("plan_users"), *adopters)
    rated = F.array(*[
        F.struct(
            (-F.col(f"f{i}") / F.col("plan_users")).alias("order_key"),
            F.lit(name).alias("feature"),
            (F.col(f"f{i}") / F.col("plan_users")).alias("rate"),
        )
        for i, name in enumerate(rules.catalogue)
    ])
    fit = F.sort_array(F.filter(rated, lambda x: x.rate >= rules.min_fit))
    return per_plan.select("plan", fit.alias("fit")).select(
        "plan",
        F.col("fit.feature").alias("fit_features"),
        F.map_from_arrays("fit.feature", "fit.rate").alias("fit_rates"),
    )


def with_offers(
    facts: DataFrame, rules: AdviceRules = AdviceRules(), fit: DataFrame | None = None
) -> DataFrame:
    """Adds ``offers``: unused features that suit the user's plan, best first.

    The join is left to adaptive execution, which broadcasts the few rows of
    ``fit`` once it has seen how small they are. Pass ``fit`` made from a stored
    table, or ``facts`` are computed twice.
    """
    fit = feature_fit(facts, rules) if fit is None else fit
    none = F.array().cast("array<string>")
    return facts.join(fit, "plan", "left").withColumn(
        "offers", F.array_except(F.coalesce("fit_features", none), F.col("features"))
    )


def feature_gap_ranked(facts: DataFrame, rules: AdviceRules = AdviceRules()) -> DataFrame:
    offers = with_offers(facts, rules).select(
        "user_id", "plan", "fit_rates", F.posexplode("offers").alias("position", "feature")
    )
    return offers.select(
        "user_id", "plan", "feature",
        F.element_at("fit_rates", F.col("feature")).alias("rate"),
        (F.col("position") + 1).alias("position"),
    )


def _fill(text: str, values: dict[str, Column]) -> Column:
    for name, value in values.items():
        head, mark, tail = text.partition("{" + name + "}")
        if mark:
            return F.concat(F.lit(head), value, F.lit(tail))
    return F.lit(text)


def _opening() -> Column:
    opening = F
    for name, text in OPENINGS.items():
        opening = opening.when(F.col("urgency") == name, text)
    return opening.otherwise(F.lit(None).cast("string"))


def _or_default(column: str, default: str) -> Column:
    return F.when(F.col(column) == "", default).otherwise(F.col(column))


def _steps_text(rules: AdviceRules) -> Column:
    """All fitting actions as one text; reads ``learn_text`` and ``offer_text``."""
    values = {
        "critical": F.col("open_critical").cast("string"),
        "learn": _or_default("learn_text", "las features sin adoptar"),
        "offer": _or_default("offer_text", "un plan superior"),
        "open": F.col("open_tickets").cast("string"),
    }
    parts = [
        F.when(condition, _fill(ACTION_TEXTS[kind], values))
        for kind, condition in action_conditions(rules).items()
    ]
    parts.append(F.when(F.col("open_tickets") > 0, _fill(FOLLOW_UP, values)))
    parts.append(F.when(F.size("offers") > 0, _fill(SHOW_OFFER, values)))
    return F.concat_ws("; ", *parts)


def _reasoning_text() -> Column:
    """Unknown parts read as blank: the text itself is never NULL."""
    return F.concat_ws(
        "", F.lit("Riesgo "), F.col("risk_level"), F.lit(" con "),
        F.col("score").cast("string"), F.lit(" puntos: "), F.col("reasons"), F.lit(". Plan "),
        F.col("plan"), F.lit(", MRR "), F.col("mrr_usd").cast("string"), F.lit(" USD."),
    )


def advise(
    scored: DataFrame, rules: AdviceRules = AdviceRules(), run_ts: dt.datetime | None = None,
    fit: DataFrame | None = None,
) -> DataFrame:
    """Scored users with urgency, offers, recommendation and reasoning.

    Low-risk users keep their row, with NULL advice: the report needs them.
    """
    risky = is_at_risk(F.col("risk_level"))
    not_adopted = F.sort_array(F.array_except("features", "adopted"))
    # Text is built in steps, each a column: nested once more per use, it would
    # grow into generated methods too large for the JVM to compile.
    return (
        with_offers(with_urgency(scored, rules), rules, fit)
        .withColumns({
            "offer_text": F.array_join("offers", ", "),
            "learn_text": F.array_join(not_adopted, ", "),
        })
        .withColumn("steps_text", _steps_text(rules))
        .withColumns({
            "recommendation": F.when(risky, F.concat(
                _opening(),
                F.when(F.col("steps_text") == "", "")
                .otherwise(F.concat(F.lit(": "), F.col("steps_text"))),
            )),
            "reasoning": F.when(risky, _reasoning_text()),
            "created_at": run_timestamp(run_ts),
        })
        .drop("offer_text", "learn_text", "steps_text")
    )


def recommendations(advised: DataFrame) -> DataFrame:
    return advised.where(is_at_risk(F.col("risk_level"))).select(*RECOMMENDATION_COLUMNS)


def recommendation_actions(
    scored: DataFrame, rules: AdviceRules = AdviceRules()
) -> DataFrame:
    """Candidate actions of every risky user, one row each."""
    kinds = F.array(*[F.when(cond, kind) for kind, cond in action_conditions(rules).items()])
    return (
        scored.where(is_at_risk(F.col("risk_level")))
        .select("user_id", F.explode(kinds).alias("action"))
        .where("action IS NOT NULL")
    )

"""One row per user from users, feature usage and support tickets.

Both child tables are aggregated by user before any join, so no join multiplies
rows, the heavy shuffles carry partial aggregates only, and a user holding a
large share of a child table arrives as one small record per map task.

Value lists (features, ticket categories) are aggregated as bit masks over
their known domain. Values outside it are kept by a side branch, which reads
them by a filter that Parquet dictionaries answer; where there are none,
adaptive execution drops its join. For tables that passed the accepted-values
check (``quality.domain_violations``), ``closed=True`` saves the branch: an
unlisted value then fails the job, it is never lost.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import (
    MASK_BITS,
    adoption_ordinal, days_between, domain_masks, is_at_risk, is_open, is_urgent_open,
    joined_or_null, masked_values,
)
from ..rules import AdviceRules
from ..schemas import CATEGORIES

SUMMARY_COLUMNS = (
    "user_id", "country", "plan", "signup_date", "source", "mrr_usd", "original_churn_score",
    "features_count", "days_since_last_activity", "worst_adoption_level",
    "best_adoption_level", "features_list", "total_tickets", "open_tickets",
    "critical_open_tickets", "worst_csat", "avg_csat", "ticket_categories",
)
SPLIT_COUNTS = ("open_critical", "open_high", "open_other")
_COUNTS = ("total_tickets", "open_tickets", "critical_open_tickets", *SPLIT_COUNTS)


def user_profile(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id", "country", "plan", "signup_date", "source", "mrr_usd",
        F.col("churn_risk_score").alias("original_churn_score"), "features_count",
    )


def usage_with_ordinal(usage: DataFrame) -> DataFrame:
    return usage.withColumn("adoption_rank", adoption_ordinal(F.col("adoption_level")))


def usage_by_user(
    usage: DataFrame, as_of: dt.date, advice: AdviceRules = AdviceRules(), closed: bool = False
) -> DataFrame:
    rank, feature = F.col("adoption_rank"), F.col("feature")
    adopted = rank >= advice.adopted_from
    ranked = usage_with_ordinal(usage)
    bits = domain_masks(feature, advice.catalogue, closed)
    main = ranked.groupBy("user_id").agg(
        F.max("last_used_date").alias("last_activity"),
        F.min(rank).alias("worst_adoption_level"),
        F.max(rank).alias("best_adoption_level"),
        *_or_all("feature_mask", bits),
        *_or_all("adopted_mask", [F.when(adopted, bit) for bit in bits]),
    )
    if not closed:
        unlisted = ranked.where(~feature.isin(*advice.catalogue)).groupBy("user_id").agg(
            F.collect_set(feature).alias("more_features"),
            F.collect_set(F.when(adopted, feature)).alias("more_adopted"),
        )
        main = main.join(unlisted, "user_id", "left")
    return main.withColumns({
        "features": _values("feature_mask", "more_features", advice.catalogue, closed),
        "adopted": _values("adopted_mask", "more_adopted", advice.catalogue, closed),
        "days_since_last_activity": days_between(as_of, F.col("last_activity")),
    }).drop(*_mask_names("feature_mask", advice.catalogue),
            *_mask_names("adopted_mask", advice.catalogue), "more_features", "more_adopted")


def _mask_names(name: str, domain: tuple[str, ...]) -> list[str]:
    return [f"{name}_{i}" for i in range(-(-len(domain) // MASK_BITS))]


def _or_all(name: str, bits: list[Column]) -> list[Column]:
    return [F.bit_or(bit).alias(f"{name}_{i}") for i, bit in enumerate(bits)]


def _values(mask: str, more: str, domain: tuple[str, ...], closed: bool) -> Column:
    """Listed values of the mask, plus unlisted ones if the user has any."""
    none = F.lit(0).cast("bigint")
    listed = masked_values([F.coalesce(m, none) for m in _mask_names(mask, domain)], domain)
    if closed:
        return listed
    return F.when(F.col(more).isNull(), listed).otherwise(F.concat(listed, F.col(more)))


def _ticket_flags() -> dict[str, Column]:
    """What a ticket counts for, as conditions on its row."""
    status, priority = F.col("status"), F.col("priority")
    return {
        "total_tickets": F.lit(True), "open_tickets": is_open(status),
        "critical_open_tickets": is_urgent_open(status, priority),
        "open_critical": is_open(status) & (priority == "Critical"),
        "open_high": is_open(status) & (priority == "High"),
    }


def tickets_by_user(tickets: DataFrame, closed: bool = False) -> DataFrame:
    """Ticket figures per user. A ticket that has several rows counts once for each figure that
    any of them fulfils; all its ratings count. ``closed`` input holds every id once."""
    category = F.col("category")
    masks = _or_all("category_mask", domain_masks(category, CATEGORIES, closed))
    count_if = lambda cond: F.count(F.when(cond, 1))
    rated, sums = F.count("csat_score"), F.sum("csat_score")
    if closed:
        counts = [count_if(cond).alias(name) for name, cond in _ticket_flags().items()]
        rows = tickets
    else:
        # Rows of one ticket meet before they are counted; the spread is by ticket, not by user.
        rows = tickets.groupBy("user_id", "ticket_id").agg(
            *[F.max(cond).alias(name) for name, cond in _ticket_flags().items()],
            F.min("csat_score").alias("csat_score"), rated.alias("rated"), sums.alias("csat_sum"),
            *masks,
        )
        known = F.col("ticket_id").isNotNull()
        counts = [count_if(known & F.col(name)).alias(name) for name in _ticket_flags()]
        masks = [F.bit_or(n).alias(n) for n in _mask_names("category_mask", CATEGORIES)]
        rated, sums = F.sum("rated"), F.sum("csat_sum")
    main = rows.groupBy("user_id").agg(
        *counts, F.min("csat_score").alias("worst_csat"),
        F.round(sums / F.nullif(rated, F.lit(0)), 1).alias("avg_csat"), *masks,
    )
    if not closed:
        unlisted = tickets.where(~category.isin(*CATEGORIES)).groupBy("user_id").agg(
            F.collect_set(category).alias("more_categories")
        )
        main = main.join(unlisted, "user_id", "left")
    return main.withColumns({
        "open_other": F.col("open_tickets") - F.col("open_critical") - F.col("open_high"),
        "categories": _values("category_mask", "more_categories", CATEGORIES, closed),
    }).drop(*_mask_names("category_mask", CATEGORIES), "more_categories")


def user_facts(
    users: DataFrame, usage: DataFrame, tickets: DataFrame, as_of: dt.date,
    advice: AdviceRules = AdviceRules(), closed: bool = False,
) -> DataFrame:
    """All per-user figures; list columns stay arrays for later operators."""
    empty = F.array().cast("array<string>")
    facts = (
        user_profile(users)
        .join(usage_by_user(usage, as_of, advice, closed), "user_id", "left")
        .join(tickets_by_user(tickets, closed), "user_id", "left")
    )
    return facts.withColumns(
        {
            **{name: F.coalesce(name, F.lit(0).cast("bigint")) for name in _COUNTS},
            **{name: F.coalesce(name, empty) for name in ("features", "adopted", "categories")},
        }
    ).withColumns(
        {
            "features_list": joined_or_null(F.col("features")),
            "ticket_categories": joined_or_null(F.col("categories")),
        }
    )


def user_summary(
    users: DataFrame, usage: DataFrame, tickets: DataFrame, as_of: dt.date, closed: bool = False
) -> DataFrame:
    facts = user_facts(users, usage, tickets, as_of, closed=closed)
    return facts.select(*SUMMARY_COLUMNS, *SPLIT_COUNTS)


def left_join_on_user(users: DataFrame, child: DataFrame) -> DataFrame:
    """Row-level left join that survives one user holding much of the child.

    Adaptive execution splits a skewed child only in an inner join, so matched
    rows come from an inner join and users without any child row from an anti
    join against the distinct keys.
    """
    matched = users.join(child, "user_id")
    keys = child.select("user_id").distinct()
    missing = users.join(keys, "user_id", "left_anti")
    return matched.unionByName(missing, allowMissingColumns=True)


def churn_detail(scores: DataFrame, summary: DataFrame) -> DataFrame:
    """Risky users only: score joined to the summary; sorting is up to the sink."""
    profile = [c for c in SUMMARY_COLUMNS if c != "original_churn_score"]
    risky = scores.where(is_at_risk(F.col("risk_level")))
    return risky.join(summary.select(*profile), "user_id").select(
        "user_id", "score", "risk_level", "reasons", "analyzed_at", *profile[1:]
    )


def by_score(rows: DataFrame) -> DataFrame:
    """Highest score first, for sinks that show or export an ordered list."""
    return rows.orderBy(F.desc("score"), "user_id")

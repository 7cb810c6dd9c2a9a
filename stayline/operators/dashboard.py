"""User detail: features, tickets and the nested user document."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import adoption_ordinal, days_between, stable_bucket


def user_detail_features(usage: DataFrame, as_of: dt.date) -> DataFrame:
    return usage.select(
        "user_id", "feature", "adoption_level",
        adoption_ordinal(F.col("adoption_level")).alias("adoption_rank"),
        days_between(as_of, F.col("last_used_date")).alias("days_since_use"),
    )


def user_detail_tickets(users: DataFrame, tickets: DataFrame) -> DataFrame:
    return users.select("user_id", "country", "plan").join(
        tickets.select(
            "user_id", "ticket_id", "category", "priority", "status", "created_date",
            "csat_score",
        ),
        "user_id",
    )


def _paged(rows: DataFrame, profile: DataFrame, *part_key: str) -> DataFrame:
    """Rows with their page: a hash of their own key deals those of large accounts.

    Small accounts have page 0 only, so just the large ones are joined. That
    join is left to adaptive execution: few accounts are broadcast, many are
    shuffled and a hot one is split.
    """
    large = profile.where(F.col("pages") > 1).select("user_id", "pages")
    page = F.when(F.col("pages").isNull(), F.lit(0).cast("bigint")).otherwise(
        stable_bucket(F.concat_ws("|", *part_key), F.col("pages"))
    )
    return rows.join(large, "user_id", "left").withColumn("page", page).drop("pages")


def user_360(
    scored: DataFrame, usage: DataFrame, tickets: DataFrame, as_of: dt.date,
    page_size: int = 1000,
) -> DataFrame:
    """Profile, reasons, features and tickets nested, in pages.

    A user with up to ``page_size`` tickets and feature rows is one row (page 0
    of 1). Those of a larger account are dealt by a hash of the ticket id or
    the whole feature row into as many pages as it needs, so nothing is left out and no
    row or task has to hold an unbounded list; equal feature rows count once.
    ``scored`` should be a stored table: it is read more than once.
    """
    used = usage.groupBy("user_id").agg(F.count("*").alias("usage_rows"))
    pages_of = lambda count: F.ceil(F.coalesce(count, F.lit(0)) / page_size)
    profile = scored.join(used, "user_id", "left").select(
        "user_id", "country", "plan", "mrr_usd", "score", "risk_level", "reasons",
        "total_tickets",
        F.greatest(F.lit(1), pages_of(F.col("total_tickets")), pages_of(F.col("usage_rows")))
        .cast("bigint").alias("pages"),
    )
    # Shuffling on (user, page) spreads a large account over many tasks.
    feature = F.struct("feature", "adoption_level", "days_since_use")
    features = (
        _paged(user_detail_features(usage, as_of), profile, "feature", "adoption_level", "days_since_use")
        .groupBy("user_id", "page")
        .agg(F.sort_array(F.collect_set(feature)).alias("features"))
    )
    ticket = F.struct("ticket_id", "category", "priority", "status", "created_date", "csat_score")
    pages = (
        _paged(tickets, profile, "ticket_id")
        .repartition("user_id", "page")
        .groupBy("user_id", "page")
        .agg(F.sort_array(F.collect_list(ticket)).alias("tickets"))
    )
    rows = profile.select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pages") - 1)).alias("page")
    )
    none_f = F.array().cast(
        "array<struct<feature:string,adoption_level:string,days_since_use:int>>")
    none_t = F.array().cast(
        "array<struct<ticket_id:string,category:string,priority:string,status:string,"
        "created_date:date,csat_score:int>>")
    return (
        rows.join(features, ["user_id", "page"], "left")
        .join(pages, ["user_id", "page"], "left")
        .withColumns({
            "features": F.coalesce("features", none_f),
            "tickets": F.coalesce("tickets", none_t),
        })
    )

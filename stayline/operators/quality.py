"""Integrity rules as jobs: each returns the violations, or counts of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import is_open
from ..schemas import TABLE_RULES


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _tagged(name: str) -> Column:
    return F.lit(name).alias("table_name")


def duplicate_keys(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([
        df.groupBy(F.col(TABLE_RULES[name].primary_key).alias("key_value"))
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select(_tagged(name), "key_value", "n")
        for name, df in tables.items() if TABLE_RULES[name].primary_key
    ])


def orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """User ids that child rows name but ``users`` lacks, with row counts.

    Counting per id comes first: it collapses a hot id before the anti join.
    """
    known = tables["users"].select("user_id")
    return _union([
        df.groupBy("user_id").agg(F.count("*").alias("n"))
        .join(known, "user_id", "left_anti")
        .select(_tagged(name), "user_id", "n")
        for name, df in tables.items() if TABLE_RULES[name].references_users
    ])


def null_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """NULLs per required column, one pass per table."""
    parts = []
    for name, df in tables.items():
        required = TABLE_RULES[name].required
        counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in required])
        rows = F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in required
        ])
        parts.append(counts.select(_tagged(name), F.inline(rows)))
    return _union(parts)


def _violations(df: DataFrame, name: str, broken: dict[str, Column]) -> DataFrame:
    """Counts of offending values per column, from one pass over the table."""
    rows = F.array(*[
        F.struct(
            F.lit(column).alias("column_name"),
            F.when(condition, F.col(column).cast("string")).alias("value"),
        )
        for column, condition in broken.items()
    ])
    return (
        df.select(F.inline(rows))
        .where("value IS NOT NULL")
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
        .select(_tagged(name), "column_name", "value", "n")
    )


def domain_violations(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([
        _violations(df, name, {
            column: ~F.col(column).isin(*values)
            for column, values in TABLE_RULES[name].domains.items()
        })
        for name, df in tables.items() if TABLE_RULES[name].domains
    ])


def range_violations(tables: dict[str, DataFrame]) -> DataFrame:
    def outside(df: DataFrame, column: str, low: str, high: str) -> Column:
        dtype = df.schema[column].dataType
        return ~F.col(column).between(F.lit(low).cast(dtype), F.lit(high).cast(dtype))

    return _union([
        _violations(df, name, {
            column: outside(df, column, low, high)
            for column, (low, high) in TABLE_RULES[name].ranges.items()
        })
        for name, df in tables.items() if TABLE_RULES[name].ranges
    ])


def id_format(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([
        _violations(df, name, {
            column: ~F.col(column).rlike(pattern)
            for column, pattern in TABLE_RULES[name].id_patterns.items()
        })
        for name, df in tables.items() if TABLE_RULES[name].id_patterns
    ])


def free_plan_mrr(users: DataFrame) -> DataFrame:
    return users.where((F.col("plan") == "Free") & (F.col("mrr_usd") != 0)).select(
        "user_id", "plan", "mrr_usd"
    )


def ticket_lifecycle(tickets: DataFrame) -> DataFrame:
    """Unresolved tickets that carry resolution figures."""
    filled = (
        F.col("resolved_date").isNotNull()
        | F.col("resolution_hours").isNotNull()
        | F.col("csat_score").isNotNull()
    )
    return tickets.where(is_open(F.col("status")) & filled).select(
        "ticket_id", "status", "resolved_date", "resolution_hours", "csat_score"
    )


def features_count_check(users: DataFrame, usage: DataFrame) -> DataFrame:
    """Users whose ``features_count`` is not the number of features their usage rows name.

    Both sides are reconciled: users without usage rows count as 0, and usage rows of nobody
    have no declared count. Equal users are left out.
    """
    listed = usage.groupBy("user_id").agg(F.count_distinct("feature").alias("listed"))
    declared = users.select("user_id", F.col("features_count").alias("declared"), F.lit(True).alias("known"))
    both = declared.join(listed, "user_id", "full")
    found = F.coalesce("listed", F.lit(0).cast("bigint"))
    fault = (
        F.when(F.col("known").isNull(), "unknown_user")
        .when(F.col("declared").isNull(), "not_declared")
        .when(F.col("listed").isNull() & (F.col("declared") != 0), "no_usage")
        .when(found < F.col("declared"), "fewer_listed")
        .when(found > F.col("declared"), "more_listed")
    )
    return both.select(
        "user_id", F.col("declared").cast("bigint").alias("declared"), found.alias("listed"),
        fault.alias("fault"),
    ).where("fault IS NOT NULL")

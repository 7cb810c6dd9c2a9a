"""Risk over time: validity intervals of levels, transitions between runs, time in a band.

The input holds one row per user and run. Runs are few, so their dates are read once and stand
in the plans as literals; windows run over the rows of one user, of which there is one a run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

NEW, GONE = "nuevo", "ausente"  # before a user's first run, and after a run without them


def run_dates(scores: DataFrame) -> list[dt.date]:
    """The dates of the runs, in order: one value a run reaches the driver."""
    rows = scores.select("run_date").distinct().collect()
    return sorted(r.run_date for r in rows if r.run_date is not None)


def _numbered(scores: DataFrame, days: list[dt.date]) -> DataFrame:
    """Rows with the number of their run, from 1, and the dates of the runs."""
    dates = F.array(*[F.lit(day) for day in days]) if days else F.array().cast("array<date>")
    return scores.where("run_date IS NOT NULL").select(
        "user_id", "run_date", "score", "risk_level",
        F.array_position(dates, F.col("run_date")).alias("run_no"), dates.alias("runs"),
    )


def _date_of(run_no: Column) -> Column:
    """The date of a run; NULL past the last one."""
    return F.try_element_at("runs", run_no.cast("int"))


def risk_history(scores: DataFrame) -> DataFrame:
    """One row per user and stretch of runs with one level.

    ``valid_from`` is the stretch's first run, ``valid_to`` the first run that no longer has
    it: with another level, or without the user. It is NULL while the stretch lasts. A run
    that leaves the user out ends a stretch, whatever the level afterwards.
    """
    by_user = Window.partitionBy("user_id").orderBy("run_no")
    begins = (
        F.lag("risk_level").over(by_user).isNull()
        | ~F.lag("risk_level").over(by_user).eqNullSafe(F.col("risk_level"))
        | (F.lag("run_no").over(by_user) != F.col("run_no") - 1)
    )
    islands = _numbered(scores, run_dates(scores)).withColumn("begins", begins).withColumn(
        "stretch", F.sum(F.col("begins").cast("int")).over(by_user)
    )
    first, last = (F.struct("run_no", "run_date", "score") for _ in range(2))
    return (
        islands.groupBy("user_id", "stretch", "risk_level")
        .agg(
            F.min(first).alias("a"), F.max(last).alias("z"), F.count("*").alias("runs_held"),
            F.min("score").alias("min_score"), F.max("score").alias("max_score"),
            F.any_value("runs").alias("runs"),
        )
        .select(
            "user_id", "risk_level", F.col("a.run_date").alias("valid_from"),
            _date_of(F.col("z.run_no") + 1).alias("valid_to"), "runs_held",
            F.col("a.score").alias("first_score"), F.col("z.score").alias("last_score"),
            "min_score", "max_score",
        )
    )


def risk_transitions(scores: DataFrame) -> DataFrame:
    """Per pair of neighbouring runs the users who went from one level to another.

    Users without a row in the earlier run come from ``nuevo``, those without one in the
    later run go to ``ausente``. ``score_change`` sums what the scores of both runs differ.
    """
    days = run_dates(scores)
    rows = _numbered(scores, days)
    # Each row is the later end of one step and the earlier end of the next.
    ends = rows.select(
        "user_id", "runs", F.inline(F.array(
            F.struct(F.col("run_no").alias("step"), F.col("risk_level").alias("now"),
                     F.lit(None).cast("string").alias("before"), F.col("score").alias("change")),
            F.struct((F.col("run_no") + 1).alias("step"), F.lit(None).cast("string").alias("now"),
                     F.col("risk_level").alias("before"), (-F.col("score")).alias("change")),
        )),
    ).where((F.col("step") > 1) & (F.col("step") <= len(days)))
    steps = ends.groupBy("user_id", "step").agg(
        F.max("before").alias("before"), F.max("now").alias("now"),
        F.when(F.count("*") == 2, F.sum("change")).alias("change"), F.any_value("runs").alias("runs"),
    )
    return steps.groupBy(
        _date_of(F.col("step") - 1).alias("from_run"), _date_of(F.col("step")).alias("to_run"),
        F.coalesce("before", F.lit(NEW)).alias("from_level"),
        F.coalesce("now", F.lit(GONE)).alias("to_level"),
    ).agg(F.count("*").alias("users"), F.coalesce(F.sum("change"), F.lit(0)).alias("score_change"))


def time_in_band(history: DataFrame, as_of: dt.date) -> DataFrame:
    """Per level: stretches, users, those that last still, and days held up to ``as_of``."""
    days = F.datediff(F.least(F.coalesce("valid_to", F.lit(as_of)), F.lit(as_of)), "valid_from")
    return history.where(F.col("valid_from") <= F.lit(as_of)).groupBy("risk_level").agg(
        F.count("*").alias("stretches"), F.count_distinct("user_id").alias("users"),
        F.count(F.when(F.col("valid_to").isNull(), 1)).alias("lasting"),
        F.sum(days).alias("days"), F.max(days).alias("longest"),
    )

"""Resolution hours of tickets by category, priority and channel.

Exact percentiles come from counts of equal hours, which a group has few of; what travels is
one row per group and value. For figures over many runs each run stores quantile sketches of
bounded size instead; they merge without the tickets being read again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

DIMENSIONS = ("category", "priority", "channel")
SHARES = (0.5, 0.9, 0.95)
SKETCH_K = 400  # size of a sketch: ranks are within about 0.7 % of the tickets
RANK_ERROR = 0.012


def _names() -> list[str]:
    return [f"p{round(100 * share)}" for share in SHARES]


def _grouped(df: DataFrame):
    """Every dimension by itself, all three together, and all tickets."""
    sets = [[F.col(d)] for d in DIMENSIONS] + [[F.col(d) for d in DIMENSIONS], []]
    return df.groupingSets(sets, *DIMENSIONS)


def _label():
    """Which dimensions a row is of; NULL in a dimension may be a value of its own."""
    named = [F.when(F.grouping(d) == 0, F.lit(d)) for d in DIMENSIONS]
    return F.concat_ws(",", *named).alias("grouped_by")


def resolution_hours(tickets: DataFrame) -> DataFrame:
    """Per group: tickets with hours, mean, percentiles (interpolated) and longest."""
    counted = tickets.where("resolution_hours IS NOT NULL").groupBy(*DIMENSIONS, "resolution_hours").agg(
        F.count("*").alias("n")
    )
    hours = F.col("resolution_hours")
    return _grouped(counted).agg(
        _label(), F.sum("n").alias("tickets"),
        F.round(F.sum(hours.cast("bigint") * F.col("n")) / F.sum("n"), 2).alias("mean_hours"),
        F.percentile(hours, list(SHARES), F.col("n")).alias("p"),
        F.max(hours).alias("longest"),
    ).select(
        "grouped_by", *DIMENSIONS, "tickets", "mean_hours",
        *(F.col("p")[i].alias(name) for i, name in enumerate(_names())), "longest",
    )


def hours_sketches(tickets: DataFrame, run_date: dt.date) -> DataFrame:
    """What a run stores: one sketch per category, priority and channel."""
    return tickets.where("resolution_hours IS NOT NULL").groupBy(*DIMENSIONS).agg(
        F.count("*").alias("tickets"), F.sum(F.col("resolution_hours").cast("bigint")).alias("hours"),
        F.max("resolution_hours").alias("longest"),
        F.kll_sketch_agg_bigint(F.col("resolution_hours").cast("bigint"), SKETCH_K).alias("sketch"),
    ).withColumn("of_run", F.lit(run_date))


def hours_from_sketches(sketches: DataFrame) -> DataFrame:
    """The figures of ``resolution_hours`` over all stored runs; percentiles are values of the
    sketch, so within its rank error and not interpolated."""
    merged = _grouped(sketches).agg(
        _label(), F.sum("tickets").alias("tickets"),
        F.round(F.sum("hours") / F.sum("tickets"), 2).alias("mean_hours"),
        F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch"), F.max("longest").alias("longest"),
    )
    return merged.select(
        "grouped_by", *DIMENSIONS, "tickets", "mean_hours",
        *(F.kll_sketch_get_quantile_bigint("sketch", F.lit(share)).alias(name)
          for share, name in zip(SHARES, _names(), strict=True)),
        "longest",
    )


def sketch_errors(tickets: DataFrame, estimates: DataFrame) -> DataFrame:
    """How far the rank of each estimate is from the share it stands for, as part of the tickets."""
    names = _names()
    counted = tickets.where("resolution_hours IS NOT NULL").groupBy(*DIMENSIONS, "resolution_hours").agg(
        F.count("*").alias("n")
    )
    by_group = _grouped(counted.withColumn("h", F.struct("resolution_hours", "n"))).agg(
        _label(), F.sum("n").alias("all"), F.collect_list("h").alias("values")
    )
    same = [F.col(f"e.{d}").eqNullSafe(F.col(f"x.{d}")) for d in ("grouped_by", *DIMENSIONS)]
    joined = by_group.alias("x").join(estimates.alias("e"), same)

    def error(name: str, share: float):
        # Ranks that the value covers: from the tickets below it to those up to it.
        def count(cond):
            return F.aggregate(
                "x.values", F.lit(0).cast("bigint"),
                lambda total, v: total + F.when(cond(v.resolution_hours), v.n).otherwise(F.lit(0)),
            ) / F.col("x.all")

        low, high = count(lambda h: h < F.col(f"e.{name}")), count(lambda h: h <= F.col(f"e.{name}"))
        return F.greatest(F.lit(0.0), low - share, share - high).alias(f"{name}_error")

    return joined.select(
        "x.grouped_by", *(f"x.{d}" for d in DIMENSIONS), F.col("e.tickets").alias("tickets"),
        *(error(name, share) for name, share in zip(names, SHARES, strict=True)),
    )

"""Profiles that are kept per load and merged without reading a load again.

Each load stores one row per column: counts, bounds, a sketch of its distinct values and one of
its distribution. Sketches have a fixed size, so the profile of all loads costs as much as
there are loads, whatever they held.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

DISTINCT_LOG = 12  # 2 ** 12 registers: a relative error of about 1.6 %
SKETCH_K = 400
_WHOLE = (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DateType)


def _number(field: T.StructField) -> Column | None:
    """The column as a whole number, if it has an order that a distribution makes sense of."""
    if isinstance(field.dataType, T.DateType):
        return F.unix_date(field.name).cast("bigint")
    if isinstance(field.dataType, _WHOLE):
        return F.col(field.name).cast("bigint")
    if isinstance(field.dataType, T.DecimalType):  # in its smallest unit
        return (F.col(field.name) * (10 ** field.dataType.scale)).cast("bigint")
    return None


def load_profile(df: DataFrame, load: str) -> DataFrame:
    """One row per column, for storing: ``load, column_name, ...``; one pass over the load."""
    def stats(field: T.StructField) -> Column:
        column, number = F.col(field.name), _number(field)
        return F.struct(
            F.count(F.when(column.isNull(), 1)).alias("nulls"),
            F.min(column).cast("string").alias("min_value"), F.max(column).cast("string").alias("max_value"),
            F.min(number if number is not None else F.lit(None).cast("bigint")).alias("min_number"),
            F.max(number if number is not None else F.lit(None).cast("bigint")).alias("max_number"),
            F.hll_sketch_agg(column.cast("string"), DISTINCT_LOG).alias("distinct"),
            (F.lit(None).cast("binary") if number is None
             else F.kll_sketch_agg_bigint(number, SKETCH_K)).alias("spread"),
        ).alias(field.name)

    one = df.agg(F.count("*").alias("rows"), *(stats(f) for f in df.schema))
    return one.select(F.inline(F.array(*[
        F.struct(
            F.lit(load).alias("load"), F.lit(c).alias("column_name"), F.col("rows"),
            *(F.col(f"`{c}`.{part}").alias(part) for part in (
                "nulls", "min_value", "max_value", "min_number", "max_number", "distinct", "spread")),
        ) for c in df.columns
    ])))


def all_loads(profiles: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, profiles)


def _figures(df: DataFrame) -> DataFrame:
    middle = F.when(F.col("spread").isNotNull() & (F.kll_sketch_get_n_bigint("spread") > 0),
                    F.kll_sketch_get_quantile_bigint("spread", F.lit(0.5)))
    return df.withColumns({
        "distinct_values": F.hll_sketch_estimate("distinct"), "median_number": middle,
    }).drop("distinct", "spread")


def merged_profile(profiles: DataFrame) -> DataFrame:
    """The profile of all stored loads together. Texts compare as texts; where a column is a
    number or a date, ``min_number`` and ``max_number`` are its bounds (days since 1970)."""
    return _figures(profiles.groupBy("column_name").agg(
        F.count("*").alias("loads"), F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.when(F.max("max_number").isNull(), F.min("min_value")).alias("min_value"),
        F.when(F.max("max_number").isNull(), F.max("max_value")).alias("max_value"),
        F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"),
        F.hll_union_agg("distinct", True).alias("distinct"),
        F.when(F.count("spread") > 0, F.kll_merge_agg_bigint("spread", SKETCH_K)).alias("spread"),
    ))


def profile_drift(profiles: DataFrame) -> DataFrame:
    """Each load beside the one before it (by name): share of NULLs, and how many of its distinct
    values earlier loads did not have (by estimate)."""
    by_column = Window.partitionBy("column_name").orderBy("load")
    upto = by_column.rowsBetween(Window.unboundedPreceding, -1)
    seen = profiles.withColumns({
        "null_share": F.round(F.col("nulls") / F.nullif("rows", F.lit(0)), 6),
        "before": F.hll_union_agg("distinct", True).over(upto),
    })
    known = F.coalesce(F.hll_sketch_estimate("before"), F.lit(0))
    both = F.hll_sketch_estimate(F.coalesce(F.hll_union("before", "distinct", True), "distinct"))
    return seen.select(
        "load", "column_name", "rows", "null_share",
        F.lag("null_share").over(by_column).alias("null_share_before"),
        F.hll_sketch_estimate("distinct").alias("distinct_values"),
        F.greatest(both - known, F.lit(0)).alias("new_values"),
    )

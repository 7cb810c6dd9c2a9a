"""Text landing to typed tables: blanks to NULL, types, rejects and a profile."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import trim_all, with_computed
from ..schemas import TABLE_RULES

MALFORMED = "_malformed"
WHOLE_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
FAULTS = "array<struct<column_name: string, raw_value: string, reason: string>>"


class Split(NamedTuple):
    accepted: DataFrame
    rejects: DataFrame


def usage_key() -> Column:
    """Generated row key of feature usage, unique within a load, as a sequence would give it."""
    return F.monotonically_increasing_id()


def _staged(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds ``text_<c>`` (trimmed) and ``value_<c>`` (typed) for every column."""
    trimmed = with_computed(raw, {f"text_{c}": trim_all(F.col(c)) for c in schema.names})

    def readable(field: T.StructField) -> Column:
        text = F.col(f"text_{field.name}")
        if isinstance(field.dataType, T.DateType):  # a cast alone reads 2025-02 as a day
            return text.rlike(WHOLE_DATE)
        return text != ""

    return with_computed(trimmed, {
        f"value_{f.name}": F.when(readable(f), F.col(f"text_{f.name}")).try_cast(f.dataType)
        for f in schema.fields
    })


def _values(staged: DataFrame, schema: T.StructType) -> DataFrame:
    return staged.select(*[F.col(f"value_{c}").alias(c) for c in schema.names])


def clean_blanks(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Blank text to NULL, then the declared type; bad values become NULL too."""
    return _values(_staged(raw, schema), schema)


def split_rejects(raw: DataFrame, table: str) -> Split:
    """Typed rows that are fully readable, and one reject row per bad field.

    Bad values do not stop the load. A malformed line (wrong field count) is
    rejected as a whole.
    """
    return split_checked(checked_rows(raw, table), table)


def split_checked(checked: DataFrame, table: str) -> Split:
    """Both sides of rows that were read and checked once; store them to read the source once."""
    names = TABLE_RULES[table].schema.names
    rejects = checked.select(
        F.lit(table).alias("table_name"), "row_key", F.inline("faults")
    )
    return Split(checked.where(F.size("faults") == 0).select(*[f"row.{c}" for c in names]), rejects)


def checked_rows(raw: DataFrame, table: str) -> DataFrame:
    """``row_key, row, faults``: every line with its typed values and what is wrong with it."""
    spec = TABLE_RULES[table]
    if MALFORMED not in raw.columns:
        raw = raw.withColumn(MALFORMED, F.lit(None).cast("string"))

    def problem(name: str) -> Column:
        text = F.col(f"text_{name}")
        blank = text.isNull() | (text == "")
        bad = ~blank & F.col(f"value_{name}").isNull()
        reason = F.when(bad, "bad_value")
        reason = reason.when(blank, "missing") if name in spec.required else reason
        return F.when(F.col(MALFORMED).isNull(), reason)

    names = spec.schema.names
    staged = _staged(raw, spec.schema)
    checked = with_computed(staged, {
        "reason_*": F.when(F.col(MALFORMED).isNotNull(), "malformed_line"),
        **{f"reason_{c}": problem(c) for c in names},
    })
    reasons = {"*": MALFORMED, **{c: c for c in names}}
    faults = F.array(*[
        F.struct(
            F.lit(name).alias("column_name"), F.col(source).alias("raw_value"),
            F.col(f"`reason_{name}`").alias("reason"),
        )
        for name, source in reasons.items()
    ])
    faulty = F.coalesce(*[F.col(f"`reason_{name}`") for name in reasons]).isNotNull()
    return checked.select(
        F.col(names[0]).alias("row_key"),
        F.struct(*[F.col(f"value_{c}").alias(c) for c in names]).alias("row"),
        F.when(faulty, F.filter(faults, lambda f: f.reason.isNotNull()))
        .otherwise(F.array().cast(FAULTS)).alias("faults"),  # most rows: no array to build
    )


def split_duplicates(rows: DataFrame, table: str) -> Split:
    """One row per primary key, and one reject for every key that repeats."""
    return split_keyed(keyed_rows(rows, table), table)


def split_keyed(keyed: DataFrame, table: str) -> Split:
    """Both sides of rows that met their keys once: a key that repeats is rejected and loads
    once, one that an earlier load holds is rejected and does not load."""
    key = TABLE_RULES[table].primary_key
    reasons = F.array_compact(F.array(
        F.when(F.col("n") > 1, "duplicate_key"), F.when(F.col("held"), "loaded_before")
    ))
    rejects = keyed.where("n > 1 OR held").select(
        F.lit(table).alias("table_name"), F.col(key).alias("row_key"),
        F.lit(key).alias("column_name"), F.col(key).alias("raw_value"),
        F.explode(reasons).alias("reason"),
    )
    return Split(keyed.where("NOT held").drop("n", "held"), rejects)


def keyed_rows(rows: DataFrame, table: str, keys: DataFrame | None = None) -> DataFrame:
    """One row per primary key, with ``n``: how often the key comes, and ``held``: whether an
    earlier load holds it (``key`` of ``keys``).

    Of repeated rows the smallest stays. A key repeated endlessly collapses map-side. Rows
    are shuffled once: the keys meet them where they are grouped.
    """
    key = TABLE_RULES[table].primary_key
    rest = F.struct(*[c for c in rows.columns if c != key])
    by_key = rows.groupBy(key).agg(F.min(rest).alias("rest"), F.count("*").alias("n"))
    by_key = by_key.select(key, "rest.*", "n")
    if keys is None:
        return by_key.select(*rows.columns, "n", F.lit(False).alias("held"))
    before = keys.select(F.col("key").alias(key)).distinct().withColumn("held", F.lit(True))
    return by_key.join(before, key, "left").select(
        *rows.columns, "n", F.col("held").isNotNull().alias("held")
    )


def split_owned(owned: DataFrame, table: str) -> Split:
    """Children load after users; rows of unknown users go to the rejects."""
    lost = owned.where("NOT owned").select(
        F.lit(table).alias("table_name"),
        F.col(TABLE_RULES[table].schema.names[0]).alias("row_key"),
        F.lit("user_id").alias("column_name"),
        F.col("user_id").alias("raw_value"),
        F.lit("unknown_user").alias("reason"),
    )
    return Split(owned.where("owned").drop("owned"), lost)


def owned_rows(children: DataFrame, lost: DataFrame) -> DataFrame:
    """The children with ``owned``: whether they name a user who is not among the ``lost``."""
    named = lost.select("user_id").distinct().withColumn("lost", F.lit(True))
    return children.join(named, "user_id", "left").select(
        *children.columns, (F.col("user_id").isNotNull() & F.col("lost").isNull()).alias("owned")
    )


def lost_users(children: list[DataFrame], users: DataFrame) -> DataFrame:
    """The users that children name and ``users`` does not hold, once each; few as a rule, so
    store them: rows of the children then meet them without being shuffled."""
    named = reduce(DataFrame.union, [rows.select("user_id") for rows in children]).distinct()
    return named.join(users.select("user_id"), "user_id", "left_anti")


def profile(
    df: DataFrame, rejects: DataFrame | None = None, exact: list[str] | None = None
) -> DataFrame:
    """Per column: rows, NULLs, distinct values, smallest and largest value printed.

    One pass with approximate distinct counts. The columns of ``exact`` are
    counted truly, by a shuffle of their values after a map-side count, so a
    value that fills much of a column is no burden.
    """
    names = df.columns
    stats = df.agg(F.count("*").alias("rows"), *[
        F.struct(
            F.count(F.when(F.col(c).isNull(), 1)), F.approx_count_distinct(c),
            F.min(c).cast("string"), F.max(c).cast("string"),
        ).alias(c) for c in names
    ])
    out = stats.select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col("rows"),
            F.col(f"{c}.col1").alias("nulls"), F.col(f"{c}.col2").alias("distinct_values"),
            F.col(f"{c}.col3").alias("min_value"), F.col(f"{c}.col4").alias("max_value"),
        ) for c in names
    ])))
    if exact:
        cells = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in exact
        ])))
        true = cells.where("value IS NOT NULL").distinct().groupBy("column_name").agg(
            F.count("*").alias("true_values")
        )
        counted = F.when(F.col("column_name").isin(*exact), F.coalesce("true_values", F.lit(0)))
        out = out.join(true, "column_name", "left").withColumn(
            "distinct_values", F.coalesce(counted, "distinct_values")
        ).drop("true_values")
    if rejects is None:
        return out
    bad = rejects.groupBy("column_name").agg(F.count("*").alias("rejected"))
    return out.join(bad, "column_name", "left").withColumn(
        "rejected", F.coalesce("rejected", F.lit(0).cast("bigint"))
    )


def all_rejects(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)

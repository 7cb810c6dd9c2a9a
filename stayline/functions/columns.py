"""Column expressions shared by the operators. All built-in, no Python UDF."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import ADOPTION_LEVELS, AT_RISK_LEVELS, OPEN_STATUSES, URGENT_PRIORITIES

# Spanish day and month names for long dates
WEEKDAYS = ("domingo", "lunes", "martes", "miércoles", "jueves", "viernes", "sábado")
MONTHS = (
    "enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre",
    "octubre", "noviembre", "diciembre",
)


def days_between(as_of: dt.date, day: Column) -> Column:
    """Whole days from ``day`` to the run date."""
    return F.datediff(F.lit(as_of), day)


def run_timestamp(run_ts: dt.datetime | None) -> Column:
    """The run clock as a zone-less timestamp, whatever the session's zone."""
    text = None if run_ts is None else run_ts.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def adoption_ordinal(level: Column) -> Column:
    """1 (activated) .. 5 (power_user); unknown levels give NULL."""
    chain = F.when(level == ADOPTION_LEVELS[0], 1)
    for rank, name in enumerate(ADOPTION_LEVELS[1:], start=2):
        chain = chain.when(level == name, rank)
    return chain


def is_open(status: Column) -> Column:
    return status.isin(*OPEN_STATUSES)


def is_urgent_open(status: Column, priority: Column) -> Column:
    return is_open(status) & priority.isin(*URGENT_PRIORITIES)


def is_at_risk(level: Column) -> Column:
    return level.isin(*AT_RISK_LEVELS)


def not_empty(value: Column) -> Column:
    return value.isNotNull() & (value != "")


BLANKS = " \t\n\r\x0b\x0c\u00a0\ufeff"


def trim_all(value: Column) -> Column:
    """Trim every kind of white space (plain ``trim`` removes spaces only)."""
    return F.trim(value, F.lit(BLANKS))


def strip_fences(value: Column) -> Column:
    """Remove Markdown code fences, with or without the json tag."""
    return F.regexp_replace(value, "```(json)?", "")


def first_non_empty(*values: Column) -> Column:
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values[:-1]], values[-1])


def shorten(value: Column, width: int) -> Column:
    return F.when(
        F.length(value) > width, F.concat(F.substring(value, 1, width), F.lit("…"))
    ).otherwise(value)


MASK_BITS = 63  # values in one mask word; a longer domain takes several words


def _mask_words(domain: tuple[str, ...]) -> list[tuple[str, ...]]:
    return [domain[i:i + MASK_BITS] for i in range(0, len(domain), MASK_BITS)]


def domain_masks(value: Column, domain: tuple[str, ...], closed: bool = False) -> list[Column]:
    """One bit per value of a fixed domain, in as many words as it needs; 0 for any other value.

    OR-ing these aggregates sets of values in plain numbers, several times
    faster than collecting them. With ``closed`` another value fails the job.
    """
    none = F.lit(0).cast("bigint")
    masks = []
    for word in _mask_words(domain):
        chain = F.when(value.isNull(), none)
        for bit, name in enumerate(word):
            chain = chain.when(value == name, F.lit(1 << bit).cast("bigint"))
        if closed and not masks:
            chain = chain.when(~value.isin(*domain), F.raise_error(
                F.concat(F.lit("value outside the closed domain: "), value)
            ).cast("bigint"))
        masks.append(chain.otherwise(none))
    return masks


def masked_values(masks: list[Column], domain: tuple[str, ...]) -> Column:
    """The values whose bits are set."""
    values = [
        F.when(mask.bitwiseAND(F.lit(1 << bit).cast("bigint")) != 0, name)
        for mask, word in zip(masks, _mask_words(domain), strict=True)
        for bit, name in enumerate(word)
    ]
    return F.array_except(F.array(*values), F.array(F.lit(None).cast("string")))


def joined_or_null(values: Column) -> Column:
    """Sorted values as ``a, b``; NULL if there are none."""
    return F.nullif(F.array_join(F.sort_array(values), ", "), F.lit(""))


def spanish_long_date(day: Column) -> Column:
    """For example ``lunes, 5 de noviembre de 2001``."""
    weekdays = F.array(*[F.lit(name) for name in WEEKDAYS])
    months = F.array(*[F.lit(name) for name in MONTHS])
    return F.concat(
        F.element_at(weekdays, F.dayofweek(day)), F.lit(", "),
        F.dayofmonth(day).cast("string"), F.lit(" de "),
        F.element_at(months, F.month(day)), F.lit(" de "),
        F.year(day).cast("string"),
    )


def plural_s(count: Column) -> Column:
    return F.when(count > 1, "s").otherwise("")


def json_text(value: Column) -> Column:
    """JSON text that keeps NULL fields."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def null_if_empty(collection: Column) -> Column:
    """Aggregating no rows gives a NULL collection, not an empty one."""
    return F.when(F.size(collection) > 0, collection)


def with_computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that later filters and projections reuse as they are.

    The optimizer copies plain projected expressions into every filter and
    expression above them; for long ones that repeats the work per row and
    grows generated methods past what the JVM compiles. Generated columns are
    never copied.
    """
    fields = [value.alias(name) for name, value in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*fields))))


def stable_bucket(key: Column, buckets: int | Column) -> Column:
    """Bucket of a text key, the same in every engine and every run."""
    head = F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets) if isinstance(buckets, int) else buckets)

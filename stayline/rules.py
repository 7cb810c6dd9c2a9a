"""Tunable rules: point table, risk bands, urgency and feature-fit settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, types as T

from .schemas import FEATURES

MAX_RULES = 500  # a point table is a settings file; refuse anything larger


@dataclass(frozen=True)
class PointRule:
    """``points`` if ``low <= metric <= high`` (or ``metric = equals``).

    With ``per_unit`` the points count once per unit of the metric. ``detail``
    is the reason text; ``{n}`` stands for the metric's value.
    """

    signal: str
    metric: str
    points: int
    detail: str
    low: int | None = None
    high: int | None = None
    equals: str | None = None
    per_unit: bool = False


# The point table and the reason texts ------------------------------
DEFAULT_POINTS = (
    PointRule("inactividad", "days_since_last_activity", 15, "Inactividad de {n} días", 31, 60),
    PointRule("inactividad", "days_since_last_activity", 30, "Inactividad de {n} días", 61, 90),
    PointRule("inactividad", "days_since_last_activity", 40, "Inactividad de {n} días", 91),
    PointRule("adopcion", "worst_adoption_level", 10, "adopción mínima activated", 1, 1),
    PointRule("adopcion", "worst_adoption_level", 5, "adopción mínima used_1x", 2, 2),
    PointRule("tickets_criticos", "open_critical", 25, "{n} tickets abiertos critical", 1,
              per_unit=True),
    PointRule("tickets_altos", "open_high", 15, "{n} tickets abiertos high", 1, per_unit=True),
    PointRule("tickets_otros", "open_other", 5, "{n} tickets abiertos medium/low", 1,
              per_unit=True),
    PointRule("csat", "worst_csat", 25, "CSAT peor = {n}", 1, 1),
    PointRule("csat", "worst_csat", 15, "CSAT peor = {n}", 2, 2),
    PointRule("plan", "plan", 10, "plan {n}", equals="Free"),
    PointRule("volumen_tickets", "total_tickets", 10, "{n} tickets en total", 4),
)
# ---------------------------------------------------------------------------------

METRICS = (
    "days_since_last_activity", "worst_adoption_level", "best_adoption_level", "total_tickets",
    "open_tickets", "critical_open_tickets", "open_critical", "open_high", "open_other",
    "worst_csat", "plan", "country", "source", "features_count",
)


@dataclass(frozen=True)
class ScoringRules:
    points: tuple[PointRule, ...] = DEFAULT_POINTS
    medium_from: int = 26
    high_from: int = 51

    def signals(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(rule.signal for rule in self.points))

    def of(self, signal: str) -> tuple[PointRule, ...]:
        return tuple(rule for rule in self.points if rule.signal == signal)


@dataclass(frozen=True)
class AdviceRules:
    adopted_from: int = 3          # a feature counts as adopted from used_5x on
    min_fit: float = 0.25          # share of the plan's users who adopted it
    very_low_csat: int = 1
    low_adoption: int = 2
    upgrade_adoption: int = 4
    upgrade_max_idle: int = 30
    upgrade_plans: tuple[str, ...] = ("Free", "Pyme")
    managed_plans: tuple[str, ...] = ("Pro", "Plus")
    trial_plans: tuple[str, ...] = ("Free",)
    catalogue: tuple[str, ...] = FEATURES


POINT_TABLE = T.StructType([
    T.StructField("signal", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("points", T.IntegerType()),
    T.StructField("detail", T.StringType()),
    T.StructField("low", T.IntegerType()),
    T.StructField("high", T.IntegerType()),
    T.StructField("equals", T.StringType()),
    T.StructField("per_unit", T.BooleanType()),
])


def load_points(table: DataFrame, **bands: int) -> ScoringRules:
    """Read the point table from a DataFrame, so tuning needs no code."""
    rows = table.select(*POINT_TABLE.names).limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"the point table has more than {MAX_RULES} rows")
    rules = tuple(PointRule(**{**row.asDict(), "per_unit": bool(row.per_unit)}) for row in rows)
    unknown = {rule.metric for rule in rules} - set(METRICS)
    if unknown:
        raise ValueError(f"unknown metrics in the point table: {sorted(unknown)}")
    rules = sorted(rules, key=lambda r: (r.signal, r.low is not None, r.low or 0, r.equals or ""))
    return ScoringRules(tuple(rules), **bands)

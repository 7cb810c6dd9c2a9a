"""Table schemas, value domains and integrity rules of the data model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Fixed values of the data model -------------------------------------------------
COUNTRIES = ("Colombia", "México", "Costa Rica", "Panamá", "República Dominicana")
PLANS = ("Free", "Pyme", "Pro", "Plus")  # from least to most valuable
SOURCES = ("Organic", "Paid", "Referral", "Social", "Partner_Accountant")
FEATURES = (
    "Facturación electrónica",
    "Gestión de contactos",
    "Reportes financieros",
    "Inventario",
    "Nómina",
    "Cotizaciones",
    "Multi-moneda",
    "Punto de venta",
    "Conciliación bancaria",
    "Centro de costos",
)
ADOPTION_LEVELS = ("activated", "used_1x", "used_5x", "used_10x", "power_user")  # 1..5
CATEGORIES = ("Bug", "Feature_Request", "Integration", "Onboarding", "Performance")
PRIORITIES = ("Low", "Medium", "High", "Critical")
CHANNELS = ("Chat", "Email", "Phone", "WhatsApp")
STATUSES = ("Open", "In_Progress", "Resolved", "Closed")
OPEN_STATUSES = ("Open", "In_Progress")
URGENT_PRIORITIES = ("Critical", "High")
RISK_LEVELS = ("bajo", "medio", "alto")
AT_RISK_LEVELS = ("alto", "medio")
URGENCIES = ("inmediata", "esta_semana", "monitoreo")
# ---------------------------------------------------------------------------------


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()
_MONEY, _TS = T.DecimalType(10, 2), T.TimestampNTZType()

USERS = _schema(
    ("user_id", _S), ("country", _S), ("plan", _S), ("signup_date", _D), ("source", _S),
    ("mrr_usd", _MONEY), ("churn_risk_score", T.DecimalType(4, 2)), ("features_count", _I),
)
FEATURE_USAGE = _schema(
    ("user_id", _S), ("feature", _S), ("adoption_level", _S), ("last_used_date", _D),
)
SUPPORT_TICKETS = _schema(
    ("ticket_id", _S), ("user_id", _S), ("category", _S), ("priority", _S), ("channel", _S),
    ("created_date", _D), ("resolved_date", _D), ("status", _S), ("resolution_hours", _I),
    ("csat_score", _I),
)
# Points add up over tickets, and one account may hold very many of them: BIGINT.
CHURN_SCORES = _schema(
    ("user_id", _S), ("score", _L), ("risk_level", _S), ("reasons", _S), ("analyzed_at", _TS),
)
RECOMMENDATIONS = _schema(
    ("user_id", _S), ("risk_level", _S), ("urgency", _S), ("recommendation", _S),
    ("reasoning", _S), ("created_at", _TS),
)
KEY_METRICS = _schema(
    ("total_analyzed", _L), ("high_risk", _L), ("medium_risk", _L), ("low_risk", _L),
    ("immediate_action", _L), ("mrr_at_risk", T.DecimalType(20, 2)),
    ("critical_tickets_open", _L),
)
TOP_CLIENT = _schema(
    ("user_id", _S), ("score", _L), ("plan", _S), ("country", _S), ("mrr_usd", _MONEY),
    ("recommendation", _S),
)
WEEKLY_REPORTS = _schema(
    ("report_date", _D), ("run_id", _S), ("title", _S), ("executive_summary", _S),
    ("key_metrics", KEY_METRICS), ("top_risk_clients", T.ArrayType(TOP_CLIENT)),
    ("action_items", _S), ("generated_by", _S), ("created_at", _TS),
)


@dataclass(frozen=True)
class TableRules:
    """Integrity rules of one table; Spark enforces none, so jobs check them."""

    schema: T.StructType
    required: tuple[str, ...]
    primary_key: str | None = None
    references_users: bool = False
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: dict[str, tuple[str, str]] = field(default_factory=dict)
    id_patterns: dict[str, str] = field(default_factory=dict)


TABLE_RULES = {
    "users": TableRules(
        USERS,
        required=tuple(USERS.names),
        primary_key="user_id",
        domains={"country": COUNTRIES, "plan": PLANS, "source": SOURCES},
        ranges={
            "mrr_usd": ("0", "150"),
            "churn_risk_score": ("0.05", "0.95"),
            "features_count": ("1", "10"),
        },
        id_patterns={"user_id": "^USR-[0-9]+$"},
    ),
    "feature_usage": TableRules(
        FEATURE_USAGE,
        required=tuple(FEATURE_USAGE.names),
        references_users=True,
        domains={"feature": FEATURES, "adoption_level": ADOPTION_LEVELS},
    ),
    "support_tickets": TableRules(
        SUPPORT_TICKETS,
        required=(
            "ticket_id", "user_id", "category", "priority", "channel", "created_date", "status",
        ),
        primary_key="ticket_id",
        references_users=True,
        domains={
            "category": CATEGORIES, "priority": PRIORITIES, "channel": CHANNELS,
            "status": STATUSES,
        },
        ranges={"csat_score": ("1", "5")},
        id_patterns={"ticket_id": "^TKT-[0-9]+$"},
    ),
    "churn_scores": TableRules(
        CHURN_SCORES,
        required=("user_id", "score", "risk_level", "reasons"),
        primary_key="user_id",
        references_users=True,
        domains={"risk_level": RISK_LEVELS},
    ),
    "recommendations": TableRules(
        RECOMMENDATIONS,
        required=("user_id", "risk_level", "urgency", "recommendation", "reasoning"),
        primary_key="user_id",
        references_users=True,
        domains={"risk_level": AT_RISK_LEVELS, "urgency": URGENCIES},
    ),
    "weekly_reports": TableRules(
        WEEKLY_REPORTS,
        required=(
            "report_date", "title", "executive_summary", "key_metrics", "top_risk_clients",
            "action_items", "generated_by",
        ),
    ),
}

"""Check SQL for the named queries, in the checking engine's own dialect.

Each statement is built from shared named subqueries; only the input columns
are common text with the Spark side, every rule is written out again here.
"""

from __future__ import annotations

import datetime as dt
import re

from ..sources import testdata
from ..sources.testdata import AS_OF, columns

EARLIER = AS_OF - dt.timedelta(days=30)
OLDEST = AS_OF - dt.timedelta(days=60)
CTES: dict[str, str] = {}
ORACLE: dict[str, str] = {}


def _select(exprs: dict[str, str]) -> str:
    return "SELECT " + ", ".join(columns(exprs))


CTES["users"] = (
    f"{_select(testdata.USERS)} FROM (SELECT c_custkey, c_nationkey, c_mktsegment FROM customer "
    f"UNION ALL {_select(testdata.SUPPLIER_ACCOUNTS)} FROM supplier) "
    "JOIN nation ON c_nationkey = n_nationkey"
)
CTES["feature_usage"] = (
    f"{_select(testdata.FEATURE_USAGE)} FROM (SELECT o_custkey, p_type, count(*) AS uses, "
    "max(l_shipdate) AS last_use FROM lineitem JOIN part ON l_partkey = p_partkey "
    "JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, p_type)"
)
CTES["support_tickets"] = f"{_select(testdata.SUPPORT_TICKETS)} FROM orders"
CTES["raw_tickets"] = f"{_select(testdata.RAW_TICKETS)} FROM support_tickets"
CTES["bad_users"] = f"{_select(testdata.FAULTY_USERS)} FROM users"
CTES["bad_usage"] = f"{_select(testdata.FAULTY_USAGE)} FROM feature_usage"
CTES["bad_tickets"] = (
    f"{_select(testdata.FAULTY_TICKETS)} FROM (SELECT * FROM support_tickets UNION ALL "
    f"SELECT * FROM support_tickets WHERE {testdata.REPEATED_TICKETS})"
)
CTES["usage_rank"] = """
SELECT *, CAST(list_position(['activated', 'used_1x', 'used_5x', 'used_10x', 'power_user'],
                             adoption_level) AS INTEGER) AS adoption_rank
FROM feature_usage"""
CTES["usage_agg"] = """
SELECT user_id, max(last_used_date) AS last_activity,
       min(adoption_rank) AS worst_adoption_level, max(adoption_rank) AS best_adoption_level,
       list_sort(list_distinct(list(feature))) AS features,
       list_sort(list_distinct(coalesce(list(feature) FILTER (adoption_rank >= 3), [])))
           AS adopted
FROM usage_rank GROUP BY user_id"""
_TICKET_AGG = """
SELECT user_id, count(DISTINCT ticket_id) AS total_tickets,
       count(DISTINCT ticket_id) FILTER (open) AS open_tickets,
       count(DISTINCT ticket_id) FILTER (open AND priority IN ('Critical', 'High'))
           AS critical_open_tickets,
       count(DISTINCT ticket_id) FILTER (open AND priority = 'Critical') AS open_critical,
       count(DISTINCT ticket_id) FILTER (open AND priority = 'High') AS open_high,
       count(DISTINCT ticket_id) FILTER (open AND priority IN ('Low', 'Medium')) AS open_other,
       min(csat_score) AS worst_csat, round(avg(csat_score), 1) AS avg_csat,
       array_to_string(list_sort(list_distinct(list(category))), ', ') AS ticket_categories
FROM (SELECT *, status IN ('Open', 'In_Progress') AS open FROM {tickets})
GROUP BY user_id"""
CTES["ticket_agg"] = _TICKET_AGG.format(tickets="support_tickets")
CTES["bad_ticket_agg"] = _TICKET_AGG.format(tickets="bad_tickets")


def _scored_ctes(suffix: str, as_of: dt.date) -> None:
    CTES[f"facts{suffix}"] = f"""
SELECT u.user_id, country, plan, signup_date, source, mrr_usd,
       churn_risk_score AS original_churn_score, features_count, last_activity,
       CAST(DATE '{as_of}' - last_activity AS INTEGER) AS days_since_last_activity,
       worst_adoption_level, best_adoption_level,
       array_to_string(features, ', ') AS features_list,
       coalesce(features, []) AS features, coalesce(adopted, []) AS adopted,
       coalesce(total_tickets, 0) AS total_tickets, coalesce(open_tickets, 0) AS open_tickets,
       coalesce(critical_open_tickets, 0) AS critical_open_tickets,
       worst_csat, avg_csat, ticket_categories,
       coalesce(open_critical, 0) AS open_critical, coalesce(open_high, 0) AS open_high,
       coalesce(open_other, 0) AS open_other
FROM users u LEFT JOIN usage_agg f ON f.user_id = u.user_id
LEFT JOIN ticket_agg t ON t.user_id = u.user_id"""
    CTES[f"points{suffix}"] = f"""
SELECT *,
       CASE WHEN days_since_last_activity > 90 THEN 40 WHEN days_since_last_activity > 60 THEN 30
            WHEN days_since_last_activity > 30 THEN 15 ELSE 0 END AS p_idle,
       CASE worst_adoption_level WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END AS p_adoption,
       25 * open_critical AS p_critical, 15 * open_high AS p_high, 5 * open_other AS p_other,
       CASE worst_csat WHEN 1 THEN 25 WHEN 2 THEN 15 ELSE 0 END AS p_csat,
       CASE WHEN plan = 'Free' THEN 10 ELSE 0 END AS p_plan,
       CASE WHEN total_tickets >= 4 THEN 10 ELSE 0 END AS p_volume
FROM facts{suffix}"""
    CTES[f"scored{suffix}"] = f"""
SELECT *, CASE WHEN score <= 25 THEN 'bajo' WHEN score <= 50 THEN 'medio' ELSE 'alto' END
           AS risk_level,
       concat_ws(', ',
         CASE WHEN p_idle > 0 THEN concat('Inactividad de ', days_since_last_activity,
                                          ' días (+', p_idle, ')') END,
         CASE WHEN p_adoption = 10 THEN 'adopción mínima activated (+10)'
              WHEN p_adoption = 5 THEN 'adopción mínima used_1x (+5)' END,
         CASE WHEN open_critical > 0
              THEN concat(open_critical, ' tickets abiertos critical (+', p_critical, ')') END,
         CASE WHEN open_high > 0
              THEN concat(open_high, ' tickets abiertos high (+', p_high, ')') END,
         CASE WHEN open_other > 0
              THEN concat(open_other, ' tickets abiertos medium/low (+', p_other, ')') END,
         CASE WHEN p_csat > 0 THEN concat('CSAT peor = ', worst_csat, ' (+', p_csat, ')') END,
         CASE WHEN p_plan > 0 THEN 'plan Free (+10)' END,
         CASE WHEN p_volume > 0 THEN concat(total_tickets, ' tickets en total (+10)') END
       ) AS reasons
FROM (SELECT *, CAST(p_idle + p_adoption + p_critical + p_high + p_other + p_csat + p_plan
                     + p_volume AS BIGINT) AS score FROM points{suffix})"""


_scored_ctes("", AS_OF)
_scored_ctes("_old", EARLIER)
_scored_ctes("_older", OLDEST)

CTES["catalogue"] = """
SELECT unnest(['Facturación electrónica', 'Gestión de contactos', 'Reportes financieros',
               'Inventario', 'Nómina', 'Cotizaciones', 'Multi-moneda', 'Punto de venta',
               'Conciliación bancaria', 'Centro de costos']) AS feature"""
CTES["fit"] = """
SELECT plan, feature, adopters / plan_users AS rate
FROM (SELECT plan, feature, count(*) AS adopters
      FROM (SELECT user_id, plan, unnest(adopted) AS feature FROM facts)
      GROUP BY plan, feature)
JOIN (SELECT plan, count(*) AS plan_users FROM facts GROUP BY plan) USING (plan)
WHERE adopters >= 0.25 * plan_users AND feature IN (SELECT feature FROM catalogue)"""
CTES["gap_ranked"] = """
SELECT user_id, f.plan, fit.feature, rate,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY rate DESC, fit.feature) AS INTEGER)
           AS position
FROM facts f JOIN fit ON f.plan = fit.plan AND NOT list_contains(f.features, fit.feature)"""
CTES["offers"] = """
SELECT user_id, array_to_string(list(feature ORDER BY position), ', ') AS offer
FROM gap_ranked GROUP BY user_id"""
_URGENCY = """
CASE WHEN risk_level = 'bajo' THEN NULL
     WHEN risk_level = 'alto' AND (critical_open_tickets > 0 OR coalesce(worst_csat, 9) = 1)
          THEN 'inmediata'
     WHEN risk_level = 'medio' AND critical_open_tickets = 0 AND coalesce(worst_csat, 9) > 1
          THEN 'monitoreo'
     ELSE 'esta_semana' END"""


def _advised_ctes(suffix: str) -> None:
    CTES[f"urgent{suffix}"] = f"SELECT *, {_URGENCY} AS urgency FROM scored{suffix}"


_advised_ctes("")
_advised_ctes("_old")
CTES["actions"] = """
SELECT *, risk_level = 'alto' AS is_high, coalesce(worst_adoption_level, 9) <= 2 AS is_low,
       plan IN ('Free', 'Pyme') AND coalesce(best_adoption_level, 0) >= 4
           AND coalesce(days_since_last_activity, 999) <= 30 AS can_upgrade
FROM urgent WHERE risk_level <> 'bajo'"""
CTES["recs"] = """
SELECT a.user_id, risk_level, urgency, score, plan, country, mrr_usd,
       concat(CASE urgency WHEN 'inmediata' THEN 'Actuar hoy'
                           WHEN 'esta_semana' THEN 'Actuar en los próximos 5 días'
                           ELSE 'Revisar en el próximo ciclo semanal' END,
              CASE WHEN body = '' THEN '' ELSE ': ' || body END) AS recommendation,
       concat('Riesgo ', risk_level, ' con ', score, ' puntos: ', reasons, '. Plan ', plan,
              ', MRR ', mrr_usd, ' USD.') AS reasoning
FROM (SELECT x.*, concat_ws('; ',
        CASE WHEN open_critical > 0
             THEN concat('escalar ', open_critical, ' tickets critical a ingeniería') END,
        CASE WHEN is_high THEN 'contacto proactivo por llamada, email o WhatsApp' END,
        CASE WHEN is_low THEN concat('sesión de onboarding para ',
             coalesce(nullif(array_to_string(list_filter(features,
                 lambda f: NOT list_contains(adopted, f)), ', '), ''),
                 'las features sin adoptar')) END,
        CASE WHEN can_upgrade
             THEN concat('oferta de upgrade con ', coalesce(offer, 'un plan superior')) END,
        CASE WHEN is_high AND plan IN ('Pro', 'Plus')
             THEN 'asignar account manager dedicado' END,
        CASE WHEN NOT is_high AND is_low
             THEN 'invitar a webinar o capacitación grupal' END,
        CASE WHEN plan = 'Free' THEN 'descuento o extensión de trial' END,
        CASE WHEN open_tickets > 0
             THEN concat('dar seguimiento a ', open_tickets, ' tickets abiertos') END,
        CASE WHEN offer IS NOT NULL THEN 'mostrar ' || offer END) AS body
      FROM actions x LEFT JOIN offers o ON o.user_id = x.user_id) a"""
CTES["alert_rows"] = """
SELECT user_id, score, risk_level, urgency, country, plan, mrr_usd,
       CASE WHEN length(recommendation) > 80 THEN substr(recommendation, 1, 80) || '…'
            ELSE recommendation END AS recommendation_short
FROM recs"""
CTES["top10"] = """
SELECT s.user_id, s.score, s.risk_level, reasons, s.plan, s.country, s.mrr_usd, r.urgency,
       recommendation
FROM scored s LEFT JOIN recs r ON r.user_id = s.user_id
ORDER BY s.score DESC, s.user_id LIMIT 10"""


def _key_ctes(suffix: str) -> None:
    CTES[f"key_metrics{suffix}"] = f"""
SELECT count(*) AS total_analyzed, count(*) FILTER (risk_level = 'alto') AS high_risk,
       count(*) FILTER (risk_level = 'medio') AS medium_risk,
       count(*) FILTER (risk_level = 'bajo') AS low_risk,
       count(*) FILTER (urgency = 'inmediata') AS immediate_action,
       CAST(coalesce(sum(mrr_usd) FILTER (risk_level <> 'bajo'), 0) AS DECIMAL(20,2))
           AS mrr_at_risk,
       (SELECT count(*) FROM support_tickets
        WHERE resolved_date IS NULL AND priority = 'Critical') AS critical_tickets_open
FROM urgent{suffix}"""
    day = AS_OF if suffix == "" else EARLIER
    CTES[f"weekly{suffix}"] = f"""
SELECT DATE '{day}' AS report_date, 'weekly' AS run_id,
       concat('Reporte Semanal — ', high_risk, ' clientes en riesgo alto') AS title,
       concat(total_analyzed, ' clientes analizados: ', high_risk, ' alto, ', medium_risk,
              ' medio, ', low_risk, ' bajo. MRR en riesgo: ', mrr_at_risk, ' USD.')
           AS executive_summary,
       k.*,
       (SELECT array_to_string(list(user_id ORDER BY score DESC, user_id), ',')
        FROM (SELECT user_id, score FROM scored{suffix} ORDER BY score DESC, user_id LIMIT 10))
           AS top_users,
       concat('1. Contactar hoy a ', immediate_action, ' clientes', chr(10), '2. Resolver ',
              critical_tickets_open, ' tickets critical abiertos', chr(10), '3. Revisar ',
              medium_risk, ' clientes en riesgo medio') AS action_items,
       'rules' AS generated_by
FROM key_metrics{suffix} k"""


_key_ctes("")
_key_ctes("_old")
CTES["batches"] = """
SELECT *, (row_number() OVER (PARTITION BY bucket ORDER BY user_id) - 1) // 20 AS batch_no
FROM (SELECT *, CAST(('0x' || substr(md5(user_id), 1, 7)) AS BIGINT)
                % (SELECT CAST(greatest(1, ceil(count(*) / 10000)) AS BIGINT) FROM scored) AS bucket
      FROM scored)"""
CTES["scoring_elements"] = """
SELECT format('{:04d}-{:06d}', bucket, batch_no) AS reply_id,
       CAST(row_number() OVER (PARTITION BY bucket, batch_no ORDER BY user_id) - 1 AS INTEGER)
           AS position,
       user_id, score, CASE WHEN score = 35 THEN 'alto' ELSE risk_level END AS risk_level,
       CASE WHEN score <> 50 THEN reasons END AS reasons
FROM batches"""
CTES["recommendation_elements"] = """
SELECT concat(user_id, '-', copy) AS reply_id, copy, style,
       CASE WHEN style = 1 AND risk_level = 'alto' THEN 'X' || user_id ELSE user_id END
           AS user_id,
       risk_level, urgency, recommendation, reasoning
FROM (SELECT *, CAST(right(user_id, 1) AS INTEGER) AS style FROM recs)
CROSS JOIN (SELECT unnest([1, 2]) AS copy) WHERE copy = 1 OR style = 2"""
_DIFFERENT_LEVEL = """
risk_level <> CASE WHEN score <= 25 THEN 'bajo' WHEN score <= 50 THEN 'medio' ELSE 'alto' END"""


def _statement(final: str) -> str:
    """The final SELECT behind the subqueries it needs, in order of definition."""
    needed: set[str] = set()
    todo = [final]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & CTES.keys() - needed:
            needed.add(name)
            todo.append(CTES[name])
    parts = [f"{name} AS ({body.strip()})" for name, body in CTES.items() if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + final.strip()


def check(name: str, final: str, *amounts: str) -> None:
    """Amounts are compared as DOUBLE on both sides."""
    statement = _statement(final)
    if amounts:
        casts = ", ".join(f"CAST({a} AS DOUBLE) AS {a}" for a in amounts)
        statement = f"SELECT * REPLACE ({casts}) FROM ({statement})"
    ORACLE[name] = statement


# Sources and ingest
check("load_users", "SELECT * FROM users", "mrr_usd", "churn_risk_score")
check("load_feature_usage", "SELECT * FROM feature_usage")
check("load_support_tickets", "SELECT * FROM support_tickets")
_CLEAN = """
SELECT nullif(trim(ticket_id), '') AS ticket_id, nullif(trim(user_id), '') AS user_id, category,
       priority, channel, TRY_CAST(created_date AS DATE) AS created_date,
       TRY_CAST(nullif(trim(resolved_date), '') AS DATE) AS resolved_date, status,
       TRY_CAST(nullif(trim(resolution_hours), '') AS INTEGER) AS resolution_hours,
       TRY_CAST(nullif(trim(csat_score), '') AS INTEGER) AS csat_score
FROM raw_tickets"""
check("clean_ticket_blanks", _CLEAN)
CTES["rejected"] = """
SELECT 'support_tickets' AS table_name, ticket_id AS row_key, 'user_id' AS column_name,
       user_id AS raw_value, 'missing' AS reason
FROM raw_tickets WHERE trim(user_id) = ''
UNION ALL
SELECT 'support_tickets', ticket_id, 'resolved_date', resolved_date, 'bad_value'
FROM raw_tickets WHERE resolved_date = 'pendiente'
UNION ALL
SELECT 'support_tickets', ticket_id, 'created_date', created_date, 'bad_value'
FROM raw_tickets WHERE length(created_date) < 10
UNION ALL
SELECT 'support_tickets', ticket_id, 'csat_score', csat_score, 'bad_value'
FROM raw_tickets WHERE csat_score = 'n/a'"""
check("ingest_rejects", "SELECT * FROM rejected")
_COLUMNS = list(testdata.SUPPORT_TICKETS)
CTES["accepted"] = f"""{_CLEAN}
WHERE trim(user_id) <> '' AND resolved_date <> 'pendiente' AND csat_score <> 'n/a'
AND length(created_date) = 10"""
check("ingest_profile", f"""
SELECT p.*, (SELECT count(*) FROM rejected r WHERE r.column_name = p.column_name) AS rejected
FROM ({' UNION ALL '.join(
    f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, "
    f"count(DISTINCT {c}) AS distinct_values, CAST(min({c}) AS VARCHAR) AS min_value, "
    f"CAST(max({c}) AS VARCHAR) AS max_value FROM accepted" for c in _COLUMNS)}) p""")
CTES["raw_bad"] = f"{_select(testdata.RAW_TICKETS)} FROM bad_tickets"
CTES["raw_ok"] = """
SELECT * FROM raw_bad WHERE trim(user_id) <> '' AND resolved_date <> 'pendiente'
AND csat_score <> 'n/a' AND status IS NOT NULL AND length(created_date) = 10"""
check("load_all_rejects", """
SELECT 'support_tickets' AS table_name, ticket_id AS row_key, 'user_id' AS column_name,
       'missing' AS reason FROM raw_bad WHERE trim(user_id) = ''
UNION ALL SELECT 'support_tickets', ticket_id, 'status', 'missing' FROM raw_bad
WHERE status IS NULL
UNION ALL SELECT 'support_tickets', ticket_id, 'resolved_date', 'bad_value' FROM raw_bad
WHERE resolved_date = 'pendiente'
UNION ALL SELECT 'support_tickets', ticket_id, 'csat_score', 'bad_value' FROM raw_bad
WHERE csat_score = 'n/a'
UNION ALL SELECT 'support_tickets', ticket_id, 'created_date', 'bad_value' FROM raw_bad
WHERE length(created_date) < 10
UNION ALL SELECT 'users', user_id, 'user_id', 'duplicate_key' FROM users WHERE plan = 'Plus'
UNION ALL SELECT 'support_tickets', ticket_id, 'ticket_id', 'duplicate_key' FROM raw_ok
GROUP BY ticket_id HAVING count(*) > 1
UNION ALL SELECT DISTINCT 'support_tickets', ticket_id, 'user_id', 'unknown_user' FROM raw_ok
WHERE user_id NOT IN (SELECT user_id FROM users)
UNION ALL SELECT 'users', '', '*', concat('loaded ', count(*)) FROM users
UNION ALL SELECT 'feature_usage', '', '*', concat('loaded ', count(*)) FROM feature_usage
UNION ALL SELECT 'support_tickets', '', '*', concat('loaded ', count(DISTINCT ticket_id))
FROM raw_ok WHERE user_id IN (SELECT user_id FROM users)""")

check("load_twice_rejects", """
SELECT 'users' AS table_name, user_id AS row_key, 'user_id' AS column_name, 'loaded_before' AS reason
FROM users WHERE plan <> 'Free'
UNION ALL SELECT 'support_tickets', ticket_id, 'ticket_id', 'loaded_before' FROM support_tickets
WHERE created_date < DATE '1998-01-01'
UNION ALL SELECT 'users', 'first', '*', concat('loaded ', count(*)) FROM users
UNION ALL SELECT 'users', 'second', '*', 'loaded 0'
UNION ALL SELECT 'feature_usage', unnest(['first', 'second']), '*', concat('loaded ', count(*)) FROM feature_usage
UNION ALL SELECT 'support_tickets', 'first', '*', concat('loaded ', count(*)) FROM support_tickets
WHERE created_date < DATE '1998-01-01'
UNION ALL SELECT 'support_tickets', 'second', '*', concat('loaded ', count(*)) FROM support_tickets
WHERE created_date >= DATE '1998-01-01'""")

# Integrity rules
check("dq_duplicate_keys", """
SELECT 'users' AS table_name, user_id AS key_value, count(*) AS n FROM bad_users
GROUP BY user_id HAVING count(*) > 1
UNION ALL SELECT 'support_tickets', ticket_id, count(*) FROM bad_tickets
GROUP BY ticket_id HAVING count(*) > 1
UNION ALL SELECT 'churn_scores', user_id, count(*) FROM scored
GROUP BY user_id HAVING count(*) > 1
UNION ALL SELECT 'recommendations', user_id, count(*) FROM recs
GROUP BY user_id HAVING count(*) > 1""")
check("dq_orphans", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, user_id, count(*) AS n FROM {cte} "
    "WHERE user_id NOT IN (SELECT user_id FROM bad_users) GROUP BY user_id"
    for name, cte in (("feature_usage", "bad_usage"), ("support_tickets", "bad_tickets"),
                      ("churn_scores", "scored"), ("recommendations", "recs"))))
_REQUIRED = {
    "users": ("bad_users", list(testdata.USERS)),
    "feature_usage": ("bad_usage", list(testdata.FEATURE_USAGE)),
    "support_tickets": ("bad_tickets", ["ticket_id", "user_id", "category", "priority",
                                        "channel", "created_date", "status"]),
    "churn_scores": ("scored", ["user_id", "score", "risk_level", "reasons"]),
    "recommendations": ("recs", ["user_id", "risk_level", "urgency", "recommendation",
                                 "reasoning"]),
}
check("dq_null_counts", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
    f"count(*) FILTER ({c} IS NULL) AS nulls FROM {cte}"
    for name, (cte, names) in _REQUIRED.items() for c in names
) + "".join(
    f" UNION ALL SELECT 'weekly_reports', '{c}', count(*) FILTER ({sql} IS NULL) FROM weekly"
    for c, sql in {
        "report_date": "report_date", "title": "title", "executive_summary": "executive_summary",
        "key_metrics": "total_analyzed", "top_risk_clients": "top_users",
        "action_items": "action_items", "generated_by": "generated_by",
    }.items()))


def _bad_values(table: str, cte: str, column: str, condition: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
        f"CAST({column} AS VARCHAR) AS value, count(*) AS n FROM {cte} "
        f"WHERE {condition} GROUP BY {column}"
    )


check("dq_domain_violations", " UNION ALL ".join([
    _bad_values("users", "bad_users", "country", "country NOT IN ('Colombia', 'México', "
                "'Costa Rica', 'Panamá', 'República Dominicana')"),
    _bad_values("users", "bad_users", "plan", "plan NOT IN ('Free', 'Pyme', 'Pro', 'Plus')"),
    _bad_values("users", "bad_users", "source", "source NOT IN ('Organic', 'Paid', 'Referral', "
                "'Social', 'Partner_Accountant')"),
    _bad_values("feature_usage", "bad_usage", "feature",
                "feature NOT IN (SELECT feature FROM catalogue)"),
    _bad_values("feature_usage", "bad_usage", "adoption_level", "adoption_level NOT IN "
                "('activated', 'used_1x', 'used_5x', 'used_10x', 'power_user')"),
    _bad_values("support_tickets", "bad_tickets", "category", "category NOT IN ('Bug', "
                "'Feature_Request', 'Integration', 'Onboarding', 'Performance')"),
    _bad_values("support_tickets", "bad_tickets", "priority",
                "priority NOT IN ('Low', 'Medium', 'High', 'Critical')"),
    _bad_values("support_tickets", "bad_tickets", "channel",
                "channel NOT IN ('Chat', 'Email', 'Phone', 'WhatsApp')"),
    _bad_values("support_tickets", "bad_tickets", "status",
                "status NOT IN ('Open', 'In_Progress', 'Resolved', 'Closed')"),
    _bad_values("churn_scores", "scored", "risk_level",
                "risk_level NOT IN ('bajo', 'medio', 'alto')"),
    _bad_values("recommendations", "recs", "risk_level", "risk_level NOT IN ('medio', 'alto')"),
    _bad_values("recommendations", "recs", "urgency",
                "urgency NOT IN ('inmediata', 'esta_semana', 'monitoreo')"),
]))
check("dq_range_violations", " UNION ALL ".join([
    _bad_values("users", "bad_users", "mrr_usd", "mrr_usd < 0 OR mrr_usd > 150"),
    _bad_values("users", "bad_users", "churn_risk_score",
                "churn_risk_score < 0.05 OR churn_risk_score > 0.95"),
    _bad_values("users", "bad_users", "features_count",
                "features_count < 1 OR features_count > 10"),
    _bad_values("support_tickets", "bad_tickets", "csat_score",
                "csat_score < 1 OR csat_score > 5"),
]))
check("dq_id_format", " UNION ALL ".join([
    _bad_values("users", "bad_users", "user_id",
                "NOT regexp_full_match(user_id, 'USR-[0-9]+')"),
    _bad_values("support_tickets", "bad_tickets", "ticket_id",
                "NOT regexp_full_match(ticket_id, 'TKT-[0-9]+')"),
]))
check("dq_free_plan_mrr", """
SELECT user_id, plan, mrr_usd FROM bad_users WHERE plan = 'Free' AND mrr_usd <> 0""", "mrr_usd")
check("dq_ticket_lifecycle", """
SELECT ticket_id, status, resolved_date, resolution_hours, csat_score FROM bad_tickets
WHERE status IN ('Open', 'In_Progress')
  AND coalesce(CAST(resolved_date AS VARCHAR), CAST(resolution_hours AS VARCHAR),
               CAST(csat_score AS VARCHAR)) IS NOT NULL""")

# Projections, joins, per-user aggregates
check("user_profile", """
SELECT * EXCLUDE (churn_risk_score), churn_risk_score AS original_churn_score FROM users""", "mrr_usd", "original_churn_score")
check("adoption_ordinal", """
SELECT user_id, feature, adoption_level,
       CAST(list_position(['activated', 'used_1x', 'used_5x', 'used_10x', 'power_user'],
                          adoption_level) AS INTEGER) AS adoption_rank
FROM bad_usage""")
check("open_tickets", "SELECT * FROM support_tickets WHERE status IN ('Open', 'In_Progress')")
check("urgent_open_tickets", """
SELECT * FROM support_tickets
WHERE status IN ('Open', 'In_Progress') AND priority IN ('Critical', 'High')""")
check("users_features_left", """
SELECT u.*, f.* EXCLUDE (user_id) FROM users u LEFT JOIN feature_usage f
ON f.user_id = u.user_id""", "mrr_usd", "churn_risk_score")
check("users_tickets_left", """
SELECT u.*, t.* EXCLUDE (user_id) FROM users u LEFT JOIN support_tickets t
ON t.user_id = u.user_id""", "mrr_usd", "churn_risk_score")
check("user_summary", "SELECT * EXCLUDE (last_activity, features, adopted) FROM facts", "mrr_usd", "original_churn_score")
check("user_inactivity", """
SELECT user_id, last_activity, days_since_last_activity FROM facts
WHERE last_activity IS NOT NULL""")
check("user_adoption_range", """
SELECT user_id, worst_adoption_level, best_adoption_level FROM usage_agg""")
check("user_features_list", """
SELECT user_id, array_to_string(list_sort(list_distinct(list(feature))), ', ') AS features_list
FROM bad_usage GROUP BY user_id""")
check("user_ticket_categories", "SELECT user_id, ticket_categories FROM facts")
check("user_ticket_counts", """
SELECT user_id, total_tickets, open_tickets, critical_open_tickets, open_critical, open_high,
       open_other FROM facts""")
check("user_csat", "SELECT user_id, worst_csat, avg_csat FROM ticket_agg")

# Scoring
for _name, _points in {
    "score_inactivity": "CAST(p_idle AS BIGINT) AS points_inactividad",
    "score_adoption": "CAST(p_adoption AS BIGINT) AS points_adopcion",
    "score_open_tickets": "p_critical AS points_tickets_criticos, "
                          "p_high AS points_tickets_altos, p_other AS points_tickets_otros",
    "score_csat": "CAST(p_csat AS BIGINT) AS points_csat",
    "score_plan": "CAST(p_plan AS BIGINT) AS points_plan",
    "score_ticket_volume": "CAST(p_volume AS BIGINT) AS points_volumen_tickets",
}.items():
    check(_name, f"SELECT user_id, {_points} FROM points")
check("churn_scores", "SELECT user_id, score, risk_level FROM scored")
CTES["reason_rows"] = " UNION ALL ".join(
    f"SELECT user_id, '{signal}' AS signal, {detail} AS detail, CAST({points} AS BIGINT) "
    f"AS points FROM points WHERE {points} > 0"
    for signal, detail, points in (
        ("inactividad", "concat('Inactividad de ', days_since_last_activity, ' días')", "p_idle"),
        ("adopcion", "'adopción mínima ' || CASE p_adoption WHEN 10 THEN 'activated' "
                     "ELSE 'used_1x' END", "p_adoption"),
        ("tickets_criticos", "concat(open_critical, ' tickets abiertos critical')",
         "p_critical"),
        ("tickets_altos", "concat(open_high, ' tickets abiertos high')", "p_high"),
        ("tickets_otros", "concat(open_other, ' tickets abiertos medium/low')", "p_other"),
        ("csat", "concat('CSAT peor = ', worst_csat)", "p_csat"),
        ("plan", "'plan Free'", "p_plan"),
        ("volumen_tickets", "concat(total_tickets, ' tickets en total')", "p_volume"),
    ))
check("churn_reasons", "SELECT * FROM reason_rows")
check("churn_reasons_text", "SELECT user_id, score, risk_level, reasons FROM scored")
check("churn_detail", f"""
SELECT user_id, score, risk_level, reasons, '{AS_OF} 00:00:00' AS analyzed_at, country, plan,
       signup_date, source, mrr_usd, features_count, days_since_last_activity,
       worst_adoption_level, best_adoption_level, features_list, total_tickets, open_tickets,
       critical_open_tickets, worst_csat, avg_csat, ticket_categories
FROM scored WHERE risk_level <> 'bajo'""", "mrr_usd")
check("risk_factor_counts", """
SELECT signal, count(*) AS users, count(*) / (SELECT count(*) FROM users) AS share
FROM reason_rows GROUP BY signal""")

# Recommendations and alerts
check("recommendation_urgency", """
SELECT user_id, risk_level, urgency FROM urgent WHERE risk_level <> 'bajo'""")
check("recommendation_actions", " UNION ALL ".join(
    f"SELECT user_id, '{kind}' AS action FROM actions WHERE {condition}"
    for kind, condition in (
        ("escalamiento", "open_critical > 0"),
        ("contacto_proactivo", "is_high"),
        ("onboarding", "is_low"),
        ("oferta_upgrade", "can_upgrade"),
        ("account_manager", "is_high AND plan IN ('Pro', 'Plus')"),
        ("capacitacion_grupal", "risk_level = 'medio' AND is_low"),
        ("descuento_trial", "plan = 'Free'"),
    )))
check("feature_gap", """
SELECT user_id, unnest(list_filter((SELECT list(feature) FROM catalogue),
                                   lambda c: NOT list_contains(features, c))) AS feature
FROM facts""")
check("feature_gap_ranked", "SELECT * FROM gap_ranked")
check("recommendations", """
SELECT user_id, risk_level, urgency, recommendation, reasoning FROM recs""")
check("alert_queue", """
SELECT user_id, score, risk_level, urgency, plan, mrr_usd, recommendation FROM recs
WHERE urgency = 'inmediata'""", "mrr_usd")
check("alert_digest", """
SELECT count(*) AS total, count(*) FILTER (risk_level = 'bajo') AS bajo,
       count(*) FILTER (risk_level = 'medio') AS medio,
       count(*) FILTER (risk_level = 'alto') AS alto,
       'lunes, 5 de noviembre de 2001' AS date_text,
       concat('Se identificaron ', count(*), ' cliente', CASE WHEN count(*) > 1 THEN 's' ELSE ''
              END, ' que requieren contacto inmediato') AS headline
FROM recs WHERE urgency = 'inmediata' HAVING count(*) > 0""")
check("alerts_table", "SELECT * FROM alert_rows", "mrr_usd")
check("alerts_filtered", """
SELECT * FROM alert_rows WHERE risk_level = 'alto' AND urgency = 'esta_semana'
AND country = 'México' AND plan = 'Free'""", "mrr_usd")
check("alerts_search", "SELECT * FROM alert_rows WHERE user_id LIKE '%104%'", "mrr_usd")

# Report and dashboard
check("risk_distribution", "SELECT risk_level, count(*) AS cnt FROM scored GROUP BY risk_level")
check("urgency_distribution", "SELECT urgency, count(*) AS cnt FROM recs GROUP BY urgency")
check("risk_by_plan", """
SELECT plan, risk_level, count(*) AS cnt FROM scored GROUP BY plan, risk_level""")
check("risk_by_country", """
SELECT country, risk_level, count(*) AS cnt FROM scored GROUP BY country, risk_level""")
check("avg_score_by_plan", """
SELECT plan, round(avg(score), 1) AS avg_score, count(*) AS total FROM scored GROUP BY plan""")
check("mrr_at_risk", "SELECT mrr_at_risk FROM key_metrics", "mrr_at_risk")
check("report_rollup", """
SELECT CASE GROUPING(plan, country, risk_level, urgency)
            WHEN 15 THEN 'total' WHEN 13 THEN 'risk' WHEN 14 THEN 'urgency' WHEN 7 THEN 'plan'
            WHEN 5 THEN 'plan_risk' WHEN 9 THEN 'country_risk' END AS grouping,
       plan, country, risk_level, urgency, count(*) AS cnt, round(avg(score), 1) AS avg_score,
       CAST(coalesce(sum(mrr_usd) FILTER (level <> 'bajo'), 0) AS DECIMAL(20,2)) AS mrr_at_risk
FROM (SELECT *, risk_level AS level FROM urgent)
GROUP BY GROUPING SETS ((), (risk_level), (urgency), (plan), (plan, risk_level),
                        (country, risk_level))""", "mrr_at_risk")
check("open_tickets_summary", """
SELECT count(*) AS total_open, count(*) FILTER (priority = 'Critical') AS critical_open,
       count(*) FILTER (priority = 'High') AS high_open
FROM support_tickets WHERE status IN ('Open', 'In_Progress')""")
check("top_risk_clients", "SELECT * FROM top10", "mrr_usd")
check("report_metrics", """
SELECT (SELECT count(*) FROM scored) AS total_users,
  (SELECT string_agg(concat(risk_level, ':', c), ',' ORDER BY risk_level)
   FROM (SELECT risk_level, count(*) AS c FROM scored GROUP BY 1)) AS risk_distribution,
  (SELECT string_agg(concat(urgency, ':', c), ',' ORDER BY urgency)
   FROM (SELECT urgency, count(*) AS c FROM recs GROUP BY 1)) AS urgency_distribution,
  (SELECT string_agg(concat(plan, ':', risk_level, ':', c), ',' ORDER BY plan, risk_level)
   FROM (SELECT plan, risk_level, count(*) AS c FROM scored GROUP BY 1, 2)) AS risk_by_plan,
  (SELECT string_agg(concat(country, ':', risk_level, ':', c), ',' ORDER BY country, risk_level)
   FROM (SELECT country, risk_level, count(*) AS c FROM scored GROUP BY 1, 2))
      AS risk_by_country,
  (SELECT string_agg(concat(plan, ':', a, ':', c), ',' ORDER BY a DESC, plan)
   FROM (SELECT plan, round(avg(score), 1) AS a, count(*) AS c FROM scored GROUP BY 1))
      AS avg_score_by_plan,
  (SELECT string_agg(concat_ws(':', user_id, score, urgency), ',' ORDER BY score DESC, user_id)
   FROM top10) AS top_10_risk_clients,
  (SELECT mrr_at_risk FROM key_metrics) AS total_mrr_at_risk, o.*
FROM (SELECT count(*) AS total_open, count(*) FILTER (priority = 'Critical') AS critical_open,
             count(*) FILTER (priority = 'High') AS high_open
      FROM support_tickets WHERE resolved_date IS NULL) o""", "total_mrr_at_risk")
check("report_key_metrics", "SELECT * FROM key_metrics", "mrr_at_risk")
check("dashboard_kpis", """
SELECT total_analyzed, high_risk, medium_risk, immediate_action FROM key_metrics""")
check("weekly_report", "SELECT * FROM weekly", "mrr_at_risk")
check("report_history", """
SELECT * FROM weekly UNION ALL SELECT * REPLACE ('extra' AS run_id) FROM weekly
UNION ALL SELECT * FROM weekly_old""", "mrr_at_risk")
check("user_detail_features", f"""
SELECT user_id, feature, adoption_level, adoption_rank,
       CAST(DATE '{AS_OF}' - last_used_date AS INTEGER) AS days_since_use FROM usage_rank""")
check("user_detail_tickets", """
SELECT u.user_id, country, plan, ticket_id, category, priority, status, created_date, csat_score
FROM users u JOIN support_tickets t ON t.user_id = u.user_id""")
check("user_360", f"""
SELECT s.user_id, CAST(page AS BIGINT) AS page, country, plan, mrr_usd, score, risk_level,
  reasons, total_tickets, pages,
  coalesce((SELECT string_agg(concat_ws(':', feature, adoption_level,
      DATE '{AS_OF}' - last_used_date), ',' ORDER BY feature)
    FROM feature_usage f WHERE f.user_id = s.user_id
    AND CAST(('0x' || substr(md5(concat_ws('|', feature, adoption_level, DATE '{AS_OF}' - last_used_date)), 1, 7)) AS BIGINT) % s.pages = page), '') AS features,
  coalesce((SELECT string_agg(concat_ws(':', ticket_id, category, priority, status, created_date,
      csat_score), ',' ORDER BY ticket_id)
    FROM support_tickets t WHERE t.user_id = s.user_id
    AND CAST(('0x' || substr(md5(ticket_id), 1, 7)) AS BIGINT) % s.pages = page), '') AS tickets
FROM (SELECT *, unnest(range(pages)) AS page
      FROM (SELECT *, CAST(greatest(1, ceil(total_tickets / 4), ceil(len(features) / 4))
                           AS BIGINT) AS pages
            FROM scored)) s""", "mrr_usd")

# Hand-off, replies, result tables
check("agent_batches", "SELECT user_id, score, risk_level, bucket, batch_no FROM batches")
check("agent_payloads", """
SELECT bucket, batch_no, count(*) AS users,
  string_agg(CAST(json_object('user_id', user_id, 'country', country, 'plan', plan,
    'days_since_last_activity', days_since_last_activity,
    'worst_adoption_level', worst_adoption_level, 'features_list', features_list,
    'total_tickets', total_tickets, 'open_tickets', open_tickets,
    'critical_open_tickets', critical_open_tickets, 'worst_csat', worst_csat,
    'ticket_categories', ticket_categories) AS VARCHAR), chr(10) ORDER BY user_id) AS payload
FROM batches GROUP BY bucket, batch_no""")
check("parse_scoring_replies", f"""
SELECT reply_id, user_id, score, risk_level, reasons FROM scoring_elements
WHERE reasons IS NOT NULL AND NOT ({_DIFFERENT_LEVEL})""")
check("parse_recommendation_replies", """
SELECT reply_id, user_id, risk_level, urgency, recommendation, reasoning
FROM recommendation_elements
WHERE copy = 1 AND user_id NOT LIKE 'X%'""")
check("reply_rejects", f"""
SELECT DISTINCT 'scoring' AS kind, reply_id || '-cut' AS reply_id,
       CAST(NULL AS INTEGER) AS position, CAST(NULL AS VARCHAR) AS user_id, 'bad_json' AS reason
FROM scoring_elements
UNION ALL
SELECT 'scoring', reply_id, position, user_id,
       CASE WHEN reasons IS NULL THEN 'missing_field' ELSE 'level_mismatch' END
FROM scoring_elements WHERE reasons IS NULL OR {_DIFFERENT_LEVEL}
UNION ALL
SELECT 'recommendation', reply_id, 0, user_id,
       CASE WHEN user_id LIKE 'X%' THEN 'unknown_user' ELSE 'repeated_user' END
FROM recommendation_elements WHERE user_id LIKE 'X%' OR copy = 2
UNION ALL
SELECT 'recommendation', reply_id || '-cut', 0, NULL, 'bad_json' FROM recommendation_elements""")
check("parse_report_reply", """
SELECT title, executive_summary,
       format('{{"total_analyzed":{},"high_risk":{}}}', total_analyzed, high_risk)
           AS key_metrics,
       (SELECT concat('[', string_agg(format('{{"user_id":"{}","score":{}}}', user_id, score),
                                      ',' ORDER BY score DESC, user_id), ']') FROM top10)
           AS top_risk_clients,
       action_items, 'ai_agent' AS generated_by
FROM weekly""")
check("insert_results", f"""
SELECT DATE '{AS_OF}' AS run_date, user_id, score, risk_level FROM scored
UNION ALL SELECT DATE '{EARLIER}', user_id, score, risk_level FROM scored_old""")
check("upsert_scores", """
SELECT o.user_id, CASE WHEN n.risk_level = 'bajo' THEN o.score ELSE n.score END AS score,
       CASE WHEN n.risk_level = 'bajo' THEN o.risk_level ELSE n.risk_level END AS risk_level
FROM scored_old o JOIN scored n ON n.user_id = o.user_id""")
CTES["reply_scores"] = f"""
SELECT user_id, score, risk_level, reasons FROM scoring_elements
WHERE reasons IS NOT NULL AND NOT ({_DIFFERENT_LEVEL})"""
CTES["reply_recs"] = """
SELECT user_id, risk_level, urgency, recommendation, reasoning FROM recommendation_elements
WHERE copy = 1 AND user_id NOT LIKE 'X%'"""
CTES["reply_results"] = """
SELECT s.user_id, s.score, s.risk_level, u.plan, u.mrr_usd, r.urgency, r.recommendation
FROM reply_scores s JOIN users u ON u.user_id = s.user_id
LEFT JOIN reply_recs r ON r.user_id = s.user_id"""
CTES["reply_metrics"] = """
SELECT count(*) AS total_analyzed, count(*) FILTER (risk_level = 'alto') AS high_risk,
       count(*) FILTER (risk_level = 'medio') AS medium_risk,
       count(*) FILTER (risk_level = 'bajo') AS low_risk,
       count(*) FILTER (urgency = 'inmediata') AS immediate_action,
       CAST(coalesce(sum(mrr_usd) FILTER (risk_level <> 'bajo'), 0) AS DECIMAL(20,2))
           AS mrr_at_risk,
       (SELECT critical_tickets_open FROM key_metrics) AS critical_tickets_open
FROM reply_results"""


def _run_contents(scores: str, recs: str, results: str, metrics: str) -> str:
    return f"""
SELECT 'churn_scores' AS table_name, user_id AS row_key,
       concat_ws('|', score, risk_level, reasons) AS content FROM {scores}
UNION ALL SELECT 'recommendations', user_id,
       concat_ws('|', risk_level, urgency, recommendation, reasoning) FROM {recs}
UNION ALL SELECT 'alert_queue', user_id, concat_ws('|', score, urgency, plan, recommendation)
FROM {results} WHERE urgency = 'inmediata'
UNION ALL SELECT 'alert_digest', 'lunes, 5 de noviembre de 2001',
       concat(count(*), '|Se identificaron ', count(*), ' cliente',
              CASE WHEN count(*) > 1 THEN 's' ELSE '' END, ' que requieren contacto inmediato')
FROM {results} WHERE urgency = 'inmediata' HAVING count(*) > 0
UNION ALL SELECT 'weekly_reports', '{AS_OF}',
       concat('Reporte Semanal — ', high_risk, ' clientes en riesgo alto|', total_analyzed,
              ' clientes analizados: ', high_risk, ' alto, ', medium_risk, ' medio, ', low_risk,
              ' bajo. MRR en riesgo: ', mrr_at_risk, ' USD.|1. Contactar hoy a ',
              immediate_action, ' clientes', chr(10), '2. Resolver ', critical_tickets_open,
              ' tickets critical abiertos', chr(10), '3. Revisar ', medium_risk,
              ' clientes en riesgo medio')
FROM {metrics}"""


check("run_analysis", _run_contents("scored", "recs", "recs", "key_metrics"))
check("run_from_replies",
      _run_contents("reply_scores", "reply_recs", "reply_results", "reply_metrics"))
check("risk_list", "SELECT user_id, score, risk_level FROM scored WHERE risk_level <> 'bajo'")
check("top_from_tables", "SELECT * FROM top10", "mrr_usd")
check("stream_score_refresh", "SELECT user_id, score, risk_level FROM scored")
check("live_scores", """
SELECT f.* EXCLUDE (last_activity, features, adopted), score, risk_level
FROM facts f JOIN (SELECT user_id, score, risk_level FROM scored) USING (user_id)""",
      "mrr_usd", "original_churn_score")

# History, agreement, resolution times, drift
CTES["runs"] = f"""
SELECT DATE '{OLDEST}' AS run_date, 1 AS run_no, user_id, score, risk_level FROM scored_older
UNION ALL SELECT DATE '{EARLIER}', 2, user_id, score, risk_level FROM scored_old
UNION ALL SELECT DATE '{AS_OF}', 3, user_id, score, risk_level FROM scored"""
CTES["stretches"] = f"""
SELECT user_id, risk_level, min(run_date) AS valid_from,
       CASE max(run_no) WHEN 1 THEN DATE '{EARLIER}' WHEN 2 THEN DATE '{AS_OF}' END AS valid_to,
       count(*) AS runs_held, arg_min(score, run_no) AS first_score, arg_max(score, run_no) AS last_score,
       min(score) AS min_score, max(score) AS max_score
FROM (SELECT *, run_no - row_number() OVER (PARTITION BY user_id, risk_level ORDER BY run_no) AS island
      FROM runs)
GROUP BY user_id, risk_level, island"""
check("risk_history", "SELECT * FROM stretches")
check("risk_transitions", """
SELECT a.run_date AS from_run, b.run_date AS to_run, a.risk_level AS from_level,
       b.risk_level AS to_level, count(*) AS users, CAST(sum(b.score - a.score) AS BIGINT) AS score_change
FROM runs a JOIN runs b ON b.user_id = a.user_id AND b.run_no = a.run_no + 1 GROUP BY ALL""")
check("time_in_band", f"""
SELECT risk_level, count(*) AS stretches, count(DISTINCT user_id) AS users,
       count(*) FILTER (valid_to IS NULL) AS lasting,
       CAST(sum(coalesce(valid_to, DATE '{AS_OF}') - valid_from) AS BIGINT) AS days,
       CAST(max(coalesce(valid_to, DATE '{AS_OF}') - valid_from) AS INTEGER) AS longest
FROM stretches GROUP BY risk_level""")
CTES["both_ranked"] = """
SELECT risk_level,
       CAST(2 * rank() OVER (ORDER BY score) + count(*) OVER (PARTITION BY score) - 1 AS HUGEINT)
         - (count(*) OVER () + 1) AS r,
       CAST(2 * rank() OVER (ORDER BY original_churn_score)
            + count(*) OVER (PARTITION BY original_churn_score) - 1 AS HUGEINT) AS s2,
       rank() OVER (ORDER BY original_churn_score) - 1 AS below, count(*) OVER () AS size
FROM scored"""
check("score_agreement", """
SELECT count(*) AS users,
       CAST(sum(r * (s2 - size - 1)) AS DOUBLE)
         / (sqrt(CAST(sum(r * r) AS DOUBLE)) * sqrt(CAST(sum((s2 - size - 1) * (s2 - size - 1)) AS DOUBLE)))
         AS spearman,
       CAST(sum(s2) FILTER (high) - sum(high::INT) * (sum(high::INT) + 1) AS DOUBLE) / 2
         / (CAST(sum(high::INT) AS DOUBLE) * CAST(count(*) - sum(high::INT) AS DOUBLE)) AS auc_high,
       CAST(sum(s2) FILTER (risky) - sum(risky::INT) * (sum(risky::INT) + 1) AS DOUBLE) / 2
         / (CAST(sum(risky::INT) AS DOUBLE) * CAST(count(*) - sum(risky::INT) AS DOUBLE)) AS auc_at_risk
FROM (SELECT *, risk_level = 'alto' AS high, risk_level IN ('alto', 'medio') AS risky FROM both_ranked)""")
check("agreement_deciles", """
SELECT CAST(below * 10 // size + 1 AS INTEGER) AS decile, risk_level, count(*) AS users
FROM both_ranked GROUP BY ALL""")
_GROUPED_BY = """concat_ws(',', CASE WHEN grouping(category) = 0 THEN 'category' END,
       CASE WHEN grouping(priority) = 0 THEN 'priority' END,
       CASE WHEN grouping(channel) = 0 THEN 'channel' END) AS grouped_by, category, priority, channel,
       count(*) AS tickets"""
_SETS = "GROUPING SETS ((category), (priority), (channel), (category, priority, channel), ())"
check("resolution_hours", f"""
SELECT {_GROUPED_BY}, round(avg(resolution_hours), 2) AS mean_hours,
       quantile_cont(resolution_hours, 0.5) AS p50, quantile_cont(resolution_hours, 0.9) AS p90,
       quantile_cont(resolution_hours, 0.95) AS p95, max(resolution_hours) AS longest
FROM support_tickets WHERE resolution_hours IS NOT NULL GROUP BY {_SETS}""")
check("resolution_sketches", f"""
SELECT {_GROUPED_BY}, true AS p50_close, true AS p90_close, true AS p95_close
FROM support_tickets WHERE resolution_hours IS NOT NULL GROUP BY {_SETS}""")
check("features_count_check", """
SELECT user_id, CAST(features_count AS BIGINT) AS declared, coalesce(n, 0) AS listed,
       CASE WHEN u.user_id IS NULL THEN 'unknown_user' WHEN n IS NULL AND features_count <> 0 THEN 'no_usage'
            WHEN coalesce(n, 0) < features_count THEN 'fewer_listed'
            WHEN coalesce(n, 0) > features_count THEN 'more_listed' END AS fault
FROM bad_users u FULL JOIN (SELECT user_id, count(DISTINCT feature) AS n FROM feature_usage GROUP BY user_id) f
  USING (user_id)
WHERE u.user_id IS NULL OR coalesce(n, 0) <> features_count""")
_NUMBERS = {"created_date": "date", "resolved_date": "date", "resolution_hours": "int", "csat_score": "int"}


def _number(column: str, fn: str) -> str:
    kind = _NUMBERS.get(column)
    if kind is None:
        return "CAST(NULL AS BIGINT)"
    return f"CAST({fn}({column}) - DATE '1970-01-01' AS BIGINT)" if kind == "date" else f"CAST({fn}({column}) AS BIGINT)"


check("profile_of_loads", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT year(created_date)) AS loads, count(*) AS rows, "
    f"count(*) - count({c}) AS nulls, "
    + ", ".join(f"{f'CAST({fn}({c}) AS VARCHAR)' if c not in _NUMBERS else 'NULL'} AS {fn}_value" for fn in ("min", "max"))
    + ", " + ", ".join(f"{_number(c, fn)} AS {fn}_number" for fn in ("min", "max"))
    + ", true AS distinct_close FROM support_tickets" for c in _COLUMNS))
check("profile_drift", "SELECT *, lag(null_share) OVER (PARTITION BY column_name ORDER BY load) AS null_share_before FROM ("
      + " UNION ALL ".join(
          f"SELECT CAST(year(created_date) AS VARCHAR) AS load, '{c}' AS column_name, count(*) AS rows, "
          f"round((count(*) - count({c})) / count(*), 6) AS null_share FROM support_tickets GROUP BY 1"
          for c in _COLUMNS) + ")")
check("repeated_tickets", """
SELECT user_id, total_tickets, open_tickets, critical_open_tickets, open_critical, open_high,
       worst_csat, avg_csat FROM bad_ticket_agg""")
check("ticket_lookup", """
SELECT * FROM support_tickets WHERE status = 'In_Progress' AND year(created_date) = 1998""")

"""The three input tables, derived from the order-style test tables.

Each column is one SQL expression that Spark and the checking engine both run.
Users are all customers and all suppliers, feature usage is all order lines,
tickets are all orders. Suppliers order nothing, so they are the users without
features or tickets.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

AS_OF = dt.date(2001, 11, 5)

# Suppliers as accounts, in an id range of their own.
SUPPLIER_ACCOUNTS = {
    "c_custkey": "CAST(900000000 + s_suppkey AS BIGINT)",
    "c_nationkey": "s_nationkey",
    "c_mktsegment": "CASE s_suppkey % 5 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'FURNITURE' "
                    "WHEN 2 THEN 'MACHINERY' WHEN 3 THEN 'AUTOMOBILE' ELSE 'HOUSEHOLD' END",
}

USERS = {
    "user_id": "concat('USR-', CAST(10000 + c_custkey AS STRING))",
    "country": "CASE n_regionkey WHEN 0 THEN 'Colombia' WHEN 1 THEN 'México' "
               "WHEN 2 THEN 'Costa Rica' WHEN 3 THEN 'Panamá' ELSE 'República Dominicana' END",
    "plan": "CASE c_mktsegment WHEN 'BUILDING' THEN 'Pyme' WHEN 'FURNITURE' THEN 'Pro' "
            "WHEN 'MACHINERY' THEN 'Plus' ELSE 'Free' END",
    "signup_date": "DATE '1990-01-01' + CAST(c_custkey % 1800 AS INT)",
    "source": "CASE c_custkey % 5 WHEN 0 THEN 'Organic' WHEN 1 THEN 'Paid' "
              "WHEN 2 THEN 'Referral' WHEN 3 THEN 'Social' ELSE 'Partner_Accountant' END",
    "mrr_usd": "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') "
               "THEN CAST(0 AS DECIMAL(10,2)) "
               "ELSE CAST(CAST((c_custkey * 37) % 15001 AS DECIMAL(10,2)) "
               "* CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) END",
    "churn_risk_score": "CAST(CAST(5 + c_custkey % 91 AS DECIMAL(6,2)) "
                        "* CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(4,2))",
    "features_count": "CAST(1 + c_custkey % 10 AS INT)",
}

FEATURE_USAGE = {
    "user_id": "concat('USR-', CAST(10000 + o_custkey AS STRING))",
    "feature": "CASE p_type WHEN 'STANDARD' THEN 'Facturación electrónica' "
               "WHEN 'ECONOMY' THEN 'Inventario' WHEN 'MEDIUM' THEN 'Nómina' "
               "WHEN 'SMALL' THEN 'Cotizaciones' WHEN 'LARGE' THEN 'Punto de venta' "
               "ELSE 'Reportes financieros' END",
    "adoption_level": "CASE WHEN uses <= 2 THEN 'activated' WHEN uses <= 4 THEN 'used_1x' "
                      "WHEN uses <= 6 THEN 'used_5x' WHEN uses <= 9 THEN 'used_10x' "
                      "ELSE 'power_user' END",
    "last_used_date": "CAST(last_use AS DATE)",
}

SUPPORT_TICKETS = {
    "ticket_id": "concat('TKT-', CAST(20000 + o_orderkey AS STRING))",
    "user_id": "concat('USR-', CAST(10000 + o_custkey AS STRING))",
    "category": "CASE o_orderkey % 5 WHEN 0 THEN 'Bug' WHEN 1 THEN 'Feature_Request' "
                "WHEN 2 THEN 'Integration' WHEN 3 THEN 'Onboarding' ELSE 'Performance' END",
    "priority": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Critical' WHEN '2-HIGH' THEN 'High' "
                "WHEN '3-MEDIUM' THEN 'Medium' ELSE 'Low' END",
    "channel": "CASE o_orderkey % 4 WHEN 0 THEN 'Chat' WHEN 1 THEN 'Email' WHEN 2 THEN 'Phone' "
               "ELSE 'WhatsApp' END",
    "created_date": "CAST(o_orderdate AS DATE)",
    "resolved_date": "CASE WHEN o_orderstatus <> 'O' "
                     "THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 14 AS INT) END",
    "status": "CASE o_orderstatus WHEN 'F' THEN 'Resolved' WHEN 'P' THEN 'Closed' "
              "ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'Open' ELSE 'In_Progress' END END",
    "resolution_hours": "CASE WHEN o_orderstatus <> 'O' "
                        "THEN CAST((o_orderkey % 14) * 24 + o_orderkey % 24 AS INT) END",
    "csat_score": "CASE WHEN o_orderstatus <> 'O' "
                  "THEN CAST(1 + CAST(floor(o_orderkey / 25) AS BIGINT) % 5 AS INT) END",
}

# Text landing of the tickets, with the faults real exports show.
RAW_TICKETS = {
    "ticket_id": "ticket_id",
    "user_id": "CASE WHEN priority = 'Low' AND status = 'Closed' AND csat_score = 3 THEN ' ' "
               "ELSE user_id END",
    "category": "category",
    "priority": "priority",
    "channel": "channel",
    "created_date": "CASE WHEN channel = 'Email' AND category = 'Onboarding' "
                    "AND priority = 'Low' THEN substr(CAST(created_date AS STRING), 1, 7) "
                    "ELSE CAST(created_date AS STRING) END",
    "resolved_date": "CASE WHEN resolved_date IS NULL THEN '' "
                     "WHEN channel = 'Phone' AND csat_score = 1 THEN 'pendiente' "
                     "ELSE CAST(resolved_date AS STRING) END",
    "status": "status",
    "resolution_hours": "CASE WHEN resolution_hours IS NULL THEN '  ' "
                        "ELSE CAST(resolution_hours AS STRING) END",
    "csat_score": "CASE WHEN csat_score IS NULL THEN '' "
                  "WHEN category = 'Bug' AND priority = 'Critical' AND channel = 'Email' "
                  "THEN 'n/a' ELSE CAST(csat_score AS STRING) END",
}

# Typed tables with broken integrity rules, for the quality jobs.
FAULTY_USERS = {
    "user_id": "CASE WHEN source = 'Referral' AND features_count = 3 AND plan = 'Plus' "
               "THEN lower(user_id) ELSE user_id END",
    "country": "CASE WHEN source = 'Social' AND country = 'Panamá' THEN 'Perú' ELSE country END",
    "plan": "CASE WHEN source = 'Paid' AND country = 'Panamá' THEN 'Gold' "
            "WHEN source = 'Social' AND features_count = 4 AND plan = 'Free' THEN NULL "
            "ELSE plan END",
    "signup_date": "signup_date",
    "source": "source",
    "mrr_usd": "CASE WHEN plan = 'Free' AND source = 'Organic' THEN CAST(9.99 AS DECIMAL(10,2)) "
               "WHEN plan = 'Pro' AND country = 'México' THEN CAST(175 AS DECIMAL(10,2)) "
               "ELSE mrr_usd END",
    "churn_risk_score": "CASE WHEN country = 'Colombia' AND plan = 'Plus' "
                        "THEN CAST(1 AS DECIMAL(4,2)) ELSE churn_risk_score END",
    "features_count": "CASE WHEN country = 'Colombia' AND plan = 'Pyme' THEN 0 "
                      "ELSE features_count END",
}

FAULTY_USAGE = {
    "user_id": "user_id",
    "feature": "CASE WHEN feature = 'Nómina' AND adoption_level = 'used_1x' THEN 'Nomina' "
               "ELSE feature END",
    "adoption_level": "CASE WHEN feature = 'Inventario' AND adoption_level = 'used_5x' "
                      "THEN 'beta' ELSE adoption_level END",
    "last_used_date": "last_used_date",
}

FAULTY_TICKETS = {
    "ticket_id": "CASE WHEN category = 'Performance' AND priority = 'High' "
                 "THEN concat(ticket_id, 'x') ELSE ticket_id END",
    "user_id": "CASE WHEN category = 'Integration' AND priority = 'High' "
               "THEN concat('USR-X', user_id) ELSE user_id END",
    "category": "category",
    "priority": "priority",
    "channel": "CASE WHEN channel = 'WhatsApp' AND priority = 'Medium' THEN 'Fax' "
               "ELSE channel END",
    "created_date": "created_date",
    "resolved_date": "resolved_date",
    "status": "CASE WHEN status = 'Closed' AND priority = 'Critical' THEN NULL ELSE status END",
    "resolution_hours": "resolution_hours",
    "csat_score": "CASE WHEN status = 'Open' AND channel = 'Chat' THEN 5 "
                  "WHEN csat_score = 5 AND channel = 'Phone' THEN 9 ELSE csat_score END",
}
REPEATED_TICKETS = "priority = 'Critical' AND channel = 'Phone'"


class Inputs(NamedTuple):
    users: DataFrame
    feature_usage: DataFrame
    support_tickets: DataFrame


def columns(exprs: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in exprs.items()]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str) -> Inputs:
    accounts = _table(spark, sf_dir, "customer").select(*SUPPLIER_ACCOUNTS).union(
        _table(spark, sf_dir, "supplier").selectExpr(*columns(SUPPLIER_ACCOUNTS))
    )
    nation = _table(spark, sf_dir, "nation")
    orders = _table(spark, sf_dir, "orders")
    users = accounts.join(nation, accounts.c_nationkey == nation.n_nationkey).selectExpr(
        *columns(USERS)
    )
    usage = (
        _table(spark, sf_dir, "lineitem")
        .join(_table(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_type"),
              "l_partkey")
        .join(orders.selectExpr("o_orderkey AS l_orderkey", "o_custkey"), "l_orderkey")
        .groupBy("o_custkey", "p_type")
        .agg({"*": "count", "l_shipdate": "max"})
        .withColumnsRenamed({"count(1)": "uses", "max(l_shipdate)": "last_use"})
        .selectExpr(*columns(FEATURE_USAGE))
    )
    return Inputs(users, usage, orders.selectExpr(*columns(SUPPORT_TICKETS)))


def raw_tickets(inputs: Inputs) -> DataFrame:
    return inputs.support_tickets.selectExpr(*columns(RAW_TICKETS))


def faulty(inputs: Inputs) -> Inputs:
    tickets = inputs.support_tickets
    doubled = tickets.unionAll(tickets.where(REPEATED_TICKETS))
    return Inputs(
        inputs.users.selectExpr(*columns(FAULTY_USERS)),
        inputs.feature_usage.selectExpr(*columns(FAULTY_USAGE)),
        doubled.selectExpr(*columns(FAULTY_TICKETS)),
    )

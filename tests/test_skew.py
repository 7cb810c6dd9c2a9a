"""One account holds a third of all rows: results stay whole, tasks stay even."""

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from stayline.operators import dashboard, scoring, summary

N = 30_000


@pytest.fixture(scope="module")
def hot(spark, make):
    users = make.users(*[dict(user_id=f"u{i}") for i in range(200)])
    owner = F.when(F.col("id") % 3 == 0, "u0").otherwise(
        F.concat(F.lit("u"), (F.col("id") % 199 + 1).cast("string")))
    tickets = spark.range(N).select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("ticket_id"),
        owner.alias("user_id"), F.lit("Bug").alias("category"),
        F.when(F.col("id") % 2 == 0, "Critical").otherwise("Low").alias("priority"),
        F.lit("Chat").alias("channel"), F.lit(AS_OF).alias("created_date"),
        F.lit(None).cast("date").alias("resolved_date"), F.lit("Open").alias("status"),
        F.lit(None).cast("int").alias("resolution_hours"),
        (F.col("id") % 5 + 1).cast("int").alias("csat_score"),
    )
    usage = make.usage(*[dict(user_id=f"u{i}") for i in range(200)])
    return users, usage, tickets


def test_scores_of_the_hot_account(hot):
    scored = scoring.score_users(summary.user_facts(*hot, AS_OF))
    row = scored.where("user_id = 'u0'").first()
    assert row.total_tickets == N // 3 and row.open_critical == N // 6
    assert row.score == 25 * (N // 6) + 5 * (N // 6) + 25 + 10
    assert scored.agg(F.sum("total_tickets")).first()[0] == N


def test_user_document_pages(hot):
    users, usage, tickets = hot
    scored = scoring.score_users(summary.user_facts(users, usage, tickets, AS_OF))
    pages = dashboard.user_360(scored, usage, tickets, AS_OF, page_size=200).cache()
    assert pages.select(F.sum(F.size("tickets"))).first()[0] == N
    distinct = pages.select(F.explode("tickets.ticket_id").alias("t")).distinct().count()
    assert distinct == N
    of_hot = pages.where("user_id = 'u0'")
    assert of_hot.count() == N // 3 // 200
    assert of_hot.agg(F.max(F.size("tickets"))).first()[0] < 400
    assert pages.where("user_id <> 'u0'").groupBy("user_id").count().where("count > 1").count() == 0
    assert pages.select(F.sum(F.size("features"))).first()[0] == 200


def test_row_level_left_join_splits_the_hot_account(spark, hot):
    users, _, tickets = hot
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = summary.left_join_on_user(users, tickets)
        assert len(joined.collect()) == N
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)

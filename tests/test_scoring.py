import random

import pytest
from pyspark.sql import types as T

from conftest import by_user
from stayline.operators import scoring
from stayline.rules import POINT_TABLE, PointRule, ScoringRules, load_points

FACTS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("plan", T.StringType()),
    T.StructField("days_since_last_activity", T.IntegerType()),
    T.StructField("worst_adoption_level", T.IntegerType()),
    T.StructField("open_critical", T.LongType()),
    T.StructField("open_high", T.LongType()),
    T.StructField("open_other", T.LongType()),
    T.StructField("worst_csat", T.IntegerType()),
    T.StructField("total_tickets", T.LongType()),
])
BASE = ("Pro", 0, 5, 0, 0, 0, None, 0)


def facts(spark, **users):
    names = FACTS.names[1:]
    rows = [
        (user, *[values.get(n, default) for n, default in zip(names, BASE)])
        for user, values in users.items()
    ]
    return spark.createDataFrame(rows, FACTS)


def test_inactivity_boundaries(spark):
    days = {"d30": 30, "d31": 31, "d60": 60, "d61": 61, "d90": 90, "d91": 91, "neg": -3,
            "none": None}
    scored = scoring.score_users(
        facts(spark, **{k: dict(days_since_last_activity=v) for k, v in days.items()})
    )
    assert by_user(scored, "points_inactividad") == {
        "d30": 0, "d31": 15, "d60": 15, "d61": 30, "d90": 30, "d91": 40, "neg": 0, "none": 0
    }


def test_missing_figures_score_nothing(spark):
    scored = scoring.score_users(facts(
        spark, u=dict(days_since_last_activity=None, worst_adoption_level=None, worst_csat=None)
    ))
    assert by_user(scored, "score", "risk_level", "reasons") == {"u": (0, "bajo", "")}


@pytest.mark.parametrize("points,level", [(25, "bajo"), (26, "medio"), (50, "medio"),
                                          (51, "alto")])
def test_bands(spark, points, level):
    rules = ScoringRules((PointRule("x", "total_tickets", 1, "{n}", 1, per_unit=True),))
    scored = scoring.score_users(facts(spark, u=dict(total_tickets=points)), rules)
    assert by_user(scored, "score", "risk_level") == {"u": (points, level)}


def test_all_signals_with_reasons(spark):
    scored = scoring.score_users(facts(spark, u=dict(
        plan="Free", days_since_last_activity=42, worst_adoption_level=2, open_critical=2,
        open_high=1, open_other=3, worst_csat=2, total_tickets=7,
    )))
    assert by_user(scored, "score", "reasons") == {"u": (
        15 + 5 + 50 + 15 + 15 + 15 + 10 + 10,
        "Inactividad de 42 días (+15), adopción mínima used_1x (+5), "
        "2 tickets abiertos critical (+50), 1 tickets abiertos high (+15), "
        "3 tickets abiertos medium/low (+15), CSAT peor = 2 (+15), plan Free (+10), "
        "7 tickets en total (+10)",
    )}


def test_huge_account_does_not_overflow(spark):
    scored = scoring.score_users(facts(spark, u=dict(open_critical=10**9)))
    assert by_user(scored, "score", "risk_level") == {"u": (25 * 10**9, "alto")}


def plain_score(row):
    plan, idle, worst, critical, high, other, csat, total = row
    points = 0
    if idle is not None:
        points += 40 if idle > 90 else 30 if idle > 60 else 15 if idle > 30 else 0
    points += {1: 10, 2: 5}.get(worst, 0) + {1: 25, 2: 15}.get(csat, 0)
    points += 25 * critical + 15 * high + 5 * other
    points += 10 * (plan == "Free") + 10 * (total >= 4)
    return points


def test_random_users_against_plain_rules(spark):
    rng = random.Random(7)
    rows = [
        (f"u{i}", rng.choice(["Free", "Pyme", "Pro", "Plus"]),
         rng.choice([None, rng.randint(-5, 200)]), rng.choice([None, 1, 2, 3, 4, 5]),
         rng.randint(0, 3), rng.randint(0, 3), rng.randint(0, 3),
         rng.choice([None, 1, 2, 3, 4, 5]), rng.randint(0, 8))
        for i in range(2000)
    ]
    scored = scoring.score_users(spark.createDataFrame(rows, FACTS)).cache()
    want = {row[0]: plain_score(row[1:]) for row in rows}
    assert by_user(scored, "score") == want
    reasons = scoring.churn_reasons(scored).groupBy("user_id").sum("points").collect()
    assert {r[0]: r[1] for r in reasons} == {u: s for u, s in want.items() if s}
    factors = {r.signal: r.users for r in scoring.risk_factor_counts(scored).collect()}
    assert factors["plan"] == sum(row[1] == "Free" for row in rows)


def test_point_table_from_a_dataframe(spark):
    table = spark.createDataFrame([
        ("idle", "days_since_last_activity", 7, "{n} días", 11, None, None, False),
        ("idle", "days_since_last_activity", 3, "{n} días", 5, 10, None, None),
        ("plan", "plan", 2, "plan {n}", None, None, "Pro", False),
    ], POINT_TABLE)
    rules = load_points(table, medium_from=5, high_from=9)
    scored = scoring.score_users(facts(
        spark, a=dict(days_since_last_activity=10), b=dict(days_since_last_activity=11),
        c=dict(plan="Free"),
    ), rules)
    assert by_user(scored, "score", "risk_level", "reasons") == {
        "a": (5, "medio", "10 días (+3), plan Pro (+2)"),
        "b": (9, "alto", "11 días (+7), plan Pro (+2)"),
        "c": (0, "bajo", ""),
    }


def test_point_table_is_checked(spark):
    bad = spark.createDataFrame([("x", "no_such", 1, "", 1, None, None, False)], POINT_TABLE)
    with pytest.raises(ValueError, match="unknown metrics"):
        load_points(bad)
    long = spark.range(600).selectExpr(
        "'x' signal", "'plan' metric", "1 points", "'' detail", "1 low", "1 high",
        "'a' equals", "false per_unit")
    with pytest.raises(ValueError, match="more than"):
        load_points(long)


def test_run_clock_ignores_the_session_zone(spark):
    import datetime as dt

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        scored = scoring.score_users(facts(spark, u={}), run_ts=dt.datetime(2025, 1, 2, 3, 4, 5))
        assert scored.selectExpr("string(analyzed_at)").first()[0] == "2025-01-02 03:04:05"
        assert scored.schema["analyzed_at"].dataType.simpleString() == "timestamp_ntz"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)

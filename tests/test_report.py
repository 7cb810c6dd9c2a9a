import datetime as dt
import json

from conftest import AS_OF
from stayline.operators import recommend, report, scoring
from stayline.operators.summary import user_facts


def build(make, users, tickets):
    scored = scoring.score_users(user_facts(users, make.usage(), tickets, AS_OF))
    fit = recommend.feature_fit(scored)
    top = report.top_risk_clients(recommend.advise(report.top_scores(scored), fit=fit))
    return report.report_struct(recommend.with_urgency(scored), tickets, top)


def test_document(make):
    users = make.users(
        dict(user_id="a", plan="Free", mrr_usd=0), dict(user_id="b", mrr_usd="12.34"),
        dict(user_id="c", plan="Plus", country="México"),
    )
    tickets = make.tickets(*[
        dict(user_id="b", ticket_id=f"T{i}", status="Open", priority=p)
        for i, p in enumerate(("Critical", "Critical", "High", "Low"))
    ])
    doc = json.loads(report.report_metrics(build(make, users, tickets)).first().metrics)
    assert list(doc) == [
        "total_users", "risk_distribution", "urgency_distribution", "risk_by_plan",
        "risk_by_country", "avg_score_by_plan", "top_10_risk_clients", "total_mrr_at_risk",
        "open_tickets_summary",
    ]
    assert doc["total_users"] == 3
    assert doc["risk_distribution"] == {"alto": 1, "bajo": 2}
    assert doc["urgency_distribution"] == {"inmediata": 1}
    assert doc["risk_by_plan"] == [
        {"plan": "Free", "risk_level": "bajo", "cnt": 1},
        {"plan": "Plus", "risk_level": "bajo", "cnt": 1},
        {"plan": "Pro", "risk_level": "alto", "cnt": 1},
    ]
    assert doc["avg_score_by_plan"] == [
        {"plan": "Pro", "avg_score": 80.0, "total": 1},
        {"plan": "Free", "avg_score": 10.0, "total": 1},
        {"plan": "Plus", "avg_score": 0.0, "total": 1},
    ]
    top = doc["top_10_risk_clients"]
    assert [c["user_id"] for c in top] == ["b", "a", "c"]
    assert top[1]["urgency"] is None and "recommendation" in top[1]
    assert doc["total_mrr_at_risk"] == 12.34
    assert doc["open_tickets_summary"] == {"total_open": 4, "critical_open": 2, "high_open": 1}


def test_empty_results(make):
    empty = build(make, make.users(), make.tickets())
    doc = json.loads(report.report_metrics(empty).first().metrics)
    assert doc["total_users"] == 0 and doc["total_mrr_at_risk"] == 0
    assert doc["risk_distribution"] is None and doc["top_10_risk_clients"] is None
    assert tuple(report.report_key_metrics(empty).first()) == (0, 0, 0, 0, 0, 0, 0)
    row = report.weekly_report(empty, AS_OF, "w", dt.datetime(2025, 6, 30)).first()
    assert row.title and row.top_risk_clients == [] and row.key_metrics.total_analyzed == 0


def test_nobody_at_risk(make):
    doc = json.loads(report.report_metrics(
        build(make, make.users(dict(user_id="a")), make.tickets())).first().metrics)
    assert doc["urgency_distribution"] is None and doc["total_mrr_at_risk"] == 0
    assert doc["risk_distribution"] == {"bajo": 1}


def test_rollup_sums_to_total(make):
    users = make.users(*[dict(user_id=f"u{i}", plan=p) for i, p in
                         enumerate(("Free", "Pro", "Plus", "Pyme") * 5)])
    scored = scoring.score_users(user_facts(users, make.usage(), make.tickets(), AS_OF))
    rows = report.report_rollup(
        report.report_cube(recommend.with_urgency(scored))).collect()
    sums = {}
    for r in rows:
        sums[r.grouping] = sums.get(r.grouping, 0) + r.cnt
    assert sums == {name: 20 for name in report.SETS}


def test_top_list_from_stored_tables(spark, make):
    users = make.users(*[dict(user_id=f"u{i:02d}") for i in range(30)])
    scores = spark.createDataFrame(
        [(f"u{i:02d}", 10 * (i % 7), "alto", "r", None) for i in range(30)],
        "user_id string, score long, risk_level string, reasons string, analyzed_at timestamp_ntz")
    recs = spark.createDataFrame(
        [(f"u{i:02d}", "x", f"do {i}") for i in range(0, 30, 2)],
        "user_id string, urgency string, recommendation string")
    rows = report.top_risk_from_tables(scores, users, recs, 5).collect()
    assert [(r.user_id, r.score, r.recommendation) for r in rows] == [
        ("u06", 60, "do 6"), ("u13", 60, None), ("u20", 60, "do 20"), ("u27", 60, None),
        ("u05", 50, None)]

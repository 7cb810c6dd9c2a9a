from stayline.operators import quality


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_rules_on_broken_tables(make):
    tables = {
        "users": make.users(
            dict(user_id="USR-1", plan="Gold"), dict(user_id="USR-2", plan=None),
            dict(user_id="usr3", plan="Free", mrr_usd=5), dict(user_id="USR-4", mrr_usd=151),
            dict(user_id="USR-4", churn_risk_score=0.99, features_count=0),
        ),
        "feature_usage": make.usage(dict(user_id="USR-1"), dict(user_id="USR-7"),
                                    dict(user_id="USR-7", feature="X")),
        "support_tickets": make.tickets(
            dict(user_id="USR-1", ticket_id="TKT-1"), dict(user_id="USR-1", ticket_id="TKT-1"),
            dict(user_id="USR-1", ticket_id="TKT-2", csat_score=9, status="Open"),
        ),
    }
    assert rows(quality.duplicate_keys(tables)) == [
        ("support_tickets", "TKT-1", 2), ("users", "USR-4", 2)]
    assert rows(quality.orphans(tables)) == [("feature_usage", "USR-7", 2)]
    nulls = {(t, c): n for t, c, n in rows(quality.null_counts(tables))}
    assert nulls[("users", "plan")] == 1 and sum(nulls.values()) == 1
    assert ("support_tickets", "resolved_date") not in nulls
    assert rows(quality.domain_violations(tables)) == [
        ("feature_usage", "feature", "X", 1), ("users", "plan", "Gold", 1)]
    assert rows(quality.range_violations(tables)) == [
        ("support_tickets", "csat_score", "9", 1), ("users", "churn_risk_score", "0.99", 1),
        ("users", "features_count", "0", 1), ("users", "mrr_usd", "151.00", 1)]
    assert rows(quality.id_format(tables)) == [("users", "user_id", "usr3", 1)]
    assert [r.user_id for r in quality.free_plan_mrr(tables["users"]).collect()] == ["usr3"]
    life = quality.ticket_lifecycle(tables["support_tickets"]).collect()
    assert [r.ticket_id for r in life] == ["TKT-2"]


def test_weekly_reports_are_checked_for_nulls(spark):
    from stayline.schemas import WEEKLY_REPORTS

    empty = spark.createDataFrame([(None,) * len(WEEKLY_REPORTS.names)], WEEKLY_REPORTS)
    counts = rows(quality.null_counts({"weekly_reports": empty}))
    assert len(counts) == 7 and {n for _, _, n in counts} == {1}

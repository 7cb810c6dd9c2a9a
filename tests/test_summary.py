import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import AS_OF, by_user
from stayline.operators import summary


def test_users_without_children_stay(spark, make):
    users = make.users(dict(user_id="U1"), dict(user_id="U2"), dict(user_id="U3"))
    usage = make.usage(dict(user_id="U1"), dict(user_id="U2"))
    tickets = make.tickets(dict(user_id="U1", ticket_id="T1", status="Open"))
    out = summary.user_summary(users, usage, tickets, AS_OF)
    assert by_user(out, "days_since_last_activity", "total_tickets", "open_tickets",
                   "features_list", "ticket_categories", "worst_csat", "avg_csat") == {
        "U1": (0, 1, 1, "Inventario", "Bug", None, None),
        "U2": (0, 0, 0, "Inventario", None, None, None),
        "U3": (None, 0, 0, None, None, None, None),
    }
    assert out.columns[:18] == list(summary.SUMMARY_COLUMNS)
    assert out.schema["mrr_usd"].dataType.simpleString() == "decimal(10,2)"
    assert out.select("mrr_usd").first()[0] == Decimal("50.00")


def test_two_children_do_not_multiply(make):
    users = make.users(dict(user_id="U1"))
    usage = make.usage(*[dict(user_id="U1", feature=f) for f in ("Z", "a", "Ñ")])
    tickets = make.tickets(*[
        dict(user_id="U1", ticket_id=f"T{i}", csat_score=c) for i, c in enumerate((1, 4, 4, 4))
    ])
    out = summary.user_summary(users, usage, tickets, AS_OF)
    assert by_user(out, "total_tickets", "worst_csat", "avg_csat", "features_list") == {
        "U1": (4, 1, 3.3, "Z, a, Ñ")
    }


def test_unknown_adoption_level_is_null(make):
    users = make.users(dict(user_id="U1"), dict(user_id="U2"))
    usage = make.usage(
        dict(user_id="U1", adoption_level="beta"),
        dict(user_id="U2", adoption_level="beta"),
        dict(user_id="U2", feature="X", adoption_level="used_1x"),
        dict(user_id="U2", feature="Y", adoption_level="power_user"),
    )
    out = summary.user_summary(users, usage, make.tickets(), AS_OF)
    assert by_user(out, "worst_adoption_level", "best_adoption_level") == {
        "U1": (None, None), "U2": (2, 5)
    }


def test_open_counts_split(make):
    users = make.users(dict(user_id="U1"))
    statuses = ("Open", "In_Progress", "Resolved", "Closed")
    tickets = make.tickets(*[
        dict(user_id="U1", ticket_id=f"{s}{p}", status=s, priority=p)
        for s in statuses for p in ("Low", "Medium", "High", "Critical")
    ])
    out = summary.user_summary(users, make.usage(), tickets, AS_OF)
    assert by_user(out, "total_tickets", "open_tickets", "critical_open_tickets",
                   "open_critical", "open_high", "open_other") == {"U1": (16, 8, 4, 2, 2, 4)}


def test_same_as_joining_everything_first(make, spark):
    users = make.users(*[dict(user_id=f"U{i}") for i in range(20)])
    usage = make.usage(*[
        dict(user_id=f"U{i}", feature=f"f{j}", last_used_date=AS_OF - dt.timedelta(days=i + j))
        for i in range(15) for j in range(i % 4)
    ])
    tickets = make.tickets(*[
        dict(user_id=f"U{i}", ticket_id=f"T{i}-{j}", csat_score=1 + (i * j) % 5,
             status="Open" if j % 2 else "Closed")
        for i in range(5, 20) for j in range(i % 6)
    ])
    joined = users.join(usage, "user_id", "left").join(
        tickets.select("user_id", "ticket_id", "csat_score", "status"), "user_id", "left"
    ).groupBy("user_id").agg(
        F.countDistinct("ticket_id").alias("total_tickets"),
        F.countDistinct(F.when(F.col("status") == "Open", F.col("ticket_id"))).alias("o"),
        F.round(F.avg("csat_score"), 1).alias("avg_csat"),
        F.datediff(F.lit(AS_OF), F.max("last_used_date")).alias("idle"),
    )
    ours = summary.user_summary(users, usage, tickets, AS_OF)
    assert by_user(joined, "total_tickets", "o", "avg_csat", "idle") == by_user(
        ours, "total_tickets", "open_tickets", "avg_csat", "days_since_last_activity"
    )


def test_left_join_keeps_all_users_and_rows(make):
    users = make.users(dict(user_id="U1"), dict(user_id="U2"))
    tickets = make.tickets(*[dict(user_id="U1", ticket_id=f"T{i}") for i in range(3)],
                           dict(user_id="U9", ticket_id="T9"))
    rows = summary.left_join_on_user(users, tickets).collect()
    assert sorted((r.user_id, r.ticket_id or "") for r in rows) == [
        ("U1", "T0"), ("U1", "T1"), ("U1", "T2"), ("U2", "")
    ]


def test_unlisted_values_are_kept_unless_the_domain_is_closed(make):
    import pytest

    users = make.users(dict(user_id="U1"), dict(user_id="U2"))
    usage = make.usage(dict(user_id="U1", feature="Beta", adoption_level="used_1x"),
                       dict(user_id="U1"), dict(user_id="U1", feature="Alfa"),
                       dict(user_id="U2", feature="Nómina"))
    tickets = make.tickets(dict(user_id="U2", ticket_id="T1", category="Zeta"),
                           dict(user_id="U2", ticket_id="T2"))
    facts = summary.user_facts(users, usage, tickets, AS_OF)
    assert by_user(facts, "features_list", "ticket_categories") == {
        "U1": ("Alfa, Beta, Inventario", None), "U2": ("Nómina", "Bug, Zeta")}
    assert sorted(by_user(facts, "adopted")["U1"]) == ["Alfa", "Inventario"]
    with pytest.raises(Exception, match="outside the closed domain"):
        summary.user_facts(users, usage, tickets, AS_OF, closed=True).collect()
    fine = summary.user_facts(users, usage.where("user_id = 'U2'"),
                              tickets.where("category = 'Bug'"), AS_OF, closed=True)
    assert by_user(fine, "features_list", "ticket_categories") == {
        "U1": (None, None), "U2": ("Nómina", "Bug")}


def test_detail_holds_risky_users_only(spark, make):
    from stayline.operators import scoring

    users = make.users(dict(user_id="U1"), dict(user_id="U2"), dict(user_id="U3"))
    tickets = make.tickets(*[
        dict(user_id=u, ticket_id=f"{u}{i}", status="Open", priority="Critical")
        for u, n in (("U1", 2), ("U2", 3)) for i in range(n)])
    facts = summary.user_facts(users, make.usage(), tickets, AS_OF)
    detail = summary.churn_detail(
        scoring.churn_scores(scoring.score_users(facts)), facts.select(*summary.SUMMARY_COLUMNS))
    assert len(detail.columns) == 21 and "original_churn_score" not in detail.columns
    assert [(r.user_id, r.score) for r in summary.by_score(detail).collect()] == [
        ("U2", 75), ("U1", 50)]


def test_domains_of_more_values_than_a_mask_word(make):
    from stayline.rules import AdviceRules

    names = tuple(f"f{i:03d}" for i in range(130))
    usage = make.usage(*[dict(user_id="a", feature=n) for n in (names[0], names[63], names[129])])
    for closed in (True, False):
        row = summary.usage_by_user(usage, AS_OF, AdviceRules(catalogue=names), closed).first()
        assert sorted(row.features) == ["f000", "f063", "f129"]


def test_a_repeated_ticket_counts_once(make):
    one = dict(user_id="a", ticket_id="T1", status="Open", priority="Critical", csat_score=2)
    tickets = make.tickets(one, one, dict(one, status="Closed", csat_score=5, category="Onboarding"),
                           dict(user_id="a", ticket_id="T2"), dict(user_id="b", ticket_id="T1"))
    got = by_user(summary.tickets_by_user(tickets), "total_tickets", "open_tickets", "open_critical",
                  "worst_csat", "avg_csat", "categories")
    assert got == {"a": (2, 1, 1, 2, 3.0, ["Bug", "Onboarding"]), "b": (1, 0, 0, None, None, ["Bug"])}
    unique = make.tickets(one, dict(user_id="a", ticket_id="T2"))
    assert by_user(summary.tickets_by_user(unique, closed=True), "total_tickets", "avg_csat") == {"a": (2, 2.0)}

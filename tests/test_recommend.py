import pytest

from conftest import AS_OF, by_user
from stayline.operators import alerts, recommend, scoring
from stayline.operators.summary import user_facts
from stayline.rules import AdviceRules
from stayline.schemas import FEATURES


@pytest.fixture(scope="module")
def profile_rows(spark):
    """risk level, urgent open tickets, worst CSAT -> urgency"""
    cases = {
        "a": ("alto", 1, None, "inmediata"), "b": ("alto", 0, 1, "inmediata"),
        "c": ("alto", 0, 2, "esta_semana"), "d": ("alto", 0, None, "esta_semana"),
        "e": ("medio", 0, None, "monitoreo"), "f": ("medio", 0, 2, "monitoreo"),
        "g": ("medio", 1, 5, "esta_semana"), "h": ("medio", 0, 1, "esta_semana"),
        "i": ("bajo", 1, 1, None),
    }
    df = spark.createDataFrame(
        [(u, *c[:3]) for u, c in cases.items()],
        "user_id string, risk_level string, critical_open_tickets long, worst_csat int",
    )
    return df, {u: c[3] for u, c in cases.items()}


def test_urgency(profile_rows):
    df, want = profile_rows
    assert by_user(recommend.with_urgency(df), "urgency") == want


@pytest.fixture(scope="module")
def advised(spark, make):
    users = make.users(
        dict(user_id="low"), dict(user_id="high", plan="Plus", mrr_usd=120),
        dict(user_id="mid", plan="Free", mrr_usd=0), dict(user_id="bare", plan="Free", mrr_usd=0),
        dict(user_id="peer", plan="Plus"),
    )
    usage = make.usage(
        dict(user_id="low"), dict(user_id="high", adoption_level="activated"),
        dict(user_id="high", feature="Nómina"),
        dict(user_id="mid", adoption_level="activated"),
        dict(user_id="peer", feature="Cotizaciones"),
    )
    tickets = make.tickets(
        *[dict(user_id="high", ticket_id=f"T{i}", status="Open", priority="Critical")
          for i in range(2)],
        dict(user_id="mid", ticket_id="T7", csat_score=2),
    )
    return recommend.advise(scoring.score_users(user_facts(users, usage, tickets, AS_OF)))


def test_every_risky_user_gets_one_recommendation(advised):
    recs = by_user(recommend.recommendations(advised), "risk_level", "urgency", "recommendation")
    assert recs == {
        "high": ("alto", "inmediata",
                 "Actuar hoy: escalar 2 tickets critical a ingeniería; contacto proactivo por "
                 "llamada, email o WhatsApp; sesión de onboarding para Inventario; asignar "
                 "account manager dedicado; dar seguimiento a 2 tickets abiertos; mostrar "
                 "Cotizaciones"),
        "mid": ("medio", "monitoreo",
                "Revisar en el próximo ciclo semanal: sesión de onboarding para Inventario; "
                "invitar a webinar o capacitación grupal; descuento o extensión de trial"),
    }


def test_actions_match_the_text(advised):
    actions = recommend.recommendation_actions(advised).collect()
    assert sorted((r.user_id, r.action) for r in actions) == [
        ("high", "account_manager"), ("high", "contacto_proactivo"), ("high", "escalamiento"),
        ("high", "onboarding"), ("mid", "capacitacion_grupal"), ("mid", "descuento_trial"),
        ("mid", "onboarding"),
    ]


def test_text_is_never_empty(spark, make):
    users = make.users(dict(user_id="u"))
    tickets = make.tickets(dict(user_id="u", ticket_id="T1", csat_score=1),
                           *[dict(user_id="u", ticket_id=f"T{i}") for i in range(2, 5)])
    out = recommend.advise(scoring.score_users(
        user_facts(users, make.usage(dict(user_id="u")), tickets, AS_OF)))
    assert by_user(recommend.recommendations(out), "recommendation") == {
        "u": "Actuar en los próximos 5 días"
    }


def test_feature_gap_counts_the_whole_catalogue(advised):
    gap = recommend.feature_gap(advised).groupBy("user_id").count().collect()
    assert {r[0]: r[1] for r in gap} == {
        "low": len(FEATURES) - 1, "high": len(FEATURES) - 2, "mid": len(FEATURES) - 1,
        "bare": len(FEATURES), "peer": len(FEATURES) - 1,
    }


def test_offers_follow_the_threshold(make, spark):
    users = make.users(*[dict(user_id=f"u{i}") for i in range(4)])
    usage = make.usage(dict(user_id="u0", feature="Nómina"),
                       dict(user_id="u1", feature="Nómina"),
                       dict(user_id="u1", feature="Inventario"))
    facts = user_facts(users, usage, make.tickets(), AS_OF)
    rows = recommend.feature_gap_ranked(facts).collect()
    assert sorted((r.user_id, r.position, r.feature, r.rate) for r in rows) == [
        ("u0", 1, "Inventario", 0.25), ("u2", 1, "Nómina", 0.5), ("u2", 2, "Inventario", 0.25),
        ("u3", 1, "Nómina", 0.5), ("u3", 2, "Inventario", 0.25),
    ]
    strict = recommend.feature_gap_ranked(facts, AdviceRules(min_fit=0.3)).collect()
    assert {r.feature for r in strict} == {"Nómina"}


def test_alerts(advised):
    queue = alerts.alert_queue(advised)
    assert by_user(queue, "urgency") == {"high": "inmediata"}
    digest = alerts.alert_digest(queue, AS_OF).first()
    assert (digest.total, digest.alto, digest.medio, digest.bajo) == (1, 1, 0, 0)
    assert digest.date_text == "lunes, 30 de junio de 2025"
    assert digest.headline == "Se identificaron 1 cliente que requieren contacto inmediato"
    assert alerts.alert_digest(queue.where("false"), AS_OF).count() == 0
    table = alerts.alerts_table(advised, width=10)
    assert by_user(table, "recommendation_short")["high"] == "Actuar hoy…"
    assert by_user(alerts.alerts_filtered(table, plan="Free"), "risk_level") == {"mid": "medio"}
    assert alerts.alerts_filtered(table).count() == 2
    assert alerts.alerts_search(table, "hig").count() == 1
    assert alerts.alerts_search(table, "hig", exact=True).count() == 0


def test_stored_tables_give_the_same_queue(advised):
    scores = scoring.churn_scores(advised)
    recs = recommend.recommendations(advised)
    users = advised.select("user_id", "plan", "country", "mrr_usd")
    joined = alerts.join_results(scores, recs, users)
    assert joined.count() == 5
    assert alerts.alert_queue(joined).collect() == alerts.alert_queue(advised).collect()

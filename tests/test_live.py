import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, SMALL, by_user
from stayline.operators import scoring
from stayline.operators.summary import SPLIT_COUNTS, SUMMARY_COLUMNS, user_facts
from stayline.rules import DEFAULT_POINTS, PointRule, ScoringRules
from stayline.sources import testdata
from stayline.streaming import live as module
from stayline.streaming.live import LiveScores, crossings
from stayline.streaming.refresh import change_stream

FACTS = [*SUMMARY_COLUMNS[1:], *SPLIT_COUNTS]


def full_run(users, usage, tickets, as_of=AS_OF):
    return scoring.score_users(user_facts(users, usage, tickets, as_of))


def assert_equals_full_run(live, users, usage, tickets, as_of):
    want = full_run(users, usage, tickets, as_of)
    assert by_user(live.current_scores(), "score", "risk_level") == by_user(want, "score", "risk_level")
    assert by_user(live.current_facts(), *FACTS) == by_user(want, *FACTS)
    assert live.as_of == as_of


def scored_last(live, spark):
    """The users of the newest score segment."""
    rows = live._rows("scores", live.snapshots.current())
    last = rows.agg(F.max("batch_id")).first()[0]
    return sorted(r.user_id for r in rows.where(F.col("batch_id") == last).collect())


def test_changes_take_back_what_they_replace(spark, make, tmp_path, monkeypatch):
    """Random changes, retried and merged, end where a full run over the last versions does."""
    monkeypatch.setattr(module, "FAN", 3)
    random.seed(2)
    users = {f"u{i}": dict(user_id=f"u{i}", plan=random.choice(["Free", "Pro"])) for i in range(15)}
    tickets, usage = {}, {}
    live = LiveScores(spark, str(tmp_path), buckets=2)

    def some_tickets(n):
        out = {}
        for _ in range(n):
            key = f"T{random.randrange(30)}"
            out[key] = dict(
                ticket_id=key, user_id=f"u{random.randrange(16)}", status=random.choice(["Open", "Closed"]),
                priority=random.choice(["Low", "High", "Critical"]), csat_score=random.choice([None, 1, 2, 5]),
                category=random.choice(["Bug", "Onboarding", "Sonstiges"]))
        return out

    def some_usage(n):
        out = {}
        for _ in range(n):
            key = (f"u{random.randrange(15)}", random.choice(["Inventario", "Nómina", "Neu"]))
            out[key] = dict(
                user_id=key[0], feature=key[1], last_used_date=AS_OF - dt.timedelta(days=random.randrange(120)),
                adoption_level=random.choice(["activated", "used_1x", "used_5x", "power_user"]))
        return out

    tickets |= some_tickets(20)
    usage |= some_usage(20)
    live.seed(make.users(*users.values()), make.usage(*usage.values()), make.tickets(*tickets.values()), AS_OF)
    as_of = AS_OF
    for batch in range(4):
        changed = some_tickets(6), some_usage(4)
        people = {"u3": dict(users["u3"], plan=random.choice(["Free", "Pro"]))}
        tickets |= changed[0]
        usage |= changed[1]
        users |= people
        as_of += dt.timedelta(days=batch % 3 * 11)
        changes = change_stream(
            tickets=make.tickets(*changed[0].values()), usage=make.usage(*changed[1].values()),
            users=make.users(*people.values()), clock=spark.createDataFrame([(as_of,)], "as_of date"))
        live.process(changes, batch)
        if batch == 2:
            live.process(changes, batch)
            version = live.snapshots.current().version
            live.process(changes, 1)
            assert live.snapshots.current().version == version
    assert_equals_full_run(
        live, make.users(*users.values()), make.usage(*usage.values()), make.tickets(*tickets.values()), as_of)
    levels = {p.partition("-")[0] for t, p in live.snapshots.current().parts if t == "facts"}
    assert levels - {"0"}  # segments were merged
    assert len(live.snapshots.current().parts) < 3 * 3 * len(module.STORED)
    facts = live._rows("facts", live.snapshots.current())
    assert module.summed(facts).where("n < 0").count() == 0


def test_minimum_rises_when_its_value_is_taken_back(spark, make, tmp_path):
    live = LiveScores(spark, str(tmp_path), buckets=2)
    worst = dict(user_id="a", ticket_id="T1", csat_score=1)
    live.seed(make.users(dict(user_id="a"), dict(user_id="b")), make.usage(),
              make.tickets(worst, dict(user_id="a", ticket_id="T2", csat_score=2)), AS_OF)
    assert by_user(live.current_scores(), "score") == {"a": 25, "b": 0}
    live.process(change_stream(tickets=make.tickets(dict(worst, csat_score=4))), 0)
    assert by_user(live.current_scores(), "score") == {"a": 15, "b": 0}
    live.process(change_stream(tickets=make.tickets(dict(worst, user_id="b", csat_score=1))), 1)
    assert by_user(live.current_scores(), "score") == {"a": 15, "b": 25}
    assert scored_last(live, spark) == ["a", "b"]


def test_a_date_rescores_only_the_users_due(spark, make, tmp_path):
    live = LiveScores(spark, str(tmp_path), buckets=3)
    days = {"d5": 5, "d29": 29, "d30": 30, "d31": 31, "d59": 59, "d60": 60, "d90": 90, "d400": 400}
    users = make.users(*[dict(user_id=u) for u in days], dict(user_id="never"))
    usage = [dict(user_id=u, last_used_date=AS_OF - dt.timedelta(days=n)) for u, n in days.items()]
    live.seed(users, make.usage(*usage), make.tickets(), AS_OF)
    live.advance(AS_OF + dt.timedelta(days=1))
    assert scored_last(live, spark) == ["d30", "d60", "d90"]
    assert_equals_full_run(live, users, make.usage(*usage), make.tickets(), AS_OF + dt.timedelta(days=1))
    # A use puts the date off: the old entry in the due table has no effect.
    used = dict(user_id="d29", last_used_date=AS_OF)
    live.process(change_stream(usage=make.usage(used)), 0)
    usage[1] = used
    live.advance(AS_OF + dt.timedelta(days=2))
    assert scored_last(live, spark) == ["d59"]
    live.advance(AS_OF + dt.timedelta(days=1))  # time does not run back
    for later in (40, 200):
        live.advance(AS_OF + dt.timedelta(days=later))
        assert_equals_full_run(
            live, users, make.usage(*usage), make.tickets(), AS_OF + dt.timedelta(days=later))


def test_a_batch_reads_the_state_of_what_it_touches(spark, make, tmp_path):
    """One of 200 users changes: the rows read are those of one bucket, not the history."""
    people = [dict(user_id=f"u{i}") for i in range(200)]
    tickets = [dict(user_id=f"u{i % 200}", ticket_id=f"T{i}", status="Open") for i in range(600)]
    live = LiveScores(spark, str(tmp_path), buckets=100)
    live.seed(make.users(*people), make.usage(), make.tickets(*tickets), AS_OF)
    for batch in range(3):  # the same ticket again and again: facts cancel, they do not pile up
        status = "Closed" if batch % 2 else "Open"
        live.process(change_stream(tickets=make.tickets(dict(tickets[7], status=status, priority="High"))), batch)
    state = live.snapshots.current()
    met = [r.bucket for r in live._rows("users", state).where("user_id = 'u7'").collect()]
    read = live._rows("facts", state, met)
    assert read.count() <= 0.1 * live._rows("facts", state).count()
    files = lambda rows: rows.select(F.input_file_name()).distinct().count()
    assert files(read) <= 0.1 * files(live._rows("facts", state))
    assert "PartitionFilters: [bucket" in read._jdf.queryExecution().executedPlan().toString().replace(
        "isnotnull(bucket", "bucket").replace("PartitionFilters: [(", "PartitionFilters: [")
    assert scored_last(live, spark) == ["u7"]
    assert by_user(live.current_scores(), "score")["u7"] == 15 + 10


def test_a_killed_batch_changes_nothing(spark, make, tmp_path, monkeypatch):
    live = LiveScores(spark, str(tmp_path), buckets=2)
    live.seed(make.users(dict(user_id="a")), make.usage(), make.tickets(), AS_OF)
    change = change_stream(tickets=make.tickets(
        dict(user_id="a", ticket_id="T", status="Open", priority="Critical")))
    kept = LiveScores._store

    def dies(self, table, rows):
        if table == "scores":
            raise KeyboardInterrupt
        return kept(self, table, rows)

    monkeypatch.setattr(LiveScores, "_store", dies)
    with pytest.raises(KeyboardInterrupt):
        live.process(change, 0)
    monkeypatch.setattr(LiveScores, "_store", kept)
    assert by_user(live.current_scores(), "score") == {"a": 0}
    live.process(change, 0)
    assert by_user(live.current_scores(), "score") == {"a": 25}
    assert by_user(live.current_facts(), "open_critical") == {"a": 1}


def test_unknown_users_wait_for_their_profile(spark, make, tmp_path):
    live = LiveScores(spark, str(tmp_path), buckets=2)
    live.seed(make.users(dict(user_id="a")), make.usage(), make.tickets(), AS_OF)
    live.process(change_stream(tickets=make.tickets(
        dict(user_id="late", ticket_id="T", status="Open", priority="Critical"))), 0)
    assert [r.user_id for r in live.unknown_users().collect()] == ["late"]
    live.process(change_stream(users=make.users(dict(user_id="late"))), 1)
    assert by_user(live.current_scores(), "score") == {"a": 0, "late": 25}
    live.process(change_stream(tickets=make.tickets()), 2)
    assert live.unknown_users().count() == 0


def test_crossings_follow_the_point_table():
    assert crossings(ScoringRules()) == [31, 61, 91]
    more = ScoringRules((*DEFAULT_POINTS, PointRule("x", "days_since_last_activity", 1, "x", 5, 6)))
    assert crossings(more) == [5, 7, 31, 61, 91]
    with pytest.raises(ValueError):
        crossings(ScoringRules((PointRule("x", "days_since_last_activity", 1, "x", per_unit=True),)))


def test_a_step_of_many_files_is_one_batch(spark, monkeypatch, tmp_path):
    """What arrives is written by as many tasks as the tables have, and each step is one batch."""
    from stayline.plans import queries

    tickets = testdata.load(spark, SMALL).support_tickets
    monkeypatch.setattr(queries, "written", lambda df, name: (
        tickets.repartition(5) if name == "live-support_tickets" else df))
    monkeypatch.setattr(queries, "shared_dir", lambda _, purpose: str(tmp_path / purpose))
    monkeypatch.setattr(LiveScores, "seed", lambda *_: None)
    batches = []
    monkeypatch.setattr(LiveScores, "process", lambda self, changes, batch_id: batches.append(
        (batch_id, changes.where("kind = 'support_tickets'").count())))
    queries._live(spark, SMALL)
    late = tickets.where(F.col("created_date") >= F.lit(queries.STREAM_FROM)).count()
    assert batches == [(0, 2 * tickets.count()), (1, 0), (2, late), (3, late)]
    files = list((tmp_path / "live/incoming/step=3").glob("*.parquet"))
    assert len(files) >= 5


def test_a_ticket_and_a_use_are_one_fact_each(spark, make, tmp_path):
    """The state grows with kinds of tickets and uses, not with the figures they count for."""
    live = LiveScores(spark, str(tmp_path), buckets=2)
    tickets = [dict(user_id="a", ticket_id=f"T{i}", status="Open", priority="High", csat_score=2) for i in range(9)]
    nothing = dict(user_id="a", feature=None, adoption_level=None, last_used_date=None)
    live.seed(make.users(dict(user_id="a")), make.usage(dict(user_id="a"), nothing), make.tickets(*tickets), AS_OF)
    assert live._rows("facts", live.snapshots.current()).count() == 2
    assert by_user(live.current_facts(), "open_high", "avg_csat", "features_list") == {"a": (9, 2.0, "Inventario")}
    live.process(change_stream(tickets=make.tickets(dict(tickets[0], status="Closed"))), 0)
    facts = live._rows("facts", live.snapshots.current())
    assert facts.count() == 2 + 2  # one is taken back, one added
    assert sorted(r.n for r in module.summed(facts).collect()) == [1, 1, 8]


def test_facts_of_many_users_are_dealt_once(spark, make, tmp_path, monkeypatch):
    """A batch that names many users deals the facts of their buckets by user, without joining them."""
    monkeypatch.setattr(module, "FEW", -1)
    live = LiveScores(spark, str(tmp_path), buckets=2)
    people = make.users(*[dict(user_id=f"u{i}") for i in range(20)])
    tickets = [dict(user_id=f"u{i % 21}", ticket_id=f"T{i}", status="Open", csat_score=i % 5 + 1) for i in range(60)]
    live.seed(people, make.usage(dict(user_id="u1")), make.tickets(*tickets), AS_OF)
    tickets[7] = dict(tickets[7], status="Closed", csat_score=1)
    live.process(change_stream(tickets=make.tickets(tickets[7])), 0)
    assert scored_last(live, spark) == ["u7"]
    live.advance(AS_OF + dt.timedelta(days=31))
    assert scored_last(live, spark) == ["u1"]
    assert_equals_full_run(
        live, people, make.usage(dict(user_id="u1")), make.tickets(*tickets), AS_OF + dt.timedelta(days=31))
    state = live.snapshots.current()
    named = live._rows("users", state).select("user_id", "bucket")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = live._facts(state, named, lists=False)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Join") == 1  # of profiles and figures
    assert "fact" in text and "label" not in text


def test_points_may_follow_lists(spark, make, tmp_path):
    rules = ScoringRules((*DEFAULT_POINTS, PointRule("x", "ticket_categories", 7, "x", equals="Bug, Sonstiges")))
    live = LiveScores(spark, str(tmp_path), buckets=2, rules=rules)
    people = make.users(dict(user_id="a"), dict(user_id="b"))
    live.seed(people, make.usage(), make.tickets(dict(user_id="a", ticket_id="T1")), AS_OF)
    live.process(change_stream(tickets=make.tickets(dict(user_id="a", ticket_id="T2", category="Sonstiges"))), 0)
    assert by_user(live.current_scores(), "score") == {"a": 7, "b": 0}

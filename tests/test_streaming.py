import datetime as dt
import re

from conftest import AS_OF, SMALL, by_user
from stayline.operators import scoring
from stayline.operators.summary import tickets_by_user, user_facts
from stayline.schemas import FEATURE_USAGE, SUPPORT_TICKETS
from stayline.sources import testdata
from stayline.streaming.refresh import ScoreRefresh, change_stream, latest


def batch_scores(users, usage, tickets):
    return by_user(scoring.score_users(user_facts(users, usage, tickets, AS_OF)), "score")


def test_stream_equals_batch(spark, make, tmp_path):
    users = make.users(*[dict(user_id=f"u{i}") for i in range(12)])
    early = make.usage(*[dict(user_id=f"u{i}", adoption_level="activated") for i in range(10)])
    used = make.usage(dict(user_id="u0", adoption_level="used_5x"),
                      dict(user_id="u11", adoption_level="used_1x"))
    day = dt.date(2025, 2, 1)
    opened = [dict(user_id=f"u{i % 5}", ticket_id=f"T{i}", status="Open", priority="High",
                   created_date=day + dt.timedelta(days=i)) for i in range(9)]
    closed = [dict(r, status="Closed", csat_score=1) for r in opened[:4]]

    refresh = ScoreRefresh(spark, str(tmp_path / "state"), AS_OF, buckets=4)
    refresh.seed(users, early, make.tickets(*opened[:2]))
    assert by_user(refresh.current_scores(), "score") == batch_scores(
        users, early, make.tickets(*opened[:2]))

    for i, part in enumerate((opened[:5], opened[3:9], closed)):  # part 1 repeats two tickets
        make.tickets(*part).coalesce(1).write.parquet(str(tmp_path / f"tickets/{i}"))
    used.coalesce(1).write.parquet(str(tmp_path / "usage/0"))

    def stream(schema, name):
        return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
                .option("recursiveFileLookup", True).parquet(str(tmp_path / name)))

    changes = change_stream(stream(SUPPORT_TICKETS, "tickets"), stream(FEATURE_USAGE, "usage"))
    refresh.start(changes, str(tmp_path / "checkpoint")).awaitTermination()

    final_usage = make.usage(
        dict(user_id="u0", adoption_level="used_5x"),
        dict(user_id="u11", adoption_level="used_1x"),
        *[dict(user_id=f"u{i}", adoption_level="activated") for i in range(1, 10)])
    want = batch_scores(users, final_usage, make.tickets(*closed, *opened[4:]))
    assert by_user(refresh.current_scores(), "score") == want

    compacted = refresh.compact(str(tmp_path / "next"), upto=100)
    assert by_user(compacted.current_scores(), "score") == want


def test_retried_batch_changes_nothing(spark, make, tmp_path):
    users = make.users(*[dict(user_id=f"u{i}") for i in range(4)])
    refresh = ScoreRefresh(spark, str(tmp_path), AS_OF, buckets=2)
    refresh.seed(users, make.usage(), make.tickets())
    changes = change_stream(tickets=make.tickets(
        dict(user_id="u1", ticket_id="T1", status="Open"),
        dict(user_id="u1", ticket_id="T1", status="Resolved", csat_score=2),
        dict(user_id="ghost", ticket_id="T2", status="Open")))
    refresh.process(changes, 0)
    once = by_user(refresh.current_scores(), "score")
    refresh.process(changes, 0)
    assert by_user(refresh.current_scores(), "score") == once == {
        "u0": 0, "u1": 15, "u2": 0, "u3": 0}


def test_only_touched_users_are_rescored(spark, make, tmp_path):
    users = make.users(*[dict(user_id=f"u{i}") for i in range(20)])
    refresh = ScoreRefresh(spark, str(tmp_path), AS_OF, buckets=4)
    refresh.seed(users, make.usage(), make.tickets())
    refresh.process(change_stream(tickets=make.tickets(
        dict(user_id="u3", ticket_id="T1", status="Open"))), 0)
    stored = spark.read.parquet(str(tmp_path / "scores/batch_id=0"))
    assert [r.user_id for r in stored.collect()] == ["u3"]


def test_empty_batch(spark, make, tmp_path):
    refresh = ScoreRefresh(spark, str(tmp_path), AS_OF, buckets=2)
    refresh.seed(make.users(dict(user_id="a")), make.usage(), make.tickets())
    refresh.process(change_stream(tickets=make.tickets()), 0)
    assert by_user(refresh.current_scores(), "score") == {"a": 0}


def test_later_versions_win_whatever_their_status(spark, make, tmp_path):
    from pyspark.sql import functions as F

    refresh = ScoreRefresh(spark, str(tmp_path), AS_OF, buckets=2)
    refresh.seed(make.users(dict(user_id="a")), make.usage(), make.tickets())
    closed = make.tickets(dict(user_id="a", ticket_id="T", status="Closed", priority="Critical"))
    again = make.tickets(dict(user_id="a", ticket_id="T", status="Open", priority="Critical"))
    versions = closed.withColumn("version", F.lit(1)).unionByName(again.withColumn("version", F.lit(2)))
    refresh.process(change_stream(tickets=versions), 0)
    assert by_user(refresh.current_scores(), "score") == {"a": 25}


def test_users_arrive_and_change(spark, make, tmp_path):
    refresh = ScoreRefresh(spark, str(tmp_path), AS_OF, buckets=2)
    refresh.seed(make.users(dict(user_id="a")), make.usage(), make.tickets())
    refresh.process(change_stream(tickets=make.tickets(
        dict(user_id="late", ticket_id="T", status="Open", priority="Critical"))), 0)
    assert [(r.user_id, r.batch_id) for r in refresh.rejects().collect()] == [("late", 0)]
    refresh.process(change_stream(users=make.users(
        dict(user_id="late"), dict(user_id="a", plan="Free", mrr_usd=0))), 1)
    assert by_user(refresh.current_scores(), "score") == {"a": 10, "late": 25}
    compacted = refresh.compact(str(tmp_path / "next"), upto=9)
    assert by_user(compacted.current_scores(), "score") == {"a": 10, "late": 25}


def test_last_versions_meet_their_users_in_one_shuffle(spark, make):
    """Rows of one ticket are together once they are the last ones: they are not dealt out again."""
    from pyspark.sql import functions as F

    rows = make.tickets(*[dict(user_id="a", ticket_id=f"T{i}") for i in range(3)])
    stored = rows.withColumns({"batch_id": F.lit(0), "version": F.lit(None).cast("bigint")})
    last = latest(stored, "support_tickets").drop("version")
    assert last.columns == SUPPORT_TICKETS.names
    text = tickets_by_user(last)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert not [d for d in dealt if "user_id" in d and "ticket_id" in d], dealt


def test_batches_do_not_grow_with_the_files_of_a_table(spark, monkeypatch, tmp_path):
    from stayline.plans import queries

    inputs = testdata.load(spark, SMALL)
    monkeypatch.setattr(queries.testdata, "load", lambda *_: inputs._replace(
        support_tickets=inputs.support_tickets.repartition(12)))
    monkeypatch.setattr(queries, "shared_dir", lambda _, purpose: str(tmp_path / purpose))
    found = queries.QUERIES["stream_score_refresh"](spark, SMALL)
    want = scoring.score_users(user_facts(*inputs, testdata.AS_OF))
    assert by_user(found, "score") == by_user(want, "score")
    batches = [p.name for p in (tmp_path / "stream/state/scores").iterdir() if p.name[:6] == "batch_"]
    assert sorted(batches) == ["batch_id=-1", "batch_id=0", "batch_id=1"]

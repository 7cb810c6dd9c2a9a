import datetime as dt

import pytest

from conftest import AS_OF, by_user
from stayline.plans.analysis import run_analysis
from stayline.sources.snapshots import PublishConflict, Snapshots
from stayline.sources.tables import LOOKUPS, ResultTables, save_clustered, save_lookup, upsert

SCORES = "user_id string, score long, risk_level string, reasons string, analyzed_at timestamp_ntz"


def scores(spark, *rows):
    return spark.createDataFrame([(u, s, r, "x", None) for u, s, r in rows], SCORES)


def counts(run):
    return {name: df.count() for name, df in run._asdict().items()}


def test_repeated_run_leaves_no_old_rows(spark, tmp_path):
    tables = ResultTables(spark, str(tmp_path))
    day = dt.date(2025, 1, 6)
    tables.write_run("churn_scores", scores(spark, ("a", 60, "alto"), ("b", 1, "bajo")), day)
    tables.write_run("churn_scores", scores(spark, ("a", 5, "bajo"), ("b", 1, "bajo")), day)
    assert by_user(tables.read("churn_scores"), "risk_level", "run_date") == {
        "a": ("bajo", day), "b": ("bajo", day)}
    later = dt.date(2025, 1, 13)
    tables.write_run("churn_scores", scores(spark, ("a", 9, "bajo")), later)
    assert tables.read("churn_scores").count() == 3


def test_upsert(spark):
    old = scores(spark, ("a", 1, "bajo"), ("b", 2, "bajo"))
    new = scores(spark, ("b", 60, "alto"), ("c", 30, "medio"))
    merged = upsert(old, new)
    assert by_user(merged, "score") == {"a": 1, "b": 60, "c": 30}
    assert by_user(upsert(merged, new), "score") == by_user(merged, "score")


def test_upsert_takes_the_last_change_of_a_key(spark):
    from pyspark.sql import functions as F

    old = scores(spark, ("a", 1, "bajo"))
    first, last = scores(spark, ("a", 3, "bajo")), scores(spark, ("a", 2, "bajo"), ("a", 2, "bajo"))
    changes = first.withColumn("v", F.lit(1)).unionByName(last.withColumn("v", F.lit(2)))
    assert [r.score for r in upsert(old, changes, version="v").collect()] == [2]
    assert [r.score for r in upsert(old, first.unionByName(last)).collect()] == [3]


def test_reports_of_one_date_are_kept_side_by_side(spark, tmp_path):
    tables = ResultTables(spark, str(tmp_path))
    day = dt.date(2025, 1, 6)
    for name, score in (("weekly", 1), ("extra", 2), ("extra", 3)):
        tables.write_run("weekly_reports", scores(spark, ("a", score, "x")), day, report=name)
    assert sorted((r.report, r.score) for r in tables.read("weekly_reports").collect()) == [
        ("extra", 3), ("weekly", 1)]


def test_chained_run_twice(spark, make, tmp_path):
    users = make.users(dict(user_id="a"), dict(user_id="b", plan="Free", mrr_usd=0))
    usage = make.usage(dict(user_id="a", last_used_date=AS_OF - dt.timedelta(days=100)))
    tickets = make.tickets(dict(user_id="a", ticket_id="T1", status="Open", priority="Critical"))
    tables = ResultTables(spark, str(tmp_path))
    first = counts(run_analysis(tables, users, usage, tickets, AS_OF))
    second = counts(run_analysis(tables, users, usage, tickets, AS_OF))
    assert first == second == {
        "churn_scores": 2, "recommendations": 1, "alert_queue": 1, "alert_digest": 1,
        "weekly_reports": 1}
    assert tables.read("recommendations").select("urgency").first()[0] == "inmediata"


def test_run_stores_an_ordered_list_and_a_lookup(spark, make, tmp_path):
    users = make.users(*[dict(user_id=f"u{i:02d}") for i in range(30)])
    tickets = make.tickets(*[
        dict(user_id=f"u{i:02d}", ticket_id=f"T{i}-{n}", status="Open", priority="Critical")
        for i in range(20) for n in range(1 + i % 3)])
    tables = ResultTables(spark, str(tmp_path))
    run_analysis(tables, users, make.usage(), tickets, AS_OF)
    files = sorted((tmp_path / "risk_list").rglob("part-*.parquet"))
    ranked = [r.score for f in files for r in spark.read.parquet(str(f)).collect()]
    assert ranked == sorted(ranked, reverse=True) and len(ranked) == 13
    lookup = tables.read("profile_lookup").where("user_id = 'u07'")
    assert lookup.count() == 1
    assert "EqualTo(user_id,u07)" in lookup._jdf.queryExecution().executedPlan().toString()


def test_chained_run_without_risky_users(spark, make, tmp_path):
    tables = ResultTables(spark, str(tmp_path))
    run = run_analysis(tables, make.users(dict(user_id="a")), make.usage(dict(user_id="a")),
                       make.tickets(), AS_OF)
    assert counts(run) == {
        "churn_scores": 1, "recommendations": 0, "alert_queue": 0, "alert_digest": 0,
        "weekly_reports": 1}


def test_clustered_layout_prunes_and_keeps_rows(spark, make, tmp_path):
    tickets = make.tickets(*[
        dict(ticket_id=f"T{i}", user_id="hot" if i % 3 == 0 else f"u{i}",
             status="Open" if i % 2 else "Closed") for i in range(600)])
    path = str(tmp_path / "tickets")
    save_clustered(tickets, path, ["user_id", "ticket_id"], partition_by="status")
    stored = spark.read.parquet(path)
    assert stored.count() == 600
    lookup = stored.where("status = 'Open' AND user_id = 'hot'")
    plan = lookup._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(status" in plan and "EqualTo(user_id,hot)" in plan


def test_shared_dir_is_the_clusters(spark):
    from stayline.session import shared_dir

    one, two = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert one != two
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert one.startswith(named)
    assert pytest.approx(len(one)) == len(two)


def test_chained_run_from_replies_equals_the_rules(spark, make, tmp_path):
    users = make.users(*[dict(user_id=f"u{i}", plan="Free" if i % 2 else "Plus") for i in range(15)])
    usage = make.usage(*[
        dict(user_id=f"u{i}", last_used_date=AS_OF - dt.timedelta(days=15 * i),
             adoption_level="activated") for i in range(12)])
    tickets = make.tickets(*[
        dict(user_id=f"u{i}", ticket_id=f"T{i}", status="Open", priority="Critical")
        for i in range(5, 9)])
    ruled = run_analysis(ResultTables(spark, str(tmp_path / "a")), users, usage, tickets, AS_OF)
    given = run_analysis(
        ResultTables(spark, str(tmp_path / "b")), users, usage, tickets, AS_OF,
        scores=ruled.churn_scores, recommendations=ruled.recommendations.drop("created_at"))
    for one, other in zip(ruled, given):
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    assert ruled.alert_queue.count() > 0


def test_queue_from_stored_tables_reads_one_urgency_folder(spark, make, tmp_path):
    from stayline.operators import alerts

    tables = ResultTables(spark, str(tmp_path))
    users = make.users(dict(user_id="a"), dict(user_id="b"))
    tickets = make.tickets(*[dict(user_id="a", ticket_id=f"T{i}", status="Open",
                                  priority="Critical") for i in range(3)])
    run = run_analysis(tables, users, make.usage(), tickets, AS_OF)
    joined = alerts.join_results(run.churn_scores, run.recommendations, users)
    queue = alerts.alert_queue(joined)
    assert [r.user_id for r in queue.collect()] == ["a"]
    plan = queue._jdf.queryExecution().executedPlan().toString()
    assert "urgency" in plan.split("PartitionFilters: [")[1]


def test_a_killed_run_leaves_the_former_tables_whole(spark, make, tmp_path, monkeypatch):
    users = make.users(dict(user_id="a"), dict(user_id="b"))
    tables = ResultTables(spark, str(tmp_path))
    run_analysis(tables, users, make.usage(), make.tickets(), AS_OF)
    names = ("risk_profiles", "churn_scores", "profile_lookup", "recommendations", "weekly_reports")
    before = {n: sorted(map(str, tables.read(n).collect())) for n in names}
    open_now = make.tickets(*[dict(user_id="a", ticket_id=f"T{i}", status="Open", priority="Critical")
                              for i in range(3)])
    kept = ResultTables.write_run
    for last in ("churn_scores", "recommendations", "weekly_reports"):
        def dies(self, table, *args, last=last, **more):
            if table == last:
                raise KeyboardInterrupt
            return kept(self, table, *args, **more)

        monkeypatch.setattr(ResultTables, "write_run", dies)
        with pytest.raises(KeyboardInterrupt):
            run_analysis(tables, users, make.usage(), open_now, AS_OF)
        assert {n: sorted(map(str, tables.read(n).collect())) for n in names} == before
    monkeypatch.setattr(ResultTables, "write_run", kept)
    run_analysis(tables, users, make.usage(), open_now, AS_OF)
    assert by_user(tables.read("churn_scores"), "score") == {"a": 75, "b": 0}


def test_readers_keep_their_version_and_old_folders_expire(spark, tmp_path):
    tables = ResultTables(spark, str(tmp_path))
    days = [dt.date(2025, 1, 6), dt.date(2025, 1, 13)]
    tables.write_run("churn_scores", scores(spark, ("a", 1, "bajo")), days[0])
    first = tables.snapshots.current()
    old = tables.snapshots.read("churn_scores", first)
    with tables.publishing():
        tables.write_run("churn_scores", scores(spark, ("a", 2, "bajo")), days[0])
        tables.write_run("churn_scores", scores(spark, ("a", 3, "bajo")), days[1])
        assert [r.score for r in tables.read("churn_scores").collect()] == [1]
    assert [r.score for r in old.collect()] == [1]
    assert sorted(r.score for r in tables.read("churn_scores").collect()) == [2, 3]
    assert tables.snapshots.current(first.version) == first
    assert tables.snapshots.expire(keep=1) == 0  # too young
    assert tables.snapshots.expire(keep=2, older_than=dt.timedelta()) == 0  # both versions are kept
    assert tables.snapshots.expire(keep=1, older_than=dt.timedelta()) == 2  # a folder and a list
    assert sorted(r.score for r in tables.read("churn_scores").collect()) == [2, 3]
    with pytest.raises(LookupError):
        tables.snapshots.current(first.version)


def test_a_second_writer_is_refused(spark, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    base = snapshots.current()
    assert base == (0, {}, "", {})
    snapshots.publish(base, {("t", "p"): "w1"}, note="first")
    with pytest.raises(PublishConflict):
        snapshots.publish(base, {("t", "p"): "w2"})
    now = snapshots.current()
    assert (now.version, now.parts, now.note) == (1, {("t", "p"): "w1"}, "first")
    now = snapshots.publish(now, {}, drop=[("t", "p")])
    assert snapshots.current() == now == (2, {}, "first", {})
    with pytest.raises(LookupError):
        snapshots.read("t")


def test_any_report_name_is_a_name(spark, tmp_path):
    tables = ResultTables(spark, str(tmp_path))
    for name in ("a/b", "x=y z", "año %41"):
        tables.write_run("weekly_reports", scores(spark, (name, 1, "x")), dt.date(2025, 1, 6), report=name)
    assert sorted((r.user_id, r.report) for r in tables.read("weekly_reports").collect()) == sorted(
        (n, n) for n in ("a/b", "x=y z", "año %41"))


def rows_scanned(df):
    """Rows of the row groups that a lookup had to read, and its result."""
    result = df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value(), result


def test_a_lookup_reads_a_small_share(spark, tmp_path):
    from pyspark.sql import functions as F

    n, path = 60_000, str(tmp_path / "tickets")
    status = F.element_at(F.array(*map(F.lit, ("Open", "In_Progress", "Resolved", "Closed"))),
                          (F.col("id") % 4 + 1).cast("int"))
    tickets = spark.range(n).select(
        F.concat(F.lit("T"), "id").alias("ticket_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 5000)).alias("user_id"),
        status.alias("status"), F.date_add(F.lit("2024-01-01"), (F.col("id") * 7919 % 730).cast("int")).alias("created_date"),
    )
    save_lookup(tickets, path, LOOKUPS["support_tickets"], files=64)
    stored = spark.read.parquet(path)
    assert stored.count() == n and stored.columns == tickets.columns
    read, found = rows_scanned(stored.where("user_id = 'u4321'"))
    assert len(found) == tickets.where("user_id = 'u4321'").count() and read <= 0.2 * n
    month = "status = 'Closed' AND created_date BETWEEN '2024-03-01' AND '2024-03-31'"
    read, found = rows_scanned(stored.where(month))
    assert len(found) == tickets.where(month).count() > 0 and read <= 0.25 * n
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 3 * n / 64  # the hot user fills many files


def test_lookups_of_all_tables_keep_their_rows(spark, make, tmp_path):
    usage = make.usage(dict(user_id="a"), dict(user_id=None, feature="other", last_used_date=None))
    for name, df in (("feature_usage", usage), ("feature_usage", usage.limit(0)),
                     ("churn_scores", scores(spark, ("a", 1, "bajo"), ("b", None, None)))):
        path = str(tmp_path / f"{name}{df.count()}")
        save_lookup(df, path, LOOKUPS[name])
        assert sorted(map(str, spark.read.schema(df.schema).parquet(path).collect())) == sorted(map(str, df.collect()))

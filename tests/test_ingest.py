import datetime as dt

import pytest

from stayline.operators import ingest
from stayline.sources import csv_files
from stayline.schemas import SUPPORT_TICKETS

USERS_CSV = """user_id,country,plan,signup_date,source,mrr_usd,churn_risk_score,features_count
USR-1,México,Pro,2024-01-05,Paid,10.50,0.15,3
USR-2,"Panamá",Free,2024-02-05,Social,0,0.95,1
USR-3,Colombia,,2024-02-05,Social,0,0.95,1
USR-4,Colombia,Pro,05/02/2024,Social,0,0.95,x
USR-5,Colombia,Pro
"""
USAGE_CSV = """user_id,feature,adoption_level,last_used_date
USR-1,Nómina,used_5x,2025-01-01
USR-9,Nómina,used_5x,2025-01-01
"""
TICKETS_CSV = """ticket_id,user_id,category,priority,channel,created_date,resolved_date,status,resolution_hours,csat_score
TKT-1,USR-1,Bug,High,Chat,2025-01-01,,Open,,
TKT-2,USR-1,Bug,High,Chat,2025-01-01,"",Open,"  ",""
TKT-3,USR-2,Bug,High,Chat,2025-01-01,2025-01-04,Closed, 72 ,9
TKT-4,USR-2,Bug,High,Chat,bad,2025-01-04,Closed,72,4
TKT-5,USR-8,Bug,High,Chat,2025-01-01,2025-01-04,Closed,72,4
"""


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("csv")
    paths = []
    for name, text in (("u", USERS_CSV), ("f", USAGE_CSV), ("t", TICKETS_CSV)):
        path = root / f"{name}.csv"
        path.write_text(text, encoding="utf-8")
        paths.append(str(path))
    return csv_files.load_all(spark, *paths)


def test_accepted_rows_are_typed(loaded):
    users = {r.user_id: r for r in loaded.users.collect()}
    assert set(users) == {"USR-1", "USR-2"}
    assert users["USR-1"].signup_date == dt.date(2024, 1, 5)
    assert str(users["USR-1"].mrr_usd) == "10.50" and users["USR-2"].country == "Panamá"
    tickets = {r.ticket_id: r for r in loaded.support_tickets.collect()}
    assert set(tickets) == {"TKT-1", "TKT-2", "TKT-3"}
    assert tickets["TKT-2"].resolution_hours is None and tickets["TKT-2"].csat_score is None
    assert tickets["TKT-3"].resolution_hours == 72
    assert loaded.support_tickets.schema == SUPPORT_TICKETS


def test_rejects_name_field_and_reason(loaded):
    rows = {(r.table_name, r.row_key, r.column_name, r.reason) for r in loaded.rejects.collect()}
    assert rows == {
        ("users", "USR-3", "plan", "missing"),
        ("users", "USR-4", "signup_date", "bad_value"),
        ("users", "USR-4", "features_count", "bad_value"),
        ("users", "USR-5", "*", "malformed_line"),
        ("feature_usage", "USR-9", "user_id", "unknown_user"),
        ("support_tickets", "TKT-4", "created_date", "bad_value"),
        ("support_tickets", "TKT-5", "user_id", "unknown_user"),
    }


def test_usage_key_is_stable(loaded):
    first, again = loaded.feature_usage.collect(), loaded.feature_usage.collect()
    assert first == again and first[0].id is not None


def test_white_space_counts_as_blank(spark):
    raw = spark.createDataFrame(
        [("T1", "\t\n", " 2025-01-01\r\n"), ("T2", " 5", "")], "a string, b string, c string"
    )
    from pyspark.sql import types as T

    schema = T.StructType([
        T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()),
        T.StructField("c", T.DateType()),
    ])
    assert [tuple(r) for r in ingest.clean_blanks(raw, schema).collect()] == [
        ("T1", None, dt.date(2025, 1, 1)), ("T2", 5, None)
    ]


def test_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 3)], "k string, v int")
    rejects = spark.createDataFrame([("v",), ("v",)], "column_name string")
    want = {"k": (3, 0, 2, "a", "b", 0), "v": (3, 1, 2, "1", "3", 2)}
    for exact in (["k", "v"], None):
        got = ingest.profile(df, rejects, exact=exact).collect()
        assert {r.column_name: tuple(r)[1:] for r in got} == want


def test_profile_orders_numbers_as_numbers(spark):
    df = spark.createDataFrame([(9,), (10,), (335,)], "v int")
    row = ingest.profile(df).first()
    assert (row.min_value, row.max_value) == ("9", "335")


def test_partial_dates_are_bad_values(spark):
    raw = spark.createDataFrame(
        [("u", "f", "used_1x", d) for d in ("2025", "2025-02", "2025-02-03", "2025-02-30")],
        "user_id string, feature string, adoption_level string, last_used_date string")
    split = ingest.split_rejects(raw, "feature_usage")
    assert [str(r.last_used_date) for r in split.accepted.collect()] == ["2025-02-03"]
    assert {r.raw_value for r in split.rejects.collect()} == {"2025", "2025-02", "2025-02-30"}


def test_repeated_keys_load_once(spark, make):
    rows = make.users(dict(user_id="a", plan="Pro"), dict(user_id="a", plan="Plus"),
                      dict(user_id="b"), dict(user_id="b"), dict(user_id="c"))
    split = ingest.split_duplicates(rows, "users")
    assert sorted((r.user_id, r.plan) for r in split.accepted.collect()) == [
        ("a", "Plus"), ("b", "Pro"), ("c", "Pro")]
    assert sorted((r.row_key, r.reason) for r in split.rejects.collect()) == [
        ("a", "duplicate_key"), ("b", "duplicate_key")]


def test_header_in_another_order_fails_loudly(spark, tmp_path):
    lines = USAGE_CSV.splitlines()
    lines[0] = "feature,user_id,adoption_level,last_used_date"
    (tmp_path / "f.csv").write_text("\n".join(lines), encoding="utf-8")
    with pytest.raises(Exception, match="CSV header"):
        csv_files.load_feature_usage(spark, str(tmp_path / "f.csv")).accepted.collect()


def write_csvs(folder, users, usage, tickets):
    from stayline.schemas import FEATURE_USAGE, SUPPORT_TICKETS, USERS

    folder.mkdir()
    paths = []
    for name, schema, rows in (("u", USERS, users), ("f", FEATURE_USAGE, usage), ("t", SUPPORT_TICKETS, tickets)):
        path = folder / f"{name}.csv"
        path.write_text("\n".join([",".join(schema.names), *rows]), encoding="utf-8")
        paths.append(str(path))
    return paths


def test_a_further_load_checks_the_keys_of_those_before(spark, tmp_path):
    user = "{},Colombia,Pro,2024-01-01,Paid,50.00,0.50,3".format
    ticket = "{},{},Bug,Low,Chat,2025-01-01,,Open,,".format
    use = "{},Inventario,used_1x,2025-01-01".format
    index = csv_files.KeyIndex(spark, str(tmp_path / "keys"))
    first = index.load("one", *write_csvs(
        tmp_path / "a", [user("a"), user("b")], [use("a"), use("a")], [ticket("T1", "a")]))
    assert first.rejects.collect() == []
    ids = [r.id for r in first.feature_usage.collect()]
    assert len(set(ids)) == 2  # equal rows have keys of their own
    second = index.load("two", *write_csvs(
        tmp_path / "b", [user("b"), user("c")], [use("a"), use("nobody")],
        [ticket("T1", "c"), ticket("T2", "b"), ticket("T3", "c"), ticket("T4", "zz")]))
    assert sorted(r.user_id for r in second.users.collect()) == ["c"]
    assert sorted(r.ticket_id for r in second.support_tickets.collect()) == ["T2", "T3"]
    assert second.feature_usage.count() == 1
    assert {(r.table_name, r.row_key, r.reason) for r in second.rejects.collect()} == {
        ("users", "b", "loaded_before"), ("support_tickets", "T1", "loaded_before"),
        ("support_tickets", "T4", "unknown_user"), ("feature_usage", "nobody", "unknown_user")}
    assert sorted(index.holds("support_tickets", "T1", "T3", "T9")) == ["T1", "T3"]
    with pytest.raises(ValueError, match="two"):
        index.load("two", *write_csvs(tmp_path / "c", [], [], []))


def test_a_load_that_dies_adds_no_keys(spark, tmp_path, monkeypatch):
    paths = write_csvs(tmp_path / "a", ["a,Colombia,Pro,2024-01-01,Paid,50.00,0.50,3"], [], [])
    index = csv_files.KeyIndex(spark, str(tmp_path / "keys"))

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(index.snapshots, "publish", dies)
    with pytest.raises(KeyboardInterrupt):
        index.load("one", *paths)
    monkeypatch.undo()
    assert index.holds("users", "a") == []
    assert index.load("one", *paths).users.count() == 1 and index.holds("users", "a") == ["a"]


def test_each_file_is_scanned_once(spark, tmp_path):
    loaded = csv_files.load_all(spark, *write_csvs(tmp_path / "a", [], [], []))
    for df in loaded:
        assert "csv" not in df._jdf.queryExecution().executedPlan().toString().lower().replace("csat", "")


def test_each_step_of_a_load_runs_once(spark, tmp_path):
    """Rows loaded and rejects read stored steps; neither groups or joins them again."""
    user = "{},Colombia,Pro,2024-01-01,Paid,50.00,0.50,3".format
    ticket = "{},{},Bug,Low,Chat,2025-01-01,,Open,,".format
    loaded = csv_files.load_all(spark, *write_csvs(
        tmp_path / "a", [user("a"), user("a"), user("b")], ["a,Inventario,used_1x,2025-01-01"],
        [ticket("T1", "a"), ticket("T1", "a"), ticket("T2", "zz")]))
    for df in loaded:
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in text and "Aggregate" not in text and "Exchange" not in text
    assert {(r.table_name, r.row_key, r.reason) for r in loaded.rejects.collect()} == {
        ("users", "a", "duplicate_key"), ("support_tickets", "T1", "duplicate_key"),
        ("support_tickets", "T2", "unknown_user")}
    assert [df.count() for df in loaded[:3]] == [2, 1, 1]


def test_a_key_may_repeat_and_be_loaded_before(spark, make):
    rows = make.users(dict(user_id="a", plan="Pro"), dict(user_id="a", plan="Plus"), dict(user_id="b"))
    keys = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "key string")
    keyed = ingest.keyed_rows(rows, "users", keys)
    assert sorted((r.user_id, r.plan, r.n, r.held) for r in keyed.collect()) == [
        ("a", "Plus", 2, True), ("b", "Pro", 1, False)]
    split = ingest.split_keyed(keyed, "users")
    assert split.accepted.columns == rows.columns
    assert [r.user_id for r in split.accepted.collect()] == ["b"]
    assert sorted((r.row_key, r.reason) for r in split.rejects.collect()) == [
        ("a", "duplicate_key"), ("a", "loaded_before")]


def test_children_meet_lost_users_unshuffled(spark, make):
    children = make.usage(dict(user_id="a"), dict(user_id="a"), dict(user_id="z"), dict(user_id=None))
    users = make.users(dict(user_id="a"), dict(user_id="a"), dict(user_id="c"))
    lost = csv_files.written(ingest.lost_users([children, children], users), "lost")
    assert sorted(r.user_id or "" for r in lost.collect()) == ["", "z"]
    owned = ingest.owned_rows(children, lost.union(lost))
    assert "SortMergeJoin" not in owned._jdf.queryExecution().executedPlan().toString()
    split = ingest.split_owned(owned, "feature_usage")
    assert [r.user_id for r in split.accepted.collect()] == ["a", "a"]
    assert sorted(r.row_key or "" for r in split.rejects.collect()) == ["", "z"]
    assert split.accepted.columns == children.columns


def test_rows_without_faults_build_no_list(spark):
    raw = spark.createDataFrame([("u", "f", "x", "2025-01-01"), ("u", "", "x", "bad")], "user_id string, "
                                "feature string, adoption_level string, last_used_date string")
    checked = ingest.checked_rows(raw, "feature_usage")
    assert [[f.column_name for f in r.faults] for r in checked.collect()] == [[], ["feature", "last_used_date"]]
    assert "CASE WHEN isnotnull(coalesce(" in checked._jdf.queryExecution().optimizedPlan().toString()

"""Plans at scale: what the queries must and must not contain."""

import re

import pytest

from conftest import SMALL
from stayline.plans.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """As with tables too large to broadcast: only hinted broadcasts remain."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


WRITES = {
    "load_users", "load_feature_usage", "load_support_tickets", "report_history", "run_analysis",
    "insert_results", "stream_score_refresh", "load_all_rejects", "run_from_replies",
    "top_from_tables", "risk_list", "load_twice_rejects", "live_scores", "resolution_sketches",
}
# Windows of the other queries run by bucket; these run over rows that are few by design.
WINDOWS = {
    "risk_history": "user_id",  # one row a run
    "time_in_band": "user_id",
    "score_agreement": "part",  # distinct values of one range
    "agreement_deciles": "part",
    "profile_drift": "column_name",  # one row a load
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plan_shape(no_broadcast, name):
    text = plan(QUERIES[name](no_broadcast, SMALL))
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert "Python" not in text and "ArrowEval" not in text
    for window in re.findall(r"Window \[[^\n]*", text):
        assert re.search(rf"\], \[{WINDOWS.get(name, 'bucket')}#", window), window
    broadcasts = text.count("BroadcastExchange")
    assert broadcasts <= 3, "only the per-plan fit table may be broadcast"


def test_top_list_sorts_no_whole_table(no_broadcast):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_risk_clients"](no_broadcast, SMALL))


def test_summary_shuffles_each_table_once(no_broadcast, make):
    from conftest import AS_OF
    from stayline.operators.summary import user_summary

    df = user_summary(
        make.users(dict(user_id="a")), make.usage(dict(user_id="a")),
        make.tickets(dict(user_id="a", ticket_id="T")), AS_OF, closed=True)
    assert plan(df).count("Exchange hashpartitioning(user_id") == 3
    assert plan(df).count("Exchange") == 3


def test_scans_read_needed_columns_only(spark):
    text = plan(QUERIES["open_tickets_summary"](spark, SMALL))
    assert "o_orderdate" not in text and "o_custkey" not in text and "o_totalprice" not in text


@pytest.mark.parametrize("name", [
    "user_summary", "churn_scores", "churn_reasons_text", "recommendations", "alert_queue",
    "report_rollup", "ingest_rejects", "parse_scoring_replies", "top_risk_clients",
])
def test_generated_methods_stay_compilable(spark, name, capsys):
    """The JVM leaves methods of more than 8000 bytes uncompiled."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        QUERIES[name](spark, SMALL).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert max(sizes) < 8000

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest

from conftest import AS_OF
from stayline.operators import agreement, drift, history, quality, resolution

RUNS = [dt.date(2025, 1, 6), dt.date(2025, 1, 13), dt.date(2025, 1, 20), dt.date(2025, 1, 27)]


@pytest.fixture(scope="module")
def runs(spark):
    """Levels by run; None where a run leaves the user out."""
    levels = {
        "steady": ["bajo"] * 4, "moves": ["bajo", "medio", "medio", "alto"],
        "gap": ["alto", None, "alto", "alto"], "late": [None, None, "medio", "bajo"],
        "left": ["medio", "medio", None, None], "back": ["bajo", "alto", "bajo", "alto"],
    }
    rows = [
        (u, day, 10 * n + len(u), level)
        for u, ls in levels.items() for n, (day, level) in enumerate(zip(RUNS, ls, strict=True)) if level
    ]
    return spark.createDataFrame(rows, "user_id string, run_date date, score long, risk_level string")


def test_stretches_end_with_the_level_and_with_gaps(runs):
    got = {
        (r.user_id, r.valid_from): (r.risk_level, r.valid_to, r.runs_held, r.first_score, r.last_score)
        for r in history.risk_history(runs).collect()
    }
    a, b, c, d = RUNS
    assert got == {
        ("steady", a): ("bajo", None, 4, 6, 36), ("moves", a): ("bajo", b, 1, 5, 5),
        ("moves", b): ("medio", d, 2, 15, 25), ("moves", d): ("alto", None, 1, 35, 35),
        ("gap", a): ("alto", b, 1, 3, 3), ("gap", c): ("alto", None, 2, 23, 33),
        ("late", c): ("medio", d, 1, 24, 24), ("late", d): ("bajo", None, 1, 34, 34),
        ("left", a): ("medio", c, 2, 4, 14), ("back", a): ("bajo", b, 1, 4, 4),
        ("back", b): ("alto", c, 1, 14, 14), ("back", c): ("bajo", d, 1, 24, 24),
        ("back", d): ("alto", None, 1, 34, 34),
    }


def test_transitions(runs):
    got = Counter()
    for r in history.risk_transitions(runs).collect():
        got[r.from_run, r.from_level, r.to_level] += r.users
    a, b, c, _ = RUNS
    assert got == {
        (a, "bajo", "bajo"): 1, (a, "bajo", "medio"): 1, (a, "alto", "ausente"): 1,
        (a, "medio", "medio"): 1, (a, "bajo", "alto"): 1,
        (b, "bajo", "bajo"): 1, (b, "medio", "medio"): 1, (b, "nuevo", "alto"): 1,
        (b, "nuevo", "medio"): 1, (b, "medio", "ausente"): 1, (b, "alto", "bajo"): 1,
        (c, "bajo", "bajo"): 1, (c, "medio", "alto"): 1, (c, "alto", "alto"): 1,
        (c, "medio", "bajo"): 1, (c, "bajo", "alto"): 1,
    }
    changes = {r.score_change for r in history.risk_transitions(runs).collect() if "nuevo" != r.from_level
               and r.to_level != "ausente"}
    assert changes == {10}


def test_time_in_band(runs):
    got = {r.risk_level: tuple(r)[1:] for r in history.time_in_band(history.risk_history(runs), RUNS[3]).collect()}
    assert got["bajo"] == (5, 4, 2, 21 + 7 + 0 + 7 + 7, 21)
    assert got["alto"] == (5, 3, 3, 0 + 7 + 7 + 7 + 0, 7)


def test_no_runs(spark, runs):
    empty = runs.limit(0)
    assert history.risk_history(empty).collect() == history.risk_transitions(empty).collect() == []


# Agreement ---------------------------------------------------------------------------


def both(spark, rows):
    return spark.createDataFrame(
        [(s, level, None if x is None else Decimal(str(x))) for s, level, x in rows],
        "score long, risk_level string, supplied decimal(4,2)")


def test_ranks_share_ties_across_ranges(spark):
    random.seed(1)
    values = [random.choice([None, *range(40), 7, 7, 7]) for _ in range(900)]
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
    present = sorted(v for v in values if v is not None)
    got = {r.v: (r.n, r.below, r.rank2) for r in agreement.doubled_ranks(df, "v").collect()}
    assert got == {
        v: (present.count(v), present.index(v), 2 * present.index(v) + present.count(v) + 1)
        for v in set(present)}


def test_agreement_equals_plain_formulas(spark):
    random.seed(4)
    rows = []
    for _ in range(400):
        score = random.choice([0, 10, 20, 30, 55, 70])
        level = "bajo" if score <= 25 else "medio" if score <= 50 else "alto"
        rows.append((score, level, round(min(0.95, max(0.05, score / 80 + random.gauss(0, 0.3))), 2)))
    got = agreement.score_agreement(both(spark, [*rows, (5, "bajo", None)])).first()

    def ranks(xs):
        order = sorted(xs)
        return [order.index(x) + (order.count(x) + 1) / 2 for x in xs]

    r, s = ranks([a for a, _, _ in rows]), ranks([x for _, _, x in rows])
    mean = (len(rows) + 1) / 2
    cov = sum((a - mean) * (b - mean) for a, b in zip(r, s, strict=True))
    spread = [sum((a - mean) ** 2 for a in xs) for xs in (r, s)]
    assert got.users == 400
    assert got.spearman == pytest.approx(cov / (spread[0] * spread[1]) ** 0.5, rel=1e-12)

    def area(levels):
        hit = [x for _, level, x in rows if level in levels]
        miss = [x for _, level, x in rows if level not in levels]
        return sum((a > b) + (a == b) / 2 for a in hit for b in miss) / (len(hit) * len(miss))

    assert got.auc_high == pytest.approx(area(["alto"]), rel=1e-12)
    assert got.auc_at_risk == pytest.approx(area(["alto", "medio"]), rel=1e-12)


def test_agreement_without_spread(spark):
    one = agreement.score_agreement(both(spark, [(5, "bajo", 0.5), (5, "bajo", 0.5)])).first()
    assert (one.users, one.spearman, one.auc_high) == (2, None, None)
    none = agreement.score_agreement(both(spark, [])).first()
    assert (none.users, none.spearman) == (0, None)
    assert agreement.agreement_deciles(both(spark, [])).collect() == []
    deciles = agreement.agreement_deciles(both(spark, [(i, "bajo", i / 100) for i in range(20)]))
    assert sorted((r.decile, r.users) for r in deciles.collect()) == [(d, 2) for d in range(1, 11)]


# Resolution hours, profiles of loads, declared features ----------------------------------


def test_resolution_hours_and_merged_sketches(spark, make):
    random.seed(9)
    rows = [
        dict(user_id="u", ticket_id=f"T{i}", category=random.choice(["Bug", "Onboarding"]),
             priority=random.choice(["Low", "High"]), channel="Chat",
             resolution_hours=random.choice([None, *range(400)])) for i in range(5000)
    ]
    tickets = make.tickets(*rows)
    got = {(r.grouped_by, r.category, r.priority): r for r in resolution.resolution_hours(tickets).collect()}
    hours = sorted(r["resolution_hours"] for r in rows if r["resolution_hours"] is not None)
    whole = got["", None, None]
    at = 0.9 * (len(hours) - 1)
    low = hours[int(at)]
    assert whole.tickets == len(hours) and whole.longest == 399
    assert whole.p90 == pytest.approx(low + (at % 1) * (hours[int(at) + 1] - low))
    assert len(got) == 1 + 2 + 2 + 1 + 4
    parts = [resolution.hours_sketches(make.tickets(*rows[i::3]), AS_OF) for i in range(3)]
    merged = resolution.hours_from_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    errors = resolution.sketch_errors(tickets, merged).collect()
    assert len(errors) == len(got)
    assert max(max(r.p50_error, r.p90_error, r.p95_error) for r in errors) <= resolution.RANK_ERROR
    means = {(r.grouped_by, r.category, r.priority): (r.tickets, r.mean_hours, r.longest) for r in merged.collect()}
    assert means == {k: (r.tickets, r.mean_hours, r.longest) for k, r in got.items()}


def test_profiles_merge_without_the_loads(spark):
    schema = "k string, n int, d date, m decimal(10,2)"
    rows = [(f"k{i}", i % 7, dt.date(2025, 1, 1) + dt.timedelta(days=i), Decimal(i)) for i in range(900)]
    rows[5] = (None, None, None, None)
    loads = [spark.createDataFrame(rows[i * 300:i * 300 + 400], schema) for i in range(3)]
    profiles = drift.all_loads([drift.load_profile(df, f"load{i}") for i, df in enumerate(loads)])
    merged = {r.column_name: r for r in drift.merged_profile(profiles).collect()}
    assert merged["k"].rows == 400 + 400 + 300 and merged["k"].nulls == 1 and merged["k"].loads == 3
    assert abs(merged["k"].distinct_values - 899) <= 0.05 * 899
    assert (merged["n"].distinct_values, merged["n"].min_number, merged["n"].max_number) == (7, 0, 6)
    assert merged["d"].max_number - merged["d"].min_number == 899
    assert merged["m"].max_number == 89900 and merged["k"].median_number is None
    assert abs(merged["d"].median_number - merged["d"].min_number - 470) < 40
    steps = {(r.load, r.column_name): r for r in drift.profile_drift(profiles).collect()}
    assert abs(steps["load0", "k"].new_values - 399) <= 20 and abs(steps["load1", "k"].new_values - 300) <= 30
    assert steps["load1", "n"].new_values == 0 and steps["load1", "k"].null_share_before == 0.0025


def test_declared_features_against_rows(make):
    users = make.users(
        dict(user_id="same", features_count=2), dict(user_id="few", features_count=5),
        dict(user_id="many", features_count=1), dict(user_id="none", features_count=3),
        dict(user_id="zero", features_count=0), dict(user_id="unsaid", features_count=None))
    usage = make.usage(*[
        dict(user_id=u, feature=f) for u in ("same", "few", "many", "ghost", "unsaid")
        for f in ("Inventario", "Nómina", "Nómina")])
    got = {r.user_id: (r.declared, r.listed, r.fault) for r in quality.features_count_check(users, usage).collect()}
    assert got == {
        "few": (5, 2, "fewer_listed"), "many": (1, 2, "more_listed"), "none": (3, 0, "no_usage"),
        "ghost": (None, 2, "unknown_user"), "unsaid": (None, 2, "not_declared")}

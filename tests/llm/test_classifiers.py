from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest

from stayline.llm import learning, quality_fm, toxicity
from stayline.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}


def held(doc_id, modulus, fold):
    return zlib.crc32(str(doc_id).encode()) % modulus == fold


def test_toxicity_on_held_out_documents(spark, labels):
    rows = QUERIES["op3_toxicity"](spark, MEDIUM).collect()
    assert len(rows) == 1000 and all(r.held_out == held(r.doc_id, 3, 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    judged = [(r.score, r.predicted, labels[r.doc_id].toxic) for r in rows if r.held_out and r.doc_id in labels]
    good = [s for s, _, y in judged if not y]
    bad = [s for s, _, y in judged if y]
    assert np.mean([[b > g for g in good] for b in bad]) > 0.8  # a few hundred rows to learn from
    assert sum(p for _, p, y in judged if not y) <= 0.02 * len(good)


def test_quality_on_held_out_documents(spark, labels):
    rows = QUERIES["op5_quality_classifier"](spark, MEDIUM).collect()
    assert len(rows) == 1000 and all(r.held_out == held(r.doc_id, 5, 0) for r in rows)
    judged = [(r.predicted, labels[r.doc_id].quality) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in judged]) > 0.9
    assert all(p for p, y in judged if y)


def test_odd_rows_and_missing_labels(spark, docs, odd_texts):
    frame = docs([*enumerate(odd_texts), (None, "no id")], extra=["score", "label", "place"])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    some = spark.createDataFrame([(3, 1, 1), (3, 0, 0), (4, None, None), (5, 1, 1), (6, 0, 0), (7, 1, 0)], none.schema)
    for table in (none, some):
        weights, model = toxicity.fit(frame, table), quality_fm.fit(frame, table)
        for scored in (toxicity.score(frame, weights, {"doc_id": "bigint", "score": "string"}, name="p"),
                       quality_fm.score(frame, model, {"doc_id": "bigint", "score": "string"}, name="p")):
            rows = scored.collect()
            assert len(rows) == len(odd_texts) + 1 and all(0 <= r.p <= 1 and r.score == "own" for r in rows)
            by_id = {r.doc_id: r.p for r in rows}
            assert by_id[5] == by_id[6] and by_id[0] == by_id[1]
    assert toxicity.score(docs([]), weights, {"doc_id": "bigint"}).collect() == []


def test_sample_is_bounded_and_ignores_the_held_out(spark, docs):
    frame = docs([f"text {i}" for i in range(300)] + [(1, "text 0")])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(300)], "doc_id bigint, quality int, toxic int")
    rows = learning.labelled_sample(frame, labels, "toxic", learning.fold(3) != 1, max_rows=50).collect()
    assert len(rows) == 50 and not any(held(r.doc_id, 3, 1) for r in rows)


def test_sample_is_bounded_in_bytes(spark):
    sizes = {i: 10 + 7 * (i % 5) for i in range(60)} | {60: 63, 61: 62}
    rows = spark.createDataFrame([(i, b"x" * n) for i, n in sizes.items()], "doc_id bigint, features binary")
    kept = [r.doc_id for r in learning.within_bytes(rows, "features", max_bytes=1000).collect()]
    assert 60 not in kept and len(kept) == len(set(kept))  # 63 is more than a sixteenth
    used = sum(sizes[i] for i in kept)
    assert 1000 - 63 < used <= 1000
    assert {r.doc_id for r in learning.within_bytes(rows, "features").collect()} == set(sizes)


WORDS = "good bad worse kind words of a text that is short and plain".split()


def labelled_rows(n=150):
    """Random texts; the label follows one word and one pair of words."""
    rng = random.Random(11)
    rows = []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.randint(0, 12))
        rows.append((i, " ".join(words), int("worse" in words or ("bad", "text") in zip(words, words[1:], strict=False))))
    return rows


def test_ftrl_against_a_plain_refit(spark):
    """Every round, row and coordinate written out, one number at a time."""
    rows, bits = labelled_rows(), 10
    sample = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    weights = toxicity.train(sample, bits=bits)
    features, bias = toxicity.featurizer(bits), 1 << bits
    z, n = {}, {}

    def weight(i):
        zi, step = z.get(i, 0.0), (toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA
        if i == bias:
            return -zi / step
        return 0.0 if abs(zi) <= toxicity.L1 else (math.copysign(toxicity.L1, zi) - zi) / (step + toxicity.L2)

    for _ in range(toxicity.ROUNDS):
        for _, text, label in rows:
            places = [*sorted({int(p) for p in features(text)}), bias]
            now = {i: weight(i) for i in places}
            g = 1 / (1 + math.exp(-sum(now.values()))) - label
            for i in places:
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / toxicity.ALPHA * now[i]
                n[i] = old + g * g
    plain = {i: w for i in z if (w := weight(i)) != 0}
    assert len(plain) > 5 and set(plain) == set(weights.place)
    assert all(math.isclose(plain[i], w, rel_tol=1e-6) for i, w in zip(weights.place, weights.weight, strict=True))


def test_machine_against_a_plain_refit(spark, docs):
    """AdaGrad over all pairs, one coordinate at a time, from the same start."""
    rows, bits = [r for r in labelled_rows(60) if not held(r[0], 5, 0)], 6
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id bigint, quality int, toxic int")
    bias, w, v = quality_fm.fit(docs([(i, t) for i, t, _ in rows]), labels, bits=bits)
    features, rank = quality_fm.featurizer(bits), quality_fm.RANK
    size = (1 << bits) + len(quality_fm.STATS) * quality_fm.RANGES
    pw = [0.0] * size
    pv = np.random.default_rng(7).normal(0, 0.05, (size, rank)).tolist()
    gw, gv, pb, gb = [1e-8] * size, [[1e-8] * rank for _ in range(size)], 0.0, 1e-8
    rate, regular = quality_fm.RATE, quality_fm.REGULAR
    for _ in range(quality_fm.EPOCHS):
        for _, text, label in rows:
            place, value = features(text)
            x = list(zip(place.tolist(), value.astype("<f4").astype(float).tolist(), strict=True))
            raw = pb + sum(pw[i] * xi for i, xi in x) + sum(
                sum(a * b for a, b in zip(pv[i], pv[j], strict=True)) * xi * xj
                for k, (i, xi) in enumerate(x) for j, xj in x[k + 1:])
            g = 1 / (1 + math.exp(-raw)) - label
            gb += g * g
            pb -= rate * g / math.sqrt(gb)
            others = {i: [sum(pv[j][f] * xj for j, xj in x if j != i) for f in range(rank)] for i, _ in x}
            for i, xi in x:
                step = g * xi + regular * pw[i]
                gw[i] += step * step
                pw[i] -= rate * step / math.sqrt(gw[i])
                for f in range(rank):
                    step = g * xi * others[i][f] + regular * pv[i][f]
                    gv[i][f] += step * step
                    pv[i][f] -= rate * step / math.sqrt(gv[i][f])
    assert math.isclose(bias, pb, rel_tol=1e-4, abs_tol=1e-4)
    assert np.allclose(w, pw, atol=1e-3) and np.allclose(v, pv, atol=1e-3)
    assert np.abs(w).max() > 0.1


def test_ftrl_update_and_sparsity():
    """One coordinate against the update written out; small sums stay exactly zero."""
    z, n = np.array([toxicity.L1 / 2, -toxicity.L1 - 3.0]), np.array([4.0, 4.0])
    w = toxicity._weights(z, n)
    assert w[0] == 0.0
    assert np.isclose(w[1], 3.0 / ((toxicity.BETA + 2.0) / toxicity.ALPHA + toxicity.L2))


def test_features_cover_words_pairs_and_skips():
    features = toxicity.featurizer(18)
    assert len(features("One two, three")) == 3 + 2 + 1
    assert set(features("ONE two")) == set(features("one TWO!")) and len(features(None)) == 0


def test_factorisation_identity():
    """The linear-time score against the sum over all pairs."""
    rng = np.random.default_rng(1)
    w, v = rng.normal(size=30), rng.normal(size=(30, quality_fm.RANK))
    place, value = np.array([1, 4, 9, 20]), rng.normal(size=4)
    pairs = sum(v[place[i]] @ v[place[j]] * value[i] * value[j] for i in range(4) for j in range(i + 1, 4))
    raw = quality_fm._raw_score(0.3, w, v, place, value)[0]
    assert np.isclose(raw, 0.3 + w[place] @ value + pairs)

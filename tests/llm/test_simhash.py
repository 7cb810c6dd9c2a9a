from __future__ import annotations

import random

import pytest
import xxhash

from stayline.llm import components, simhash
from stayline.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def fingerprint(text, size=3):
    words = [w for w in (text or "").translate(
        {c: c + 32 for c in range(65, 91)}
    ).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + size]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def roots(values, radius):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    values = sorted(values)
    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                parent[find(b)] = find(a)
    return {v: find(v) for v in values}


def expected(rows, radius=2):
    prints = [(i, fingerprint(t)) for i, t in rows]
    root = roots({f for _, f in prints}, radius)
    least = {}
    for i, f in prints:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(((i, f"{f:016x}", least.get(root[f])) for i, f in prints), key=str)


def got(frame):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in frame.collect()), key=str)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert got(QUERIES["op8_simhash_near_dedup"](spark, SMALL)) == expected(rows)


def test_odd_texts(docs, odd_texts):
    rows = [*enumerate(odd_texts), (None, "no id"), (None, "no id"), (3, "one")]
    assert got(simhash.near_duplicates(docs(rows, extra=["fingerprint", "root"]))) == expected(rows)
    assert simhash.near_duplicates(docs([])).collect() == []


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == (2 << radius) - 1
    rng = random.Random(radius)
    for _ in range(2000):
        change = sum(1 << b for b in rng.sample(range(64), rng.randint(0, radius)))
        assert any(change & m == 0 for m in masks)


@pytest.mark.parametrize("radius", [1, 2, 3])
@pytest.mark.parametrize("pairwise", [1, 64])
def test_links_join_the_same_groups(spark, radius, pairwise):
    """Small buckets compared in pairs and large ones by midpoints give the same groups."""
    rng = random.Random(11)
    values = set()
    for _ in range(12):
        value = rng.getrandbits(64)
        for _ in range(12):
            values.add(value)
            value ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius + 1)))
    frame = spark.createDataFrame([(simhash._signed(v),) for v in values], "fingerprint bigint")
    links = simhash.links(frame, radius, pairwise)
    found = {r.node: r.root for r in components.components(links).collect()}
    want = roots(values, radius)
    groups, expected_groups = {}, {}
    for v in values:
        groups.setdefault(found.get(simhash._signed(v), simhash._signed(v)), set()).add(v)
        expected_groups.setdefault(want[v], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected_groups.values()))


def test_components_of_a_long_chain_and_of_nothing(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901)], "a bigint, b bigint")
    rows = {r.node: r.root for r in components.components(chain).collect()}
    assert {rows[i] for i in range(301)} == {0} and rows[901] == rows[900] == 900
    assert components.components(chain.where("a < 0")).collect() == []


def test_one_per_group(docs):
    rows = [(5, "a b c d e f"), (2, "A b c d e f"), (2, "A b c d e f"), (7, "quite another text"),
            (None, "only nulls here"), (None, "only nulls here"), (9, None), (8, "")]
    kept = simhash.one_per_group(docs(rows, extra=["fingerprint"]))
    assert kept.columns[-1] == "fingerprint"
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id IS NOT NULL").collect()) == [
        (2, "A b c d e f"), (7, "quite another text"), (8, "")
    ]
    assert kept.where("doc_id IS NULL").count() == 1

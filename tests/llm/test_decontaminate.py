from __future__ import annotations

import random

import pytest

from stayline.llm import decontaminate
from stayline.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def items(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "item_id bigint, text string")

    return make


def words(start, n):
    return " ".join(f"w{i}" for i in range(start, start + n))


def multiset(tokens):
    parts = [tuple(tokens[i:i + 5]) for i in range(max(1, len(tokens) - 4))] if tokens else []
    return {p: parts.count(p) for p in parts}


def best(text, item):
    """The best multiset Jaccard similarity of any window of the item's size."""
    tokens, want = (text or "").lower().split(), (item or "").lower().split()
    if not tokens or not want:
        return 0.0
    b, top = multiset(want), 0.0
    for start in range(max(1, len(tokens) - len(want) + 1)):
        a = multiset(tokens[start:start + len(want)])
        common = sum(min(n, b.get(p, 0)) for p, n in a.items())
        top = max(top, common / (sum(a.values()) + sum(b.values()) - common))
    return top


def test_query_against_brute_force(spark):
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    want = {(d.doc_id, b.item_id) for d in texts for b in bench if best(d.text, b.text) >= 0.8}
    found = QUERIES["op7_decontamination"](spark, SMALL).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want


def test_exact_edited_and_clean(docs, items):
    item = words(0, 60)
    edited = item.split()
    edited[3] = "changed"  # 4 of 56 shingles differ
    broken = [w if i % 6 else "x" for i, w in enumerate(item.split())]
    frame = docs([
        words(500, 40) + " " + item.upper() + " " + words(700, 30), " ".join(edited),
        " ".join(broken), words(1000, 300), item,
    ])
    rows = {r.doc_id: r for r in decontaminate.findings(frame, items((1, item))).collect()}
    assert sorted(rows) == [0, 1, 4]
    assert rows[0].start_word == 40 and rows[0].similarity == 1.0 and rows[0].hamming == 0
    assert 0.8 <= rows[1].similarity < 1.0
    kept = decontaminate.without_passages(frame, items((1, item)))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3] and kept.columns == frame.columns


def moved(rng, item, how):
    """The item with words moved, put in, taken out or changed."""
    tokens, at = item.split(), rng.randrange(5, 25)
    if how == "swapped":
        half = len(tokens) // 2
        tokens = tokens[half:] + tokens[:half]
    elif how == "rotated":
        tokens = tokens[at:] + tokens[:at]
    elif how == "inserted":
        tokens.insert(at, "extra")
    elif how == "deleted":
        del tokens[at]
    elif how == "changed":
        tokens[at] = "other"
    return " ".join(tokens)


def test_moved_words_are_found_as_brute_force_finds_them(docs, items):
    rng = random.Random(11)
    bench, texts = [], []
    for i in range(40):
        item = words(1000 * i, rng.randrange(30, 60))
        bench.append((i, item))
        for how in ("swapped", "rotated", "inserted", "deleted", "changed", "none"):
            around = [words(500_000 + 1000 * len(texts) + 100 * k, rng.randrange(0, 40)) for k in (1, 2)]
            texts.append(" ".join([around[0], moved(rng, item, how), around[1]]).strip())
    want = {(d, i) for d, text in enumerate(texts) for i, item in bench
            if i == d // 6 and best(text, item) >= 0.8}
    rows = decontaminate.findings(docs(texts), items(*bench)).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(want) > 140
    for r in rows[::7]:
        assert round(r.similarity, 2) > 0.79


def test_shared_phrases_lay_no_windows(spark, docs, items, monkeypatch):
    """A phrase in many items, many times in a text: rows grow with both, not with their product."""
    phrase = words(0, 8)
    bench = items(*((i, f"{phrase} {words(100 * (i + 1), 40)}") for i in range(60)))
    made = {}
    kept = decontaminate.written
    monkeypatch.setattr(
        decontaminate, "written", lambda df, name: made.setdefault(name, kept(df, name)))
    found = decontaminate.findings(docs([f"{phrase} filler " * 300, words(5000, 80)]), bench)
    assert found.collect() == []
    assert made["shingle-hits"].count() <= 300 * 8 and made["window-starts"].count() == 0


def test_short_items_match_inside_long_texts(docs, items):
    bench = items((1, "alpha beta"), (2, "Gamma"), (3, "alpha beta gamma delta"), (4, "beta alpha"))
    frame = docs(["x alpha BETA y", words(0, 50) + " gamma", "alpha beta gamma delta epsilon", "alphabeta"])
    rows = decontaminate.findings(frame, bench).collect()
    assert {(r.doc_id, r.item_id, r.start_word) for r in rows} == {
        (0, 1, 1), (1, 2, 50), (2, 1, 0), (2, 2, 2), (2, 3, 0)}


def test_clashing_columns_stay(docs, items):
    names = ("__key", "__key0", "__row", "key", "item", "hash", "n", "sh")
    frame = docs(["a b c d e f", "clean text of some more words"], extra=names)
    kept = decontaminate.without_passages(frame, items((1, "a b c d e f"))).collect()
    assert [r.doc_id for r in kept] == [1] and all(kept[0][n] == "own" for n in names)


def test_odd_rows(docs, items, odd_texts):
    bench = items((1, "one"), (1, "one"), (2, None), (3, ""), (None, "same text here"), (5, "é ß 日本 😀"))
    frame = docs([*enumerate(odd_texts), (None, "one")], extra=["item_id", "key"])
    found = {(r.doc_id, r.item_id) for r in decontaminate.findings(frame, bench).collect()}
    assert found == {(3, 1), (None, 1), (5, None), (6, None), (4, 5)}
    assert decontaminate.findings(docs([]), bench).collect() == []
    assert decontaminate.findings(frame, items((1, "")).where("item_id > 1")).collect() == []


def test_shuffled_join_gives_the_same(docs, items, monkeypatch):
    frame, bench = docs([words(0, 80), words(40, 80)]), items((1, words(10, 30)), (2, words(60, 40)))
    want = sorted(decontaminate.findings(frame, bench).collect())
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(decontaminate.findings(frame, bench).collect()) == want and len(want) == 2


def test_index_reaches_every_block_within_the_radius():
    near = decontaminate._near_values()
    assert len(near) == 1 + 16 + 120 + 560  # all changes of up to 3 of 16 bits
    assert (decontaminate.RADIUS // decontaminate.BLOCKS + 1) * decontaminate.BLOCKS > decontaminate.RADIUS


def test_similar_windows_with_far_fingerprints_are_found(docs, items):
    """42 light shingles in common and a heavy one changed: a similarity of 0.8, many bits apart."""
    common = words(0, 46)
    bench = items(*((i, f"{common} own{i}") for i in range(60)))
    rows = decontaminate.findings(docs([f"{common} changed{i}" for i in range(10)]), bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(d, i) for d in range(10) for i in range(60)}
    assert all(0.8 <= r.similarity < 0.81 for r in rows) and max(r.hamming for r in rows) > 19

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from stayline.llm import suffix_dedup
from stayline.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
COLUMNS = {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}


def expected(rows):
    raws = [(suffix_dedup.LAST if i is None else i, i, (t or "").encode()) for i, t in rows]
    first = {}
    for order, _, raw in raws:
        for k in range(len(raw) - 49):
            piece = raw[k:k + 50]
            first[piece] = min(order, first.get(piece, order))
    out = []
    for order, doc_id, raw in raws:
        covered = bytearray(len(raw))
        for k in range(len(raw) - 49):
            if first[raw[k:k + 50]] < order:
                covered[k:k + 50] = b"\1" * 50
        kept = bytes(b for b, c in zip(raw, covered, strict=True) if not c)
        spans = len(re.findall(b"\1+", bytes(covered)))
        out.append((doc_id, len(raw), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", *COLUMNS).collect()), key=str)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert got(QUERIES["op6_suffix_dedup"](spark, SMALL)) == expected(rows)


@pytest.fixture(scope="module")
def hard_rows():
    rng = random.Random(4)
    passage = "".join(rng.choices("abc é", k=400))
    texts = ["a" * 300, "a" * 120 + "b" + "a" * 80, passage, passage[37:260] + "x" * 60, "z" + passage * 3,
             passage, "x" * 49, "x" * 50, "ab" * 100, "ba" * 100, None, "", "é" * 60, passage[:49]]
    for _ in range(25):
        cut = rng.randint(0, 350)
        texts.append("".join(rng.choices("abc", k=30)) + passage[cut:cut + rng.randint(30, 90)])
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return [*rows, (None, passage), (None, passage), (3, passage), rows[0]]


def test_hard_texts(docs, hard_rows):
    frame = docs(hard_rows, extra=["id", "txt", "anchor", "ranges", "copy"])
    assert got(suffix_dedup.without_repeats(frame, COLUMNS)) == expected(hard_rows)


@pytest.mark.parametrize("name, value", [("HOT_BYTES", 1), ("HOT_BYTES", 400), ("BATCH_BYTES", 500)])
def test_hot_anchors_and_small_batches_give_the_same(docs, hard_rows, monkeypatch, name, value):
    monkeypatch.setattr(suffix_dedup, name, value)
    assert got(suffix_dedup.without_repeats(docs(hard_rows), COLUMNS)) == expected(hard_rows)


def test_one_long_text_makes_its_anchor_hot(spark, docs, monkeypatch):
    """Two texts, one of which has an anchor's piece among ever different words."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("bcdefgh", k=60))
    piece = min(("".join(rng.choices("a é", k=24)) for _ in range(200)), key=lambda x: int(
        suffix_dedup.anchor_runs()((x * 4).encode())[0].min()))
    lines = [f"{word()}{piece}{word()}" for _ in range(300)]
    rows = [(1, "".join(lines)), (2, "x" + lines[7] + word() + lines[250][20:] + piece)]
    hot = []
    plain = suffix_dedup._by_strings
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", 10_000)
    monkeypatch.setattr(suffix_dedup, "_by_strings", lambda s: hot.append(s.count()) or plain(s))
    assert got(suffix_dedup.without_repeats(docs(rows), COLUMNS)) == expected(rows)
    assert hot and hot[0] > 200  # of the 300 some words hold a lesser piece


def test_long_odd_and_empty(docs, odd_texts):
    assert suffix_dedup.without_repeats(docs([])).collect() == []
    rows = list(enumerate(odd_texts))
    assert got(suffix_dedup.without_repeats(docs(rows), COLUMNS)) == expected(rows)


def test_two_stage_order_is_a_suffix_array():
    rng = random.Random(1)
    for _ in range(60):
        pieces = ["".join(rng.choices("ab", k=rng.randint(50, 90))).encode() for _ in range(rng.randint(1, 8))]
        text = np.frombuffer(b"".join(p + b"\0" for p in pieces), np.uint8).astype(np.uint16) + 1
        text[np.cumsum([len(p) + 1 for p in pieces]) - 1] = 0
        order, _ = suffix_dedup.two_stage_order(text)
        assert sorted(order.tolist()) == list(range(len(text)))
        keys = [text[i:i + 50].tolist() for i in order.tolist()]
        assert keys == sorted(keys)


def test_equal_strings_have_equal_anchors():
    rng = random.Random(8)
    runs = suffix_dedup.anchor_runs()
    core = "".join(rng.choices("abcd", k=50)).encode()
    seen = set()
    for _ in range(20):
        left = "".join(rng.choices("abcd", k=rng.randint(0, 80))).encode()
        anchor, first, last = runs(left + core + b"tail" * rng.randint(0, 9))
        seen.add(int(anchor[(first <= len(left)) & (last >= len(left))][0]))
    assert len(seen) == 1

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import pytest

from stayline.llm import prefix_trie

TURNS = "conv_id bigint, turn bigint, role string, text string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, key, (role, text)))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))  # the remainder as in SQL
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def expected(rows):
    convs = rebuilt(rows)
    members = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[q] for q in below) or 1
        words = len(WORD.findall(p[-1][1])) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[q] for q in below)
    out = []
    for p, inside in members.items():
        ends = ",".join(map(str, sorted(c for c in inside if len(convs[c]) == len(p))))
        out.append((
            min(inside), len(p), min(members[p[:-1]]) if p else None, len(inside),
            len(children.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def nodes(df):
    assert df.columns == list(prefix_trie.RESULT)
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def random_turns():
    """Few words, so that starts are shared; a group of copies; long and turnless ones."""
    random.seed(3)
    rows = []
    for c in range(240):
        for t in range(random.choice([1, 2, 3, 5])):
            rows.append((c, t, random.choice(["user", "bot"]), random.choice(["a", "a b", ""])))
    for c in range(400, 520):  # copies, but for the starts that their groups share
        rows += [(c, t, "user", f"hello {t}") for t in range(5)]
    for c in (700, 701, 720):  # long, nearly alike
        rows += [(c, t, "user", f"long {t if t < 90 else c}") for t in range(120)]
    rows += [(1001, 0, "user", "only"), (1003, 0, "user", "only")]  # their base is absent
    random.shuffle(rows)
    return rows


def test_equals_a_plain_trie(spark, random_turns):
    got = prefix_trie.prefix_nodes(spark.createDataFrame(random_turns, TURNS))
    assert nodes(got) == expected(random_turns)


@pytest.mark.parametrize(("shards", "cells"), [(1, 10), (7, 40), (60, 1_000_000)])
def test_any_split_gives_the_same(spark, random_turns, shards, cells):
    """Nodes that go on over runs and shards are put together again."""
    turns = spark.createDataFrame(random_turns, TURNS)
    convs = prefix_trie.with_shared_starts(prefix_trie.conversations_by_id(turns))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        got = nodes(prefix_trie.trie(convs, cells=cells))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == expected(random_turns)


def test_one_conversation_in_all_shards(spark):
    rows = [(c, t, "user", f"x {t}") for c in range(2000, 2400, 20) for t in range(4)]
    rows += [(c, 9, "user", "x") for c in range(2000, 2400, 20)]
    got = prefix_trie.prefix_nodes(spark.createDataFrame(rows, TURNS))
    assert nodes(got) == expected(rows)


def test_row_order():
    random.seed(5)
    ids = [bytes(random.choices(b"ab", k=1)) * 16 * random.choice([0, 1, 2, 40]) for _ in range(300)]
    convs = random.sample(range(1000), 300)
    want = sorted(range(300), key=lambda r: (ids[r], convs[r]))
    for cells in (1, 900, 10**6):
        assert prefix_trie.row_order(ids, convs, cells).tolist() == want


def test_defined_cases(spark):
    rows = [
        (None, 0, "user", "nobody's"), (5, None, "user", "first"), (5, 0, None, None),
        (5, 0, "", ""), (5, 1, "user", "twice"), (5, 1, "user", "twice"), (-7, 0, "user", "neg"),
        (0, 0, "a", "b c"), (0, 1, "ab", " c"), (1, 0, "a:b", " \t\n"), (40, 0, "日本", "é 😀 x" * 9000),
        (41, 0, "user", "hidden"), (41, 1, "user", "hidden"),
    ]
    frame = spark.createDataFrame(rows, TURNS).selectExpr("*", "'own' AS ids", "'own' AS words",
                                                          "'own' AS base", "1 AS depth")
    assert nodes(prefix_trie.prefix_nodes(frame)) == expected(rows)


def test_empty(spark):
    assert nodes(prefix_trie.prefix_nodes(spark.createDataFrame([], TURNS))) == []

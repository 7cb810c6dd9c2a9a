from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from stayline.llm import ranked_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(rows, items, k):
    """Every document scored for every item, in plain Python."""
    docs = [(i, Counter(terms(t))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = set()
    for item, words in asked.items():
        scores = []
        for doc, c in docs:
            m = 100 - 50 + 50 * c.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in words if c[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1):
            out.add((item, rank, doc, -score))
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def corpus_rows():
    """Words of very different frequency, a group of equal texts, long and short documents."""
    random.seed(7)
    words = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    rows = [
        (i, " ".join(random.choices(words, weights, k=random.choice([3, 20, 60, 400]))))
        for i in range(300)
    ]
    rows += [(1000 + i, "w0 w1 w2 rare common") for i in range(60)]
    rows += [(2000, "W5 " * 700 + "w6")]
    return rows


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize(("docs_a_segment", "look", "query_terms"), [(16_384, 1024, 100_000), (37, 8, 20)])
def test_equals_scoring_of_all(spark, docs, corpus_rows, monkeypatch, docs_a_segment, look, query_terms):
    monkeypatch.setattr(ranked_search, "SEGMENT_DOCS", docs_a_segment)
    monkeypatch.setattr(ranked_search, "FIRST_LOOK", look)
    monkeypatch.setattr(ranked_search, "BLOCK", 16)
    random.seed(8)
    items = [
        (i, " ".join(random.choices([f"w{j}" for j in range(120)] + ["rare", "none"], k=12)))
        for i in range(25)
    ]
    frame = docs(corpus_rows).repartition(3)
    size = ranked_search.corpus(frame)
    segments = ranked_search.index(frame, size)
    got = ranked_search.search(segments, size, items_frame(spark, items), 10, query_terms)
    assert found(got) == expected(corpus_rows, items, 10)


def test_blocks_are_rejected_packed(corpus_rows):
    """The search reaches its result without unpacking all blocks of the long lists."""
    rows = [(i, f"hot x{i % 97} " + "hot " * (i % 5)) for i in range(4000)]
    rows[17] = (17, "hot " * 30 + "target")
    size = ranked_search.Corpus(4000, sum(len(terms(t)) for _, t in rows))
    vocabulary, ids, lengths, words = {}, [], [], []
    import numpy as np

    for i, text in rows:
        split = ranked_search.splitter()(text)
        ids.append(i)
        lengths.append(len(split))
        words.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in split]))
    segment = ranked_search._Segment(ranked_search._segment(ids, lengths, words, vocabulary, size))
    unpacked = []
    whole = segment.unpack
    segment.unpack = lambda term, chosen=None: unpacked.append(
        (term, chosen is None, 0 if chosen is None else len(chosen))
    ) or whole(term, chosen)
    best = ranked_search._Best(1)
    best.least = 5_000_000  # another segment's last place
    segment.search([(b"target", 8000), (b"hot", 1)], best)
    assert best.doc.tolist() == [17]
    hot = vocabulary[b"hot"]
    assert [u for u in unpacked if u[0] == hot] == [(hot, False, 1)]


def test_defined_cases(spark, docs, odd_texts):
    rows = [*enumerate(odd_texts), (None, "same text here"), (5, "same text here"), (90, "ÉCOLE Aİ")]
    items = [(1, "same TEXT here"), (2, ""), (3, None), (4, "absent"), (None, "one word1"),
             (1, "word976"), (6, "École aİ 日本 x" + "x" * 4999), (7, "-- !")]
    got = ranked_search.best_documents(
        docs(rows, extra=("ids", "terms", "n", "rank", "score")),
        items_frame(spark, items).selectExpr("*", "'own' AS rank", "'own' AS terms"), 4,
    )
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    rows_found = [tuple(r) for r in got.collect()]
    assert len(rows_found) == len({(r[0], r[1]) for r in rows_found})
    assert set(rows_found) == expected(rows, items, 4)


def test_empty_tables(spark, docs):
    some, none = items_frame(spark, [(1, "a b")]), items_frame(spark, [])
    assert ranked_search.best_documents(docs([]), some).collect() == []
    assert ranked_search.best_documents(docs([None, "", "!"]), some).collect() == []
    assert ranked_search.best_documents(docs(["a b"]), none).collect() == []

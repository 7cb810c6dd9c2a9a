from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from texts, or from (id, text) pairs; other columns get plain values."""
    def make(texts, extra=()):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        frame = spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS
        )
        for name in extra:  # columns whose names operators use inside or return
            frame = frame.selectExpr("*", f"'own' AS `{name}`")
        return frame

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """NULL, empty, blank, one word, marks, repeated rows, letters beyond ASCII, a long text."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    return [None, "", " \n\t ", "one", "é ß 日本 😀", "same text here", "same text here",
            "password = abcdef1234", "x" * 5000, long, long + " end"]

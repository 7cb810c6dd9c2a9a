from __future__ import annotations

import collections
import math
import re


from stayline.llm import quality_rules
from stayline.llm.queries import QUERIES
from stayline.llm.tables import written

SMALL = "/root/testdata/sf0.001"


def counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times = collections.Counter(windows)
    covered = set()
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    found = (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
             len(lines) - len(set(lines)), len(covered))
    return found, len(words) < 20 or 100 * len(covered) > 30 * len(words)


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert (got, r.base_failed) == counts(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_query_counts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    check(QUERIES["op4_quality_rules"](spark, SMALL).collect(), texts)


def test_odd_texts(spark, docs, odd_texts):
    repeated = "a b c d e f g h " * 4
    texts = [*odd_texts, repeated, "x " * 30, "one\ntwo\none\n \n \n|#é", "a b c d e f g h i j a b c d e f g h"]
    labels = spark.createDataFrame([(0, None, 0), (None, 1, 0), (1, 1, 0)], "doc_id bigint, quality int, toxic int")
    frame = docs(texts, extra=["kept", "key", "n_words"])
    check(quality_rules.verdicts(frame, labels).collect(), dict(enumerate(texts)))
    assert quality_rules.verdicts(docs([]), labels).collect() == []


def test_binomial_tail(spark):
    cases = [(1, 0), (100, 0), (100, 3), (2000, 20), (50, 50)]
    frame = spark.createDataFrame(cases, "n bigint, k bigint")
    for row in frame.select("n", "k", quality_rules.binomial_tail("n", "k", 0.01).alias("p")).collect():
        want = sum(math.comb(row.n, i) * 0.01 ** i * 0.99 ** (row.n - i) for i in range(row.k + 1))
        assert math.isclose(row.p, want, rel_tol=1e-9)


def test_cutoffs_are_certified_per_stratum(spark):
    """Enough good documents certify a cutoff; few do not; the rate above it stays within the bound."""
    def measured(n, lang, quality, symbols, start):
        return [(start + i, lang, 1000, symbols(i), 200, 10, 0, 0, quality) for i in range(n)]

    rows = measured(4000, "en", 1, lambda i: 15 if i % 400 == 0 else 0, 0)
    rows += measured(300, "en", 0, lambda i: 100, 10_000) + measured(300, "de", 1, lambda i: 0, 20_000)
    frame = spark.createDataFrame(rows, "doc_id bigint, lang string, word_chars bigint, n_symbols bigint, "
                                  "n_words bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint, quality int")
    labels = frame.select("doc_id", "quality")
    cuts = {r.in_lang: r.cuts for r in quality_rules.cutoffs(written(frame.drop("quality"), "t"), labels).collect()}
    assert set(cuts) == {"en"}  # 300 good documents cannot certify a rate of 1 % after correction
    assert 0.01 <= cuts["en"]["symbols"] < 0.1  # rejects all bad ones, and at most 1 in 400 good ones


def test_windows_of_a_million_words_are_told_apart(docs):
    """No window repeats in three million different words; 40 bits of a hash gave false repeats."""
    rows = quality_rules.metrics(docs([" ".join(map(str, range(3_000_000)))]), ["doc_id"]).collect()
    assert (rows[0].n_words, rows[0].n_repeat_words) == (3_000_000, 0)


def test_an_id_with_several_texts_counts_once_whatever_the_order(spark, docs):
    plain = "some words that are all different in a line of plain text number"
    texts = [f"{plain} {i} " + " ".join(f"w{i}x{j}" for j in range(20 + i % 7)) + " ##" * (i % 3) for i in range(400)]
    rows = [(i % 200, t) for i, t in enumerate(texts)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(200)], "doc_id bigint, quality int, toxic int")

    def counts_of(rows):
        measured = quality_rules.metrics(docs(rows), ["doc_id", "lang"])
        return sorted(map(str, quality_rules.cutoffs(measured, labels, alpha=0.2, delta=0.5).collect()))

    assert counts_of(rows) == counts_of(rows[::-1]) != []

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from stayline.llm import bpe
from stayline.llm.queries import QUERIES, vocabulary_path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def known():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def coder():
    return bpe.Encoder(bpe.read_vocabulary(vocabulary_path()), kept_words=50)


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_random_texts_match_the_library(coder, known):
    rng = random.Random(5)
    letters = "abzSTİΣσς'éẞﬁñ①²٣ \t\n\x1c\x85  <|endoftext|>日本語é😀-_9"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(1500)]
    texts += ["<|endoftext|>", "a<|startoftext|>b", "I'LL don't X's", "aaaaaaaaaaaaaaa" * 20, "", None]
    for text, packed in zip(texts, coder.encode(texts), strict=True):
        want = known.encode(text or "", add_special_tokens=False).ids
        assert ids(packed) == want, text
        assert coder.decode([packed])[0] == known.decode(want, skip_special_tokens=False)


def test_merges_lowest_rank_first_over_all_words(coder):
    """Against the plain rule: in each word, again and again the pair of the lowest rank."""
    rng = random.Random(3)
    words = [[coder.inner[b] for b in rng.choices(b"abcdehilnorst", k=rng.randint(1, 12))]
             for _ in range(400)]
    plain = []
    for word in words:
        word = list(word)
        while True:
            best = min(
                ((coder.rank[p][0], i) for i, p in enumerate(zip(word, word[1:], strict=False))
                 if p in coder.rank), default=None,
            )
            if best is None:
                break
            at = best[1]
            word[at:at + 2] = [coder.rank[word[at], word[at + 1]][1]]
        plain.append(word)
    assert coder.merge(words) == plain


def test_frames_round_trip(spark, docs, odd_texts):
    frame = docs(odd_texts, extra=["ids", "n_tokens"])
    encoded = bpe.encode(frame, vocabulary_path(), {"doc_id": "bigint", "source": "string"})
    rows = {r.doc_id: r for r in encoded.collect()}
    assert len(rows) == len(odd_texts) and rows[0].n_tokens == rows[1].n_tokens == 0
    assert rows[5].ids == rows[6].ids and rows[0].source == "s"
    decoded = bpe.decode(encoded, vocabulary_path(), {"doc_id": "bigint"})
    assert {r.doc_id: r.text for r in decoded.collect()}[3] == "one</w>"
    assert bpe.encode(docs([]), vocabulary_path(), {"doc_id": "bigint"}).collect() == []


def test_query_digests(spark, known):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op10_bpe"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = known.encode(texts[row.doc_id], add_special_tokens=False).ids
        packed = np.array(want, "<u4").tobytes()
        decoded = known.decode(want, skip_special_tokens=False)
        assert row.n_tokens == len(want)
        assert row.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()

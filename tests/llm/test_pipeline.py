from __future__ import annotations

import pytest

import corpus_pipeline
from stayline.llm import bpe, toxicity
from stayline.llm.queries import vocabulary_path

from .test_decontaminate import best
from .test_simhash import expected

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark):
    """The rows after each stage."""
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = {"documents": frame.collect()}
    for name, stage in corpus_pipeline.STAGES:
        kept = corpus_pipeline.written(stage(spark, frame, SMALL), name)
        if name != "bpe":
            assert kept.columns == frame.columns
        frame = kept
        out[name] = frame.collect()
    return out


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "bpe"
    ]


def test_toxicity_stage_drops_by_score_only(spark, staged):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    weights = toxicity.fit(frame, spark.read.parquet(f"{SMALL}/labels.parquet"))
    low = {r.doc_id for r in toxicity.score(frame, weights, {"doc_id": "bigint"}).collect() if r.score < 0.7}
    assert {r.doc_id for r in staged["toxicity"]} == low


def test_near_duplicate_stage_keeps_the_first_of_each_group(staged):
    rows = expected([(r.doc_id, r.text) for r in staged["toxicity"]])
    assert sorted(r.doc_id for r in staged["simhash_near_dedup"]) == sorted(i for i, _, c in rows if i == c)


def test_decontamination_stage(spark, staged):
    bench = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in staged["simhash_near_dedup"] if all(best(r.text, b) < 0.8 for b in bench)}
    assert {r.doc_id for r in staged["benchmark_decontamination"]} == clean


def test_secret_stage_keeps_all_documents(staged):
    before = {r.doc_id: r for r in staged["benchmark_decontamination"]}
    after = {r.doc_id: r for r in staged["secret_scan"]}
    assert set(before) == set(after)
    for doc_id, row in after.items():
        assert row.text == before[doc_id].text or "[SECRET]" in row.text


def test_last_stage_and_run(spark, staged):
    coder = bpe.Encoder(bpe.read_vocabulary(vocabulary_path()))
    texts = {r.doc_id: r.text for r in staged["secret_scan"]}
    rows = {r.doc_id: bytes(r.ids) for r in staged["bpe"]}
    assert rows == dict(zip(texts, coder.encode(list(texts.values())), strict=True))
    again = {r.doc_id: bytes(r.ids) for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert again == rows


def test_stages_on_odd_rows(spark, docs, odd_texts):
    for frame in (docs([*enumerate(odd_texts), (None, None), (None, None)], extra=["score", "key"]), docs([])):
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(spark, frame, SMALL)
            if name != "bpe":
                assert kept.columns == frame.columns
            frame = corpus_pipeline.written(kept, name)
        frame.collect()

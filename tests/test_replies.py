import json

from stayline.operators import handoff, replies

GOOD = {"user_id": "USR-1", "score": 30, "risk_level": "medio", "reasons": "a, b"}


def rows_for(spark, texts):
    return spark.createDataFrame(
        [(f"r{i:02d}", t) for i, t in enumerate(texts)], "reply_id string, raw string"
    )


def users(spark, n=30):
    return spark.createDataFrame([(f"USR-{i}",) for i in range(n)], "user_id string")


def envelopes(text):
    fenced = f"```json\n{text}\n```"
    return [
        text, f"\n\t {fenced} \n", f"```\n{text}```",
        json.dumps({"output": [{"content": [{"text": fenced}]}]}),
        json.dumps({"message": {"content": text}}),
        json.dumps({"text": text, "message": {"content": ""}}),
        json.dumps({"output": [], "text": fenced}),
    ]


def test_every_envelope_is_read(spark):
    texts = []
    for i, _ in enumerate(envelopes("")):
        entry = dict(GOOD, user_id=f"USR-{i}")
        texts.append(envelopes(json.dumps([entry]))[i])
    out = replies.parse_scoring_replies(rows_for(spark, texts), users(spark))
    assert sorted(r.user_id for r in out.accepted.collect()) == [f"USR-{i}" for i in range(7)]
    assert out.rejects.count() == 0


def test_scoring_rejects(spark):
    two = [GOOD, dict(GOOD, user_id="USR-2", score="45")]
    texts = [
        json.dumps(two),                                     # 0: fine, score as text
        json.dumps(two)[:-10],                               # 1: cut off
        json.dumps(GOOD),                                    # 2: lone object
        json.dumps([GOOD]) + " ok?",                         # 3: text behind
        json.dumps([dict(GOOD, user_id="USR-3", score="many")]),
        json.dumps([dict(GOOD, user_id="USR-4", reasons=None)]),
        json.dumps([dict(GOOD, user_id="XXX-4")]),
        json.dumps([GOOD]),                                  # 7: repeated user
        json.dumps([dict(GOOD, user_id="USR-5", risk_level="alto")]),
        json.dumps([None, 7]),
        "[]",
        "[{'user_id': 'USR-6'}]",
        "",
    ]
    out = replies.parse_scoring_replies(rows_for(spark, texts), users(spark))
    assert sorted((r.user_id, r.score) for r in out.accepted.collect()) == [
        ("USR-1", 30), ("USR-2", 45)]
    reasons = sorted((r.reply_id, r.position, r.reason) for r in out.rejects.fillna(-1).collect())
    assert reasons == [
        ("r01", -1, "bad_json"), ("r02", -1, "not_array"), ("r03", -1, "bad_json"),
        ("r04", 0, "bad_score"), ("r05", 0, "missing_field"), ("r06", 0, "unknown_user"),
        ("r07", 0, "repeated_user"), ("r08", 0, "level_mismatch"), ("r09", 0, "not_object"),
        ("r09", 1, "not_object"), ("r11", -1, "bad_json"), ("r12", -1, "bad_json"),
    ]


def test_recommendation_replies(spark):
    good = {"user_id": "USR-1", "risk_level": "alto", "urgency": "inmediata",
            "recommendation": "x", "reasoning": "y"}
    texts = [
        "```json\n" + json.dumps(good) + "\n```",
        json.dumps(dict(good, user_id="USR-2", urgency="ya")),
        json.dumps(dict(good, user_id="USR-3", risk_level="bajo")),
        json.dumps([good]),
        json.dumps(dict(good, user_id="USR-77")),
        json.dumps(good),
        json.dumps({k: v for k, v in good.items() if k != "reasoning"}),
    ]
    out = replies.parse_recommendation_replies(rows_for(spark, texts), users(spark))
    assert [tuple(r) for r in out.accepted.collect()] == [
        ("r00", "USR-1", "alto", "inmediata", "x", "y")]
    assert sorted((r.reply_id, r.reason) for r in out.rejects.collect()) == [
        ("r01", "bad_urgency"), ("r02", "bad_risk_level"), ("r03", "not_object"),
        ("r04", "unknown_user"), ("r05", "repeated_user"), ("r06", "missing_field")]


def test_report_reply_keeps_structures_as_json(spark):
    doc = {"title": "t", "executive_summary": "s", "key_metrics": {"a": 1, "b": [1, 2]},
           "top_risk_clients": [{"user_id": "U"}], "action_items": "1. x\n2. y"}
    out = replies.parse_report_reply(rows_for(
        spark, ["```json\n" + json.dumps(doc, indent=2) + "\n```", "ignored"]))
    assert [tuple(r) for r in out.collect()] == [(
        "t", "s", '{"a":1,"b":[1,2]}', '[{"user_id":"U"}]', "1. x\n2. y", "ai_agent")]


def test_reading_reply_files(spark, tmp_path):
    lines = [json.dumps({"reply_id": "1", "raw": json.dumps([GOOD])})]
    (tmp_path / "a.json").write_text("\n".join(lines), encoding="utf-8")
    out = replies.parse_scoring_replies(replies.read_replies(spark, str(tmp_path)), users(spark))
    assert out.accepted.count() == 1


def test_batches_lose_nothing(spark):
    people = spark.createDataFrame([(f"USR-{i}", i) for i in range(1, 1001)],
                                   "user_id string, n int")
    for size, buckets in ((20, 1), (20, 7), (1, 3), (5000, 2)):
        batches = handoff.agent_batches(people, size, buckets)
        sizes = batches.groupBy("bucket", "batch_no").count().collect()
        assert max(r["count"] for r in sizes) <= size
        assert batches.select("user_id").distinct().count() == batches.count() == 1000
    payloads = handoff.agent_payloads(batches, ["user_id", "n"]).collect()
    assert sum(p.users for p in payloads) == 1000
    lines = [json.loads(line) for p in payloads for line in p.payload.split("\n")]
    assert {d["user_id"] for d in lines} == {f"USR-{i}" for i in range(1, 1001)}
    assert handoff.buckets_for(10) == 1 and handoff.buckets_for(1_000_001) == 101


def test_payload_keeps_null_fields(spark):
    people = spark.createDataFrame([("USR-1", None)], "user_id string, n int")
    batches = handoff.agent_batches(people, 20, 1)
    assert handoff.agent_payloads(batches, ["user_id", "n"]).first().payload == (
        '{"user_id":"USR-1","n":null}')


def test_one_id_in_a_third_of_all_replies(spark):
    texts = [
        json.dumps([dict(GOOD, user_id="USR-1" if i % 3 == 0 else f"USR-{i}")])
        for i in range(600)
    ]
    known = users(spark, 500)
    out = replies.parse_scoring_replies(rows_for(spark, texts).repartition(4), known)
    accepted = sorted(r.user_id for r in out.accepted.collect())
    assert accepted == sorted({f"USR-{i}" for i in range(500) if i % 3} | {"USR-1"})
    reasons = [r.reason for r in out.rejects.collect()]
    # USR-1 comes 201 times: 200 copies plus its own entry, one of which is first.
    assert reasons.count("repeated_user") == 200
    assert reasons.count("unknown_user") == len([i for i in range(500, 600) if i % 3])


def test_no_reasons_is_no_fault(spark):
    text = json.dumps([dict(GOOD, score=0, risk_level="bajo", reasons="")])
    out = replies.parse_scoring_replies(rows_for(spark, [text]), users(spark))
    assert [(r.score, r.reasons) for r in out.accepted.collect()] == [(0, "")]


def test_a_bad_row_does_not_block_a_later_good_one(spark):
    texts = [json.dumps([dict(GOOD, risk_level="alto")]), json.dumps([GOOD])]
    out = replies.parse_scoring_replies(rows_for(spark, texts), users(spark))
    assert [r.reply_id for r in out.accepted.collect()] == ["r01"]
    assert [r.reason for r in out.rejects.collect()] == ["level_mismatch"]


def test_redelivered_replies_count_once(spark):
    text, other = json.dumps([GOOD]), json.dumps([dict(GOOD, reasons="other")])
    twice = spark.createDataFrame([("r", text), ("r", text), ("r", other)], "reply_id string, raw string")
    out = replies.parse_scoring_replies(twice, users(spark))
    assert out.accepted.count() == 1
    assert [r.reason for r in out.rejects.collect()] == ["repeated_user"]


def test_whole_numbers_in_any_form(spark):
    scores = ["45", "45.0", "4.5e1", "45.5", "many"]
    texts = [json.dumps([dict(GOOD, user_id=f"USR-{i}", score="S")]).replace('"S"', s if s != "many" else '"many"')
             for i, s in enumerate(scores)]
    out = replies.parse_scoring_replies(rows_for(spark, texts), users(spark))
    assert sorted((r.user_id, r.score) for r in out.accepted.collect()) == [(f"USR-{i}", 45) for i in range(3)]
    assert [r.reason for r in out.rejects.collect()] == ["bad_score"] * 2


def test_each_step_of_a_reply_runs_once(spark):
    """Named twice in one expression, an envelope would be looked into and parsed twice."""
    read = replies.read_recommendation_replies(rows_for(spark, ["{}"]))
    text = read._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("get_json_object") == len(replies.ENVELOPES)
    assert text.count("from_json(ArrayType") == 1

from __future__ import annotations

import json

import pytest

from stayline.llm import tool_calls
from stayline.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMAS = {"f": {"q": ("string", True), "n": ("integer", False), "o": ("object", False)}}


@pytest.fixture(scope="module")
def linked(spark):
    def run(*messages):
        frame = spark.createDataFrame(list(messages), "conv_id bigint, turn bigint, role string, content string")
        return {(r.conv_id, r.turn, r.place): r for r in tool_calls.link(frame, SCHEMAS).collect()}

    return run


def call(id_, arguments='{"q": "x"}', after=(), name="f"):
    return {"id": id_, "name": name, "arguments": arguments, "after": list(after)}


def calls(conv, turn, *made):
    return conv, turn, "assistant", json.dumps({"tool_calls": list(made)})


def results(conv, turn, *ids):
    return conv, turn, "tool", json.dumps({"results": [{"tool_call_id": i, "content": f"r\"{i}"} for i in ids]})


def test_links_and_canonical_json(linked):
    arguments = '{ "q" : "é\\"]", "o": {"b": [1, 2.50], "a": null}, "n": 3 }'
    rows = linked(calls(1, 0, call("a", arguments)), results(1, 1, "a", "a", "zz"), calls(2, 0, call("a")), results(None, 1, "a"))
    row = rows[1, 0, 0]
    assert (row.status, row.errors, row.result_turn) == ("ok", "", 1)
    want = {"arguments": json.loads(arguments), "id": "a", "name": "f", "result": 'r"a'}
    assert json.loads(row.call) == want
    assert row.call == json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert rows[1, 1, 1].errors == "repeated_result" and rows[1, 1, 2].errors == "no_call"
    assert rows[2, 0, 0].status == "no_result" and rows[None, 1, 0].status == "orphan_result"


def test_argument_errors(linked):
    cases = ['{"q": 1}', "{}", '{"q": "x", "n": 1.5}', '{"q": "x", "z": 1}', "{", "[1]", None, '{"q": "x", "o": 3}', '{"q": null}']
    rows = linked(calls(1, 0, *(call(f"c{i}", c) for i, c in enumerate(cases)), call("u", name="g"), call("v", name=None)))
    errors = [rows[1, 0, i].errors for i in range(len(cases) + 2)]
    assert errors == ["type:q", "missing:q", "type:n", "unexpected:z", "malformed", "no_object", "malformed",
                      "type:o", "type:q", "unknown_tool", "no_name"]


def test_order_cycles_and_dependencies(linked):
    rows = linked(
        calls(1, 0, call("c", after=["b"]), call("a"), call("b", after=["a"]), call("d", after=["nowhere"])),
        calls(1, 2, call("e", after=["c"]), call("x", after=["y"]), call("y", after=["x"]), call("z", after=["x"]), call("s", after=["s"])),
        calls(1, 4, call("h")), calls(1, 3, call("g", after=["h"])),
        results(1, 5, *"abcdexyzsgh"),
    )
    order = [r.call_id for r in sorted((r for r in rows.values() if r.status == "ok"), key=lambda r: (r.turn, r.level, r.place))]
    assert order == ["a", "b", "c", "e", "h"]
    assert rows[1, 0, 3].errors == "unknown_dependency" and rows[1, 3, 0].errors == "later_dependency"
    assert all(rows[1, 2, i].errors == "cycle" for i in (1, 2, 3, 4))


def test_odd_messages(linked):
    rows = linked(
        (1, 0, "assistant", None), (1, 1, "assistant", ""), (1, 2, "assistant", "{"), (1, 3, None, "x"), (None, None, None, None),
        calls(2, 1, call("a")), results(2, 0, "a"), calls(2, 2, call("a")), calls(3, 0, call(None)), calls(3, 0, call(None)),
        (4, 0, "tool", '{"results": [{"content": "x"}]}'), (5, 0, "assistant", '{"tool_calls": []}'),
    )
    assert rows[2, 1, 0].errors == "early_result" and rows[2, 2, 0].errors == "repeated_id,early_result"
    assert rows[3, 0, 0].errors == "no_id" and rows[4, 0, 0].errors == "no_call" and len(rows) == 4
    assert linked() == {}


def plain(messages):
    """The same rules over lists, conversation by conversation."""
    found, done = [], {}
    for m in messages:
        try:
            body = json.loads(m.content)
        except ValueError:
            continue
        if m.role == "assistant":
            found += [(m, i, c) for i, c in enumerate(body.get("tool_calls", []))]
        elif m.role == "tool":
            for i, r in enumerate(body.get("results", [])):
                done.setdefault((m.conv_id, r["tool_call_id"]), (m.turn, i, r["content"]))
    ids = {(m.conv_id, c["id"]): m.turn for m, _, c in found}
    out = {}
    for m, i, c in found:
        errors = []
        inner = {x["id"]: x.get("after", []) for n, _, x in found if n is m}
        seen, front = set(), list(c.get("after", []))
        cyclic = False
        while front:
            d = front.pop()
            cyclic = cyclic or d in seen and reaches(inner, d)
            if d in inner and d not in seen:
                seen.add(d)
                front += inner[d]
        if any(reaches(inner, d) for d in seen | {c["id"]}):
            errors.append("cycle")
        deps = [ids.get((m.conv_id, d)) for d in c.get("after", [])]
        if None in deps:
            errors.append("unknown_dependency")
        if any(d is not None and d > m.turn for d in deps):
            errors.append("later_dependency")
        out[m.conv_id, m.turn, i] = errors, done.get((m.conv_id, c["id"]))
    return out


def reaches(inner, start):
    seen, front = set(), list(inner.get(start, []))
    while front:
        d = front.pop()
        if d == start:
            return True
        if d in inner and d not in seen:
            seen.add(d)
            front += inner[d]
    return False


def test_query_against_plain_rules(spark):
    conversations = spark.read.parquet(f"{SMALL}/conversations.parquet")
    want = plain(tool_calls.messages_from(conversations).collect())
    rows = {(r.conv_id, r.turn, r.place): r for r in QUERIES["op2_chat_tool_calls"](spark, SMALL).collect() if r.status != "orphan_result"}
    assert set(rows) == set(want) and len(rows) > 30
    for key, (errors, result) in want.items():
        got = rows[key].errors.split(",")
        assert [e for e in got if e in ("cycle", "unknown_dependency", "later_dependency")] == errors, key
        assert rows[key].result_turn == (result[0] if result else None)


def test_messages_of_one_turn_are_judged_together(linked):
    """Repeated ids, cycles and order across the messages of a turn."""
    rows = linked(
        calls(1, 0, call("a", after=["b"])), calls(1, 0, call("b", after=["a"], name="lookup")), calls(1, 0, call("a")),
        calls(2, 0, call("x", after=["y"])), calls(2, 0, call("y")), results(2, 1, "x", "y"),
    )
    of = lambda conv: [r for k, r in sorted(rows.items()) if k[0] == conv]
    errors = [set(r.errors.split(",")) & {"repeated_id", "cycle"} for r in of(1)]
    assert len(errors) == 3 and sum("repeated_id" in e for e in errors) == 1 and sum("cycle" in e for e in errors) >= 2
    assert {r.call_id: r.level for r in of(2) if r.status == "ok"} == {"x": 1, "y": 0}


def test_long_turns_take_seconds(spark):
    """Thousands of calls in one message: a flat one, one long chain, and a cycle at its end."""
    import time

    def message(conv, deps):
        body = {"tool_calls": [{"id": f"c{i}", "name": "lookup", "arguments": "{}", "after": d} for i, d in enumerate(deps)]}
        return (conv, 0, "assistant", json.dumps(body))

    n = 5000
    flat = message(1, [[f"c{i - 1}"] if i % 2 else [] for i in range(n)])
    chain = message(2, [[f"c{i - 1}"] if i else [] for i in range(1500)])
    cycle = message(3, [[f"c{(i - 1) % 800}"] for i in range(800)])
    frame = spark.createDataFrame([flat, chain, cycle], "conv_id bigint, turn bigint, role string, content string")
    began = time.time()
    rows = {(r.conv_id, r.place): (r.level, r.in_cycle) for r in tool_calls.calls_of(frame).collect()}
    assert time.time() - began < 60
    assert all(rows[1, i] == (i % 2, False) for i in range(n))
    assert all(rows[2, i] == (i, False) for i in range(1500))
    assert all(rows[3, i][1] for i in range(800))

from __future__ import annotations

import pytest

import hashlib
import random
import re

from stayline.llm import pii
from stayline.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.findall("[0-9]", m[0])) <= 15]
    return sorted(spans)


def check(rows, texts):
    assert len(rows) == len(texts)
    for row in rows:
        spans = base(texts[row.doc_id])
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), (row, listed)
        assert set(listed.split(",")) <= set(row.spans.split(","))
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [[k for _, k, _ in spans].count(i) for i in range(4)]


def test_query_against_plain_patterns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    check(QUERIES["op9_pii"](spark, SMALL).collect(), texts)


def test_finder_on_random_texts():
    rng = random.Random(6)
    find = pii.base_finder()
    for letters in ("a1@.-% é", "0123456789. -", "+(1)2 .-3", "ab@c.d_%1"):
        for _ in range(3000):
            text = "".join(rng.choices(letters, k=rng.randint(0, 40)))
            assert find(text) == base(text), text


def test_long_runs_are_read_in_linear_time():
    find = pii.base_finder()
    for text in ("a" * 200_000, "1" * 200_000, "a." * 100_000 + "@", "1." * 3, "0" * 9000 + ".1.2.3"):
        find(text)


def test_odd_texts(docs, odd_texts):
    texts = [*odd_texts, "é a.b@c.de, 1.2.3.4 4111 1111 1111 1111 +1 (389) 555-5010"]
    check(pii.report(docs(texts, extra=["key", "kind", "base", "places"])).collect(), dict(enumerate(texts)))
    assert pii.report(docs([])).collect() == []


def test_contexts_discover_identifiers(docs):
    """A pattern that almost only seeds stand in finds further words of a seed's shape; a
    pattern with many others, or another shape, does not."""
    texts = [f"please write to user{i}@mail{i}.com today" for i in range(30)]
    texts += ["please write to user7@localhost today", "nothing to user8@localhost here",
              "please write to 12345 today"]
    shape_seed = ["see user90@localhost now"]
    rows = {r.doc_id: r.spans for r in pii.report(docs(texts + shape_seed)).collect()}
    assert all("found" not in rows[i] for i in range(30))
    assert all("found" not in rows[i] for i in (31, 32, 33))  # no seed has such a shape
    texts[30] = "please write to user7@mail7.c_m today"
    found = {r.doc_id: r.spans for r in pii.report(docs(texts)).collect()}
    assert "found" not in found[31]


def test_discovery_on_a_graph(spark):
    rows = [(0, "a9", f"seed{i}", ["x _ y"]) for i in range(20)]
    rows += [(-1, "a9", "new", ["x _ y", "p _ q"]), (-1, "9", "other", ["x _ y"]), (-1, "a9", "far", ["r _ s"])]
    rows += [(0, "a9", f"seed{i}", ["p _ q"]) for i in range(20, 29)]
    rows += [(-1, "a9", "second", ["p _ q"])]
    frame = spark.createDataFrame(rows, "kind int, shape string, instance string, patterns array<string>")
    patterns, instances = pii.discover(frame)
    assert {r.pattern for r in patterns.collect()} == {"x _ y", "p _ q"} - (
        {"p _ q"} if (9 + 20 / 22) / 11 < pii.CONFIDENCE else set()
    )
    assert "new" in {r.instance for r in instances.collect()}
    assert {r.instance for r in instances.collect()}.isdisjoint({"other", "far", "seed1"})


def with_luhn(i):
    head = f"4111 1111 {i:04d} 000"
    return next(head + c for c in "0123456789" if luhn(f"{head}{c}".replace(" ", "")))


def test_report_discovers_other_forms(docs):
    """Spaced and national numbers, failing cards, local and long e-mails in the contexts of seeds."""
    texts = [f"my number is +1 ({100 + i}) 555-{1000 + i} thanks" for i in range(60)]
    texts += [f"her card shows {with_luhn(i)} as number" for i in range(60)]
    texts += [f"please write to user{i}@mail{i}.com today" for i in range(60)]
    seeds = len(texts)
    last = "4111 1111 0000 00" + ("00" if with_luhn(0)[-2:] != "00" else "01")
    unseen = [
        ("my number is ", "(207) 555-0199", " thanks", "phone"), ("my number is ", "1 207  555 0198", " 2 thanks", "phone"),
        ("her card shows ", last, " as number", "card"), ("please write to ", "user7@localhost", " today", "email"),
        ("please write to ", "u" * 400 + "@localhost", ", today", "email"), ("please write to ", "user8 @ localhost", " today", "email"),
        ("w" * 300 + "\n my number is ", "207.555.0197", " " + "w" * 90, "phone"),
    ]
    texts += [a + b + c for a, b, c, _ in unseen] + ["my number is 12 thanks", "our number was 207 555 0196 then", "my number is ab12 thanks"]
    rows = {r.doc_id: r.spans for r in pii.report(docs(texts)).collect()}
    for i, (a, b, c, kind) in enumerate(unseen, seeds):
        assert rows[i] == f"found_{kind}:{len(a)}:{len(a + b)}", (texts[i], rows[i])
    assert all("found" not in rows[i] for i in range(seeds)) and not any(rows[i] for i in range(seeds + len(unseen), len(texts)))


def test_odd_runs_are_read_in_linear_time():
    step = pii._reader()
    for text in ("@ " * 50_000, "1 " * 10_000, "a@b.cd," * 30_000, "@" * 200_000, "x1" * 100_000, "1 @a " * 30_000, "((1" * 60_000):
        step({"text": [text]})


def grown(rows, support=pii.SUPPORT, confidence=pii.CONFIDENCE):
    """Discovery over lists: patterns and instances until nothing changes; one kind, one shape."""
    inside = {}
    for kind, _, instance, patterns in rows:
        for p in patterns:
            inside.setdefault(p, set()).add(instance)
    seeds = {i for kind, _, i, _ in rows if kind == 0}
    scores, before = dict.fromkeys(seeds, 1.0), None
    while scores != before:
        before = dict(scores)
        sure = {}
        for p, members in inside.items():
            known = [scores[i] for i in members if i in scores]
            value = round(sum(known) / len(members), 6)
            if len(known) >= support and value >= confidence:
                sure[p] = value
        scores = dict.fromkeys(seeds, 1.0)
        for p, value in sure.items():
            for i in inside[p]:
                scores[i] = max(scores.get(i, 0), value)
    return set(sure), {i for i in scores if i not in seeds}


def test_a_chain_of_contexts_is_followed_to_its_end(spark):
    """Each pattern becomes sure only through what the one before it has found."""
    rows = [(0, "a9", f"seed{i}", [f"p{k}" for k in range(7)]) for i in range(100)]
    for k in range(1, 8):
        rows += [(-1, "a9", f"level{k}-{i}", ([f"p{k}"] if k < 7 else []) + ([f"p{k - 1}"] if i < 5 else []))
                 for i in range(8)]
    rows += [(-1, "a9", f"noise{i}", ["q"]) for i in range(40)] + [(0, "a9", "seed3", ["q"])]
    frame = spark.createDataFrame(rows, "kind int, shape string, instance string, patterns array<string>")
    patterns, instances = pii.discover(frame)
    want = grown(rows)
    assert ({r.pattern for r in patterns.collect()}, {r.instance for r in instances.collect()}) == want
    assert {f"level{k}-0" for k in range(1, 8)} <= want[1] and "noise0" not in want[1]
    with pytest.raises(RuntimeError, match="3 rounds"):
        pii.discover(frame, rounds=3)

"""Personal data: fixed formats, and identifiers that bootstrapped contexts discover.

The formats (e-mail, IP address, card number, phone number) find the seeds. A candidate is
a run of one or more words that hold digits alone (and marks), or an ``@``, which may stand
between words. Seeds and candidates stand in lexical patterns: the two words before, and the
words on both sides. The graph of patterns and instances is scored in rounds, for each kind
by itself, until a round changes nothing:

    a pattern's confidence is the mean score of what stands in it, if at least ``SUPPORT``
    of that is known; runs that begin at the same word count once, by the best;
    an instance's score is the best confidence among its patterns; seeds keep 1;
    an instance must have a shape that seeds of the kind have: the kinds of characters,
    whatever the marks, and of digits alone their number. A phone number may lack the
    up to ``CODE`` digits of a country code.

After the rounds, instances of a score of ``CONFIDENCE`` or more that stand in a pattern of
at least that confidence are reported as ``found_<kind>`` spans, the longest of those inside
each other. Words of any length count; long ones travel as digests.

Spark holds the graph: distinct edges, partial sums by pattern and by instance, one written
table a round. Python only reads one text at a time. Defined results: a NULL text counts as
empty; repeated rows get equal results and count once in the graph; a corpus without seeds
discovers nothing; patterns at a text's border use an empty word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import in_batches, join_copies, written

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 200  # more than this is a fault: discovery ends when a round changes nothing
SUPPORT = 5
CONFIDENCE = 0.9
PLACES = 6  # of a confidence; scores only rise, so in whole steps they come to rest
CODE = 3
FEWEST, MOST = 4, 19  # digits that any format can have, a phone number without its code too

SPAN = "array<struct<kind:int,start:int,end:int>>"
PLACE = "array<struct<kind:int,start:int,end:int,shape:string,instance:string,slot:string,patterns:array<string>>>"


def base_finder():
    """Texts to ``(start, kind, end)`` of the fixed formats, in order."""
    import re

    # Fixed values of the contract. A failing e-mail cannot begin again inside the same
    # run of name characters, so each run is tried at its start and after a match only.
    name = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]+)")
    card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
    phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    digit = re.compile(r"[0-9]")
    doubled = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)

    def luhn(digits: list[int]) -> bool:
        rest = digits[::-1]
        return (sum(rest[::2]) + sum(doubled[d] for d in rest[1::2])) % 10 == 0

    def emails(text: str):
        at = 0
        while match := email.match(text, at) or name.search(text, at):
            yield match.start(), 0, match.end()
            at = match.end()

    def find(text: str) -> list[tuple[int, int, int]]:
        spans = list(emails(text)) if "@" in text else []
        if digit.search(text) is None:
            return spans
        spans += [
            (m.start(), 1, m.end()) for m in ip.finditer(text)
            if all(int((p.lstrip("0") or "0")[:4]) <= 255 for p in m.groups())
        ]
        for match in card.finditer(text):
            digits = [ord(c) - 48 for c in match[0] if c not in " -"]
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((match.start(), 2, match.end()))
        if "+" in text:
            for match in phone.finditer(text):
                if 9 <= len(digit.findall(match[0])) <= 15:
                    spans.append((match.start(), 3, match.end()))
        return sorted(spans)

    return find


def _reader():
    import re
    from array import array
    from hashlib import blake2b

    find = base_finder()
    sign = re.compile(r"[0-9@]")
    word = re.compile(r"([^\x20\x09-\x0D0-9@]++)(?![0-9@])|[^\x20\x09-\x0D]+")  # group 1: no sign
    head = re.compile(r"[^0-9A-Za-z@+(]+")
    digit, letter = re.compile(r"[0-9]"), re.compile(r"[^\W\d_]")

    def short(value: str) -> str:
        """The value, or a digest of a long one: equal for equal values."""
        if len(value) <= 64:
            return value
        return "#" + blake2b(value.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()

    def plain(value: str) -> str:
        return short(" ".join(value.lower().split()))

    def shape(value: str) -> str:
        """The kinds of characters; of digits alone their number."""
        if "@" in value:
            return "a@" if letter.search(value) else "9@"
        return "a" if letter.search(value) else f"9:{len(digit.findall(value))}"

    def inner(start: int, end: int, text: str) -> tuple[int, int]:
        """The borders without the marks around."""
        while end > start and not (text[end - 1].isascii() and text[end - 1].isalnum()):
            end -= 1
        if marks := head.match(text, start, end):
            start = marks.end()
        if text[start:start + 1] == "(" and text.find(")", start, end) < 0:
            start += 1
        return start, max(start, end)

    def one(text: str | None) -> tuple[list, list]:
        text = text or ""
        if sign.search(text) is None:
            return [], []
        spans = find(text)
        blocks: list[list[int]] = []  # overlapping spans as one
        for start, _, end in spans:
            if blocks and start < blocks[-1][1]:
                blocks[-1][1] = max(blocks[-1][1], end)
            else:
                blocks.append([start, end])
        # The words in order, cut at the blocks: 0 plain, 1 with a sign, 2 a block.
        starts, ends, what, at = array("q"), array("q"), bytearray(), 0
        for start, end in [*blocks, [len(text), len(text)]]:
            for match in word.finditer(text, at, start):
                starts.append(match.start())
                ends.append(match.end())
                what.append(match.lastindex is None)
            if start < end:
                starts.append(start)
                ends.append(end)
                what.append(2)
            at = end

        def at_sign(i: int) -> bool:
            """Whether an @ joins word ``i`` and the next."""
            return text[ends[i] - 1] == "@" or text[starts[i + 1]] == "@"

        def each(code: int):
            i = -1
            while (i := what.find(code, i + 1)) >= 0:
                yield i

        beside = [  # a plain word next to an @ belongs to it
            j for i in each(1) for j in (i - 1, i + 1)
            if 0 <= j < len(what) and not what[j] and at_sign(min(i, j))
        ]
        for j in beside:
            what[j] = 1

        def piece(i: int) -> str:
            return short(text[starts[i]:ends[i]].lower()) if 0 <= i < len(what) else ""

        def around(first: int, last: int, start: int, end: int) -> list[str]:
            """The patterns; marks cut from the words on both sides are words as well."""
            before, after = text[starts[first]:start].lower(), text[end:ends[last]].lower()
            left = [piece(first - 1), short(before)] if before else [piece(first - 2), piece(first - 1)]
            return [f"{left[0]} {left[1]} _", f"{left[1]} _ {short(after) if after else piece(last + 1)}"]

        def candidates(first: int) -> list[tuple]:
            """The runs of words from ``first`` that a seed's shape could fit."""
            runs, last = [], first
            while True:
                start, end = inner(starts[first], ends[last], text)
                value = text[start:end]
                kind = shape(value)
                size = int(kind[2:]) if kind[:2] == "9:" else 0
                if value.count("@") == 1 or FEWEST <= size <= MOST:
                    runs.append((start, end, kind, plain(value), around(first, last, start, end)))
                last += 1
                if last == len(what) or what[last] != 1 or text.count("@", starts[first], ends[last]) > 1:
                    return runs
                if not at_sign(last - 1) and (
                    kind[:2] != "9:" or size >= MOST
                    or letter.search(text, starts[last], ends[last])
                    or text.find("@", starts[last], ends[last]) >= 0
                ):
                    return runs

        rows, index, block = [], list(each(2)), 0
        for start, kind, end in spans:
            while blocks[block][1] <= start:
                block += 1
            value, i = text[start:end], index[block]
            rows.append((kind, start, end, shape(value), plain(value), plain(value),
                         around(i, i, starts[i], ends[i])))
        for i in each(1):
            runs = candidates(i)
            if not runs:  # fits no seed, but counts in its patterns
                start, end = inner(starts[i], ends[i], text)
                runs = [(start, end, "", plain(text[start:end]), around(i, i, start, end))]
            rows += [(-1, s, e, k, v, runs[-1][3], p) for s, e, k, v, p in runs if s < e]
        return [(k, s, e) for s, k, e in spans], rows

    def step(columns):
        read = [one(t) for t in columns["text"]]
        as_rows = lambda names, rows: [dict(zip(names, r, strict=True)) for r in rows]
        return {
            "base": [as_rows(("kind", "start", "end"), b) for b, _ in read],
            "places": [
                as_rows(("kind", "start", "end", "shape", "instance", "slot", "patterns"), p)
                for _, p in read
            ],
        }

    return step


def discover(places: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Confident patterns ``pattern, kind`` and instances ``instance, kind`` that no seed names.

    ``places``: ``kind`` (-1: unknown), ``shape``, ``instance``, ``patterns``; ``slot``, what
    counts once in a pattern, is the instance where the column is missing.
    """
    slot = F.col("slot" if "slot" in places.columns else "instance").alias("slot")
    edges = written(
        places.select("kind", "shape", "instance", slot, F.explode("patterns").alias("pattern")).distinct(),
        "pii-edges",
    )
    seeds = edges.where("kind >= 0").select("instance", "kind").distinct()
    digits = F.expr("try_cast(substring(shape, 3) AS int)")
    without_code = (F.col("kind") == KINDS.index("phone")) & F.col("shape").startswith("9:") & (digits > CODE)
    shapes = edges.where("kind >= 0").select("shape", "kind").distinct().select(
        F.explode(F.when(without_code, F.transform(
            F.sequence(digits - CODE, digits), lambda n: F.concat(F.lit("9:"), n)
        )).otherwise(F.array("shape"))).alias("shape"), "kind",
    ).distinct()
    graph = edges.select("pattern", "instance", "slot", "shape").distinct()
    # Only patterns that seeds stand in can become confident: the rest of the graph is left out
    # of the first round and joins as instances become known.
    scores = written(seeds.withColumn("score", F.lit(1.0)), "pii-scores")
    degree = written(graph.groupBy("pattern").agg(
        F.countDistinct("slot").alias("degree")
    ).where(F.col("degree") >= SUPPORT), "pii-degrees")
    confident, before = None, None
    for _ in range(rounds):
        known = graph.select("pattern", "instance", "slot").distinct().join(scores, "instance").groupBy(
            "pattern", "slot", "kind"
        ).agg(F.max("score").alias("score"))
        confident = written(
            known.groupBy("pattern", "kind").agg(
                F.sum("score").alias("score"), F.count("*").alias("known")
            )
            .where(F.col("known") >= SUPPORT).join(degree, "pattern")
            .withColumn("confidence", F.round(F.col("score") / F.col("degree"), PLACES))
            .where(F.col("confidence") >= CONFIDENCE)
            .select("pattern", "kind", "confidence"),
            "pii-patterns",
        )
        state = confident.agg(
            F.count("*"), F.sum(F.xxhash64("pattern", "kind", "confidence").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
        reached = (
            graph.join(confident, "pattern").join(shapes, ["shape", "kind"])
            .groupBy("instance", "kind").agg(F.max("confidence").alias("score"))
        )
        scores = written(
            seeds.withColumn("score", F.lit(1.0)).unionByName(reached)
            .groupBy("instance", "kind").agg(F.max("score").alias("score")),
            "pii-scores",
        )
    else:
        raise RuntimeError(f"discovery goes on after {rounds} rounds")
    found = scores.where(F.col("score") >= CONFIDENCE).join(seeds, ["instance", "kind"], "left_anti")
    return confident.select("pattern", "kind"), found.select("instance", "kind")


def scan(docs: DataFrame, keep: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """A row per document (``keep``, text ``key``, ``base`` spans) and the discovered spans
    ``key, kind, start, end`` by text key."""
    schema = ", ".join(f"`{n}` {t}" for n, t in keep.items())
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(*keep, "text", F.unhex(F.sha2(text, 256)).alias("key"))
    read = written(in_batches(
        keyed, _reader, f"{schema}, key binary, base {SPAN}, places {PLACE}"
    ), "pii-places")
    places = read.where(F.size("places") > 0).select("key", F.explode("places").alias("p")).select(
        "key", "p.*"
    )
    patterns, instances = discover(places)
    open_places = places.where("kind < 0").drop("kind").distinct().withColumn(
        "pattern", F.explode("patterns")
    )
    found = (
        open_places.join(instances, "instance").join(patterns, ["pattern", "kind"])
        .select("key", "kind", "start", "end").distinct()
    )
    before = Window.partitionBy("key", "kind").orderBy("start", F.desc("end")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    longest = found.withColumn("reach", F.max("end").over(before)).where(
        "reach IS NULL OR end > reach"
    ).drop("reach")
    return read.select(*keep, "key", "base"), longest


def report(docs: DataFrame) -> DataFrame:
    """Per document the counts of the fixed formats and the digest of all spans."""
    rows, found = scan(docs, {"doc_id": "bigint"})
    names = F.array(*map(F.lit, KINDS))

    def text(prefix: str, x):
        return F.concat_ws(":", F.concat(F.lit(prefix), F.get(names, x["kind"])), x["start"], x["end"])

    more = found.groupBy("key").agg(F.array_sort(
        F.collect_list(F.struct("start", "kind", "end"))
    ).alias("more"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    both = join_copies(rows, more, "key").withColumn("more", F.coalesce("more", none))
    everything = F.array_sort(F.concat(
        F.transform("base", lambda x: F.struct(
            x["start"].alias("start"), x["kind"].alias("kind"), text("", x).alias("text"))),
        F.transform("more", lambda x: F.struct(
            x["start"].alias("start"), (x["kind"] + len(KINDS)).alias("kind"),
            text("found_", x).alias("text"))),
    ))
    def count(kind: int):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint")

    return both.select(
        "doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(F.array_join(F.transform("base", lambda x: text("", x)), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(everything, lambda x: x["text"]), ",").alias("spans"),
    )

"""Repeated byte strings across documents, by suffix arrays built in two stages.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts in a document with a
smaller id.

Which strings can meet? Each string of 50 bytes is filed under its anchor, the least hash of the
16-byte pieces inside it: equal strings have equal anchors, whatever surrounds them.
Neighbouring strings mostly share an anchor, so a document is a row of snippets, one for each
run of equal anchors. An anchor that only one text has needs no further work.

The snippets of the other anchors are shuffled by anchor and read in order; of equal snippets the
one with the smallest id stands for all, the others go as a whole. A task sorts all suffixes of
the different snippets of a batch of whole groups:

1. suffixes smaller than their successor are sorted directly, 7 bytes at a time, and only
   those still tied go on to the next 7;
2. all others are induced by one scan over the buckets of first bytes: whatever precedes a
   placed suffix and is larger than it goes to the end of its own bucket, in scan order;
3. neighbours in the order whose common prefix has 50 bytes form a run, and the smallest id
   of a run says from which ids on its strings are repeats.

Shuffles carry anchors (20 bytes a row, about 6 % of the positions), the snippets of shared
anchors, and each text twice for the joins by document. Exact copies are one text: they are
resolved by the digest of the whole text. Anchors whose snippets have more than ``HOT_BYTES``
together, of many texts or of one long one, are resolved string by string, by partial minima and
a join that can be split; that is exact too, and no task meets all rows of one anchor.

Defined results: a NULL text is empty; texts below 50 bytes lose nothing; a NULL id is larger
than any other; rows of one id never count against each other; repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import in_batches, slices, written

LENGTH = 50
PIECE = 16
HOT_BYTES = 8_000_000
BATCH_BYTES = 4_000_000
SLICE_BYTES = 1_000_000
LAST = (1 << 63) - 1


def anchor_runs():
    """Raw bytes to (anchor, first start, last start) of each run of strings, in order."""
    import numpy as np

    window = LENGTH - PIECE + 1

    def runs(raw: bytes):
        if len(raw) < LENGTH:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = np.frombuffer(raw, dtype=np.uint8).astype(np.uint64)
        h = (h + np.uint64(0x9E3779B1)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
        width = 1
        while width < PIECE:  # a piece of twice the width from two neighbours
            h = (h[:-width] * np.uint64(0x9FB21C651E98DF25 + 2 * width)) + h[width:]
            h ^= h >> np.uint64(29)
            width *= 2
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
        least, width = h, 1
        while 2 * width <= window:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < window:
            least = np.minimum(least[:len(least) - (window - width)], least[window - width:])
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.concatenate([first[1:], [len(least)]]) - 1
        return least[first].view(np.int64), first, last

    return runs


def two_stage_order(text):
    """The suffixes of ``text`` (small numbers, the last one 0) in the order of their first
    ``LENGTH`` symbols at least, and the packed symbols from each place on."""
    import numpy as np

    n = len(text)
    padded = np.concatenate([text, np.zeros(LENGTH + 16, text.dtype)]).astype(np.uint64)
    one = padded
    two = (one[:-1] << np.uint64(9)) | one[1:]
    four = (two[:-2] << np.uint64(18)) | two[2:]
    seven = (four[:-4] << np.uint64(27)) | (two[4:-1] << np.uint64(9))[:len(four) - 4] | one[6:][:len(four) - 4]

    step = np.sign(text[1:].astype(np.int32) - text[:-1])
    known = np.where(step != 0, np.arange(n - 1), n)
    after = np.minimum.accumulate(known[::-1])[::-1]  # the next place where the symbol changes
    rising = np.ones(n, dtype=bool)
    rising[:-1] = (after == n) | (step[np.minimum(after, n - 2)] > 0)

    # Stage 1: suffixes smaller than their successor, sorted directly.
    place = np.flatnonzero(rising)
    place = place[np.argsort(seven[place], kind="stable")]
    group = np.concatenate([[0], np.cumsum(seven[place[1:]] != seven[place[:-1]])])
    depth = 7
    while depth < LENGTH:
        same = group[1:] == group[:-1]
        tied = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
        if not len(tied):
            break
        at, of = place[tied], group[tied]
        key = seven[np.minimum(at + depth, len(seven) - 1)]
        order = np.lexsort((key, of))
        place[tied], key, of = at[order], key[order], of[order]
        change = np.zeros(len(place), dtype=np.int64)
        change[1:] = group[1:] != group[:-1]
        change[tied[1:]] |= (of[1:] == of[:-1]) & (key[1:] != key[:-1])
        group = np.cumsum(change)
        depth += 7

    # Stage 2: the others, induced bucket by bucket.
    starts = np.searchsorted(text[place], np.arange(258))
    waiting: list[list] = [[] for _ in range(257)]
    ordered = []
    for symbol in range(257):
        found = waiting[symbol]
        front = np.concatenate(found) if found else np.zeros(0, np.int64)
        parts = [front]
        while len(front):
            front = front[front > 0] - 1
            front = front[(text[front] == symbol) & ~rising[front]]
            parts.append(front)
        parts.append(place[starts[symbol]:starts[symbol + 1]])
        bucket = np.concatenate(parts)
        ordered.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~rising[before] & (text[before] > symbol)]
        if len(before):
            heads = text[before]
            by = np.argsort(heads, kind="stable")
            before, heads = before[by], heads[by]
            cuts = np.flatnonzero(heads[1:] != heads[:-1]) + 1
            for piece in np.split(before, cuts):
                waiting[int(text[piece[0]])].append(piece)
        waiting[symbol] = []
    return np.concatenate(ordered), seven


def earlier_starts(snippets: list[bytes], ids: list[int]) -> list[list[tuple[int, int]]]:
    """For each snippet the ranges of starts whose string a snippet of a smaller id has too."""
    import numpy as np

    sizes = np.array([len(s) for s in snippets])
    text = np.frombuffer(b"".join([s + b"\0" for s in snippets]), dtype=np.uint8).astype(np.uint16) + 1
    ends = np.cumsum(sizes + 1) - 1
    text[ends] = 0
    owner = np.repeat(np.arange(len(snippets)), sizes + 1)
    order, seven = two_stage_order(text)
    order = order[order + LENGTH <= ends[owner[order]]]
    # The common prefix of neighbours, as far as it matters: 7 symbols at a time.
    equal = np.ones(len(order) - 1 if len(order) else 0, dtype=bool)
    for offset in (*range(0, LENGTH - 7, 7), LENGTH - 7):
        key = seven[order + offset]
        equal &= key[1:] == key[:-1]
    first = np.flatnonzero(np.concatenate([[True], ~equal])) if len(order) else np.zeros(0, int)
    number = np.array(ids, dtype=np.int64)
    own = number[owner[order]]
    least = np.minimum.reduceat(own, first) if len(order) else own
    runs = np.diff(np.concatenate([first, [len(order)]]))
    place = np.sort(order[np.repeat(least, runs) < own]) if len(order) else order
    ranges: list[list[tuple[int, int]]] = [[] for _ in snippets]
    if len(place):
        cut = (np.diff(place) != 1) | (np.diff(owner[place]) != 0)
        begin = place[np.concatenate([[True], cut])]
        end = place[np.concatenate([cut, [True]])]
        base = ends - sizes
        for b, e, who in zip(begin.tolist(), end.tolist(), owner[begin].tolist(), strict=True):
            ranges[who].append((b - int(base[who]), e - int(base[who])))
    return ranges


def _anchors():
    import numpy as np

    runs = anchor_runs()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                found, keys, sizes = [], [], []
                for text, key in zip(part.column(1).to_pylist(), part.column(0).to_pylist(), strict=True):
                    anchor, first, last = runs((text or "").encode())
                    own, of = np.unique(anchor, return_inverse=True)
                    found.append(own)
                    keys.append(np.full(len(own), key, dtype=np.int64))
                    size = np.bincount(of, weights=last - first + LENGTH, minlength=len(own))
                    sizes.append(np.minimum(size, HOT_BYTES + 1).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (found, keys, sizes)],
                    names=["anchor", "txt", "size"],
                )

    return run


def _shared():
    """Sorted rows ``anchor, txt, size`` to those whose anchor has two texts or more."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is left of the last anchor: its one text so far, or that it is shared already.
        anchor = txt = size = None
        shared = False
        for batch in batches:
            a, t, s = (batch.column(i).to_numpy() for i in range(3))
            if not len(a):
                continue
            if anchor is not None and a[0] == anchor and not shared:
                a, t = np.concatenate([[anchor], a]), np.concatenate([[txt], t])
                s = np.concatenate([[size], s])
            first = np.concatenate([[True], a[1:] != a[:-1]])
            new = first | np.concatenate([[True], t[1:] != t[:-1]])
            run_of = np.cumsum(first) - 1
            texts = np.bincount(run_of, weights=new)
            many = texts > 1
            if anchor is not None and shared and a[0] == anchor:
                many[0] = True
            keep = new & many[run_of]
            if anchor is not None and shared and a[0] == anchor and t[0] == txt:
                keep[0] = False
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[keep]), pa.array(t[keep]), pa.array(s[keep].astype(np.int32))],
                names=["anchor", "txt", "size"],
            )
            anchor, txt, size, shared = a[-1], t[-1], s[-1], bool(many[-1])

    return run


def _cut():
    """Rows ``id, txt, text, anchors`` to the snippets of the anchors."""
    import numpy as np

    runs = anchor_runs()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                out: list[list] = [[], [], [], [], [], []]
                ids, txts, texts = (part.column(i).to_pylist() for i in range(3))
                for i, text in enumerate(texts):
                    raw = (text or "").encode()
                    anchor, first, last = runs(raw)
                    wanted = part.column(3)[i].values.to_numpy()
                    at = np.flatnonzero(np.isin(anchor, wanted))
                    out[0].append(anchor[at])
                    out[1] += [raw[b:e + LENGTH] for b, e in zip(first[at].tolist(), last[at].tolist(), strict=True)]
                    out[2].append(np.full(len(at), ids[i], dtype=np.int64))
                    out[3].append(np.full(len(at), txts[i], dtype=np.int64))
                    out[4].append(first[at].astype(np.int64))
                    out[5].append(last[at].astype(np.int64))
                anchors, own, txt, at, last = (np.concatenate(x) for x in (out[0], *out[2:]))
                # A snippet that a smaller id of this slice has too is a repeat already. It goes
                # on without its bytes, filed by its text, so common snippets do not pile up.
                snippets = out[1]
                least: dict[bytes, int] = {}
                for snippet, number in zip(snippets, own.tolist(), strict=True):
                    if least.get(snippet, number) >= number:
                        least[snippet] = number
                for i, number in enumerate(own.tolist()):
                    if least[snippets[i]] < number:
                        snippets[i], anchors[i] = None, txt[i]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors), pa.array(snippets, type=pa.binary()), pa.array(own),
                     pa.array(txt), pa.array(at), pa.array(last)],
                    names=["anchor", "snippet", "id", "txt", "at", "last"],
                )

    return run


ANCHORS = "anchor bigint, txt bigint, size int"
SNIPPETS = "anchor bigint, snippet binary, id bigint, txt bigint, at bigint, last bigint"
RANGES = "id bigint, txt bigint, a bigint, b bigint"


def resolve(table: pa.Table) -> pa.Table:
    """Rows ``anchor, snippet, id, txt, at, last, key`` of whole groups, ordered by anchor, key and
    id, to the starts ``id, txt, a, b`` of repeated strings. Rows without a snippet are known to be
    repeats."""
    import numpy as np
    import pyarrow.compute as pc

    known = table.filter(pc.is_null(table["snippet"]))
    table = table.filter(pc.is_valid(table["snippet"]))
    done = [tuple(known[name].to_numpy() for name in ("id", "txt", "at", "last"))]
    if not table.num_rows:
        return pa.table(list(done[0]), names=["id", "txt", "a", "b"])
    anchor, ids, txt, at, last, key = (
        table[name].to_numpy() for name in ("anchor", "id", "txt", "at", "last", "key")
    )
    new_key = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (key[1:] != key[:-1])])
    class_of = np.cumsum(new_key) - 1
    first = np.flatnonzero(new_key)
    least = ids[first]
    later = np.flatnonzero(ids > least[class_of])
    out = [*done, (ids[later], txt[later], at[later], last[later])]

    # Different snippets of one anchor: what do they share?
    heads = anchor[first]
    alone = np.concatenate([[True], heads[1:] != heads[:-1]]) & np.concatenate([heads[1:] != heads[:-1], [True]])
    compared = np.flatnonzero(~alone)
    if len(compared):
        texts = table["snippet"].take(pa.array(first[compared])).to_pylist()
        ranges = earlier_starts(texts, least[compared].tolist())
        ends = np.append(first[1:], len(ids))
        for number, found in zip(compared.tolist(), ranges, strict=True):
            if found:
                own = np.arange(first[number], ends[number])
                own = own[ids[own] == least[number]]
                for a, b in found:
                    out.append((ids[own], txt[own], at[own] + a, at[own] + b))
    return pa.table([np.concatenate(x) for x in zip(*out, strict=True)], names=["id", "txt", "a", "b"])


def _resolver():
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size < BATCH_BYTES:
                continue
            table = pa.Table.from_batches(held)
            anchor = table["anchor"].to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1]))  # the last group may go on
            if cut:
                yield from resolve(table.slice(0, cut)).to_batches()
            held = table.slice(cut).combine_chunks().to_batches()
            size = 0
        if held:
            yield from resolve(pa.Table.from_batches(held)).to_batches()

    return run


def _by_strings(snippets: DataFrame) -> DataFrame:
    """What ``resolve`` finds, by grouping: every string of 50 bytes is a row, and its
    smallest id a partial minimum. ``snippets``: a stored table."""
    known = snippets.where("snippet IS NULL").select(
        "id", "txt", F.col("at").alias("a"), F.col("last").alias("b")
    )
    snippets = snippets.where("snippet IS NOT NULL")
    place = F.explode(F.sequence(F.lit(0), F.octet_length("snippet") - LENGTH)).alias("i")
    strings = snippets.select("id", "txt", "at", "snippet", place).select(
        "id", "txt", (F.col("at") + F.col("i")).alias("a"),
        F.substring(F.col("snippet"), F.col("i") + 1, F.lit(LENGTH)).alias("string"),
    )
    first = strings.groupBy("string").agg(F.min("id").alias("first"))
    return known.unionByName(strings.join(first, "string").where("first < id").select(
        "id", "txt", "a", F.col("a").alias("b")
    ))


def removals(docs: DataFrame) -> DataFrame:
    """``id, txt, copy, ranges``: the documents that lose bytes. ``copy``: an earlier document
    is equal; ``ranges``: first and last starts of repeated strings, unordered."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        F.coalesce("doc_id", F.lit(LAST)).alias("id"), F.xxhash64(text).alias("txt"),
        text.alias("text"),
    )
    slim = written(
        keyed.where(F.octet_length("text") >= LENGTH)
        .select("id", "txt", F.unhex(F.sha2("text", 256)).alias("digest")), "suffix-texts",
    )
    classes = slim.groupBy("digest", "txt").agg(F.min("id").alias("first"))
    # Distinct before the join: a hot digest's rows can then be split over tasks.
    copies = slim.distinct().join(classes, ["digest", "txt"]).where("first < id").select("id", "txt")

    anchors = keyed.select("txt", "text").mapInArrow(_anchors(), ANCHORS)
    shared = written(
        anchors.repartition(parts, "anchor").sortWithinPartitions("anchor", "txt")
        .mapInArrow(_shared(), ANCHORS), "suffix-shared",
    )
    hot = written(
        shared.groupBy("anchor").agg(F.sum("size").alias("size"))
        .where(F.col("size") > HOT_BYTES).select("anchor"),
        "suffix-hot",
    )

    def snippets(of: DataFrame) -> DataFrame:
        wanted = of.groupBy("txt").agg(F.collect_set("anchor").alias("anchors")).join(
            classes.select("txt", F.col("first").alias("id")), "txt"
        )
        return keyed.join(written(wanted, "suffix-anchors"), ["id", "txt"]).select(
            "id", "txt", "text", "anchors"
        ).mapInArrow(_cut(), SNIPPETS)

    found = (
        snippets(shared.join(hot, "anchor", "left_anti")).withColumn("key", F.xxhash64("snippet"))
        .repartition(parts, "anchor").sortWithinPartitions("anchor", "key", "id")
        .mapInArrow(_resolver(), RANGES)
    )
    if not hot.isEmpty():
        found = found.unionByName(
            _by_strings(written(snippets(shared.join(hot, "anchor")), "suffix-hot-snippets"))
        )
    ranges = found.groupBy("id", "txt").agg(
        F.collect_list(F.struct("a", "b")).alias("ranges")
    ).select("id", "txt", F.lit(False).alias("copy"), "ranges")
    whole = copies.select("id", "txt", F.lit(True).alias("copy"), F.lit(None).cast(
        "array<struct<a:bigint,b:bigint>>"
    ).alias("ranges"))
    return written(ranges.unionByName(whole), "suffix-removals")


def _remover():
    import hashlib

    def one(text: str | None, copy: bool | None, ranges) -> tuple[bytes, list[tuple[int, int]]]:
        raw = (text or "").encode()
        if copy:
            return b"", [(0, len(raw))]
        merged: list[tuple[int, int]] = []
        for a, b in sorted((r["a"], r["b"] + LENGTH) for r in ranges or []):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(merged[-1][1], b))
            else:
                merged.append((a, b))
        at, kept = 0, []
        for a, b in merged:
            kept.append(raw[at:a])
            at = b
        return b"".join([*kept, raw[at:]]), merged

    def step(columns):
        made = [
            one(*row)
            for row in zip(columns["text"], columns["copy"], columns["ranges"], strict=True)
        ]
        return {
            "n_bytes": [len((t or "").encode()) for t in columns["text"]],
            "n_removed": [sum(b - a for a, b in spans) for _, spans in made],
            "n_spans": [len(spans) for _, spans in made],
            "kept": [kept for kept, _ in made],
            "kept_sha256": [hashlib.sha256(kept).hexdigest() for kept, _ in made],
        }

    return step


def without_repeats(docs: DataFrame, outputs: dict[str, str] | None = None) -> DataFrame:
    """``doc_id`` and what ``outputs`` asks for of ``n_bytes``, ``n_removed``, ``n_spans``, ``kept``
    (binary: a cut may fall inside a letter) and ``kept_sha256``."""
    outputs = outputs or {"kept": "binary", "n_removed": "bigint"}
    lost = removals(docs)
    text = F.coalesce("text", F.lit(""))
    joined = docs.select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(LAST)).alias("id"), F.xxhash64(text).alias("txt")
    ).join(lost, ["id", "txt"], "left").select("doc_id", "text", "copy", "ranges")
    schema = ", ".join(f"{n} {t}" for n, t in {"doc_id": "bigint", **outputs}.items())
    return in_batches(joined, _remover, schema)

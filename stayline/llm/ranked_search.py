"""Ranked lexical search with Block-Max MaxScore over a document-sharded index.

A segment indexes a run of documents of bounded size: for every term its documents as
gaps, with term counts, in blocks of ``BLOCK`` postings, and of each block the first
document and the largest impact. Segments are rows of a written table, made where the
documents are scanned, so indexing shuffles nothing.

A search ships a block of queries to the segments. Per query and segment, the lists are
ordered by their largest possible contribution. Lists that together cannot reach the
score of the query's last place are not essential: only documents of the other lists
become candidates. Candidates then meet the remaining lists from the largest bound
down; the maximum of the one block that may hold them rejects those that cannot reach
the last place, and only blocks with survivors are unpacked. All sums and bounds are
integers, so no document is lost to rounding. A task carries its best documents from
segment to segment; the best of all tasks are merged by rank.

Score of a document: over the item's distinct terms, the sum of
``w * ((1000000000 * tf) div (1000 * tf + 20 * m))`` with
``w = floor(1000 * ln((2 N + 2) / (2 df + 1)))`` and ``m = 50 + (50 n N) div L``.

Defined results: NULL and empty texts have no terms and are not counted in ``N``; every
row is a document of its own, so repeated rows rank beside each other; a NULL ``doc_id``
ranks last among equal scores; rows of one ``item_id`` (NULL included) are one item; an
item without terms, or with terms that no document holds, has no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import arrow_schema, in_batches, written

BLOCK = 128  # postings a block
SEGMENT_WORDS = 4_000_000  # a segment ends with the document that reaches either bound
SEGMENT_DOCS = 16_384
QUERY_TERMS = 100_000  # terms of the items that are searched together, about
FIRST_LOOK = 1024  # documents searched first while an item has no last place yet

SEGMENT = (
    "ids array<bigint>, norms binary, terms binary, sizes binary, gaps binary, counts binary, "
    "large_at binary, large binary, block_first binary, block_max binary"
)


class Corpus(NamedTuple):
    """Documents with a term, and their terms with repeats."""
    n_docs: int
    n_terms: int


def splitter() -> Callable[[str | None], list[bytes]]:
    """Texts to terms: runs of ASCII letters, digits and all beyond ASCII; A-Z lower-cased."""
    marks = bytes(
        b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256)
    )
    return lambda text: (text or "").encode().translate(marks).split()


def corpus(docs: DataFrame) -> Corpus:
    def make():
        split = splitter()
        return lambda columns: {"n": [len(split(t)) for t in columns["text"]]}

    counted = in_batches(docs.select("text"), make, "n bigint").where("n > 0")
    row = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return Corpus(*row)


def _segment(ids: list, lengths: list[int], words: list, vocabulary: dict, size: Corpus):
    """One row of the index from the word numbers of its documents."""
    import numpy as np

    length = np.array(lengths, dtype=np.int64)
    norms = 50 + 50 * length * size.n_docs // size.n_terms
    places = np.repeat(np.arange(len(ids), dtype=np.int64), length)
    key, tf = np.unique(np.concatenate(words) << 16 | places, return_counts=True)
    term, place = key >> 16, key & 0xFFFF
    sizes = np.bincount(term, minlength=len(vocabulary))
    start = np.cumsum(sizes) - sizes
    opens = (np.arange(len(key)) - start[term]) % BLOCK == 0
    gaps = np.where(opens, 0, np.diff(place, prepend=0))
    impact = 1_000_000_000 * tf // (1000 * tf + 20 * norms[place])
    first = np.flatnonzero(opens)
    large = np.flatnonzero(tf >= 255)
    packed = {
        "norms": norms, "sizes": sizes.astype("<i4"), "gaps": gaps.astype("<u2"),
        "counts": np.minimum(tf, 255).astype("u1"), "large_at": large, "large": tf[large],
        "block_first": place[first], "block_max": np.maximum.reduceat(impact, first),
    }
    return {"ids": ids, "terms": b" ".join(vocabulary)} | {
        name: values.tobytes() for name, values in packed.items()
    }


def index(docs: DataFrame, size: Corpus) -> DataFrame:
    """The segments of all documents with a term. ``size`` is that of the whole corpus."""
    target = arrow_schema(SEGMENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        class Numbers(dict):
            def __missing__(self, word):
                self[word] = number = len(self)
                return number

        split = splitter()
        ids, lengths, words, vocabulary, held = [], [], [], Numbers(), 0
        for batch in batches:
            for doc_id, text in zip(*batch.columns, strict=True):
                found = split(text.as_py())
                if not found:
                    continue
                ids.append(doc_id.as_py())
                lengths.append(len(found))
                words.append(np.fromiter(
                    map(vocabulary.__getitem__, found), dtype=np.int64, count=len(found)
                ))
                held += len(found)
                if len(ids) == SEGMENT_DOCS or held >= SEGMENT_WORDS:
                    row = _segment(ids, lengths, words, vocabulary, size)
                    yield pa.RecordBatch.from_pylist([row], schema=target)
                    ids, lengths, words, vocabulary, held = [], [], [], Numbers(), 0
        if ids:
            row = _segment(ids, lengths, words, vocabulary, size)
            yield pa.RecordBatch.from_pylist([row], schema=target)

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(run, SEGMENT)


def frequencies(segments: DataFrame, terms: set[bytes]) -> dict[bytes, int]:
    """In how many documents each of the terms occurs."""
    shared = segments.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        total = dict.fromkeys(shared.value, 0)
        for batch in batches:
            for names, sizes in zip(*batch.columns, strict=True):
                df = np.frombuffer(sizes.as_py(), dtype="<i4")
                for number, word in enumerate(names.as_py().split(b" ")):
                    if word in total:
                        total[word] += int(df[number])
        found = [(w, n) for w, n in total.items() if n]
        yield pa.RecordBatch.from_arrays([
            pa.array([w for w, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int64()),
        ], names=["term", "n"])

    counts = segments.select("terms", "sizes").mapInArrow(run, "term binary, n bigint")
    return {bytes(t): n for t, n in counts.groupBy("term").agg(F.sum("n")).collect()}


class _Best:
    """The best documents of an item so far; ``least`` is what a further one must reach."""

    def __init__(self, k: int):
        import numpy as np

        self.k, self.least = k, 1
        self.score = np.zeros(0, dtype=np.int64)
        self.doc = np.zeros(0, dtype=np.int64)
        self.no_id = np.zeros(0, dtype=bool)

    def add(self, score, doc, no_id) -> None:
        import numpy as np

        score = np.concatenate([self.score, score])
        doc, no_id = np.concatenate([self.doc, doc]), np.concatenate([self.no_id, no_id])
        best = np.lexsort((doc, no_id, -score))[:self.k]
        self.score, self.doc, self.no_id = score[best], doc[best], no_id[best]
        if len(best) == self.k:
            self.least = int(self.score[-1])


class _Segment:
    """A row of the index, with what has been unpacked of it."""

    def __init__(self, row: dict):
        import numpy as np

        ids = pa.array(row["ids"], pa.int64())
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        view = {
            name: np.frombuffer(row[name], dtype=kind) for name, kind in (
                ("norms", "<i8"), ("sizes", "<i4"), ("gaps", "<u2"), ("counts", "u1"),
                ("large_at", "<i8"), ("large", "<i8"), ("block_first", "<i8"), ("block_max", "<i8"),
            )
        }
        self.view = view
        self.number = {word: i for i, word in enumerate(row["terms"].split(b" "))}
        self.start = np.concatenate([[0], np.cumsum(view["sizes"])])
        self.block = np.concatenate([[0], np.cumsum(-(-view["sizes"] // BLOCK))])
        self.whole: dict[int, tuple] = {}

    def blocks(self, term: int):
        """First documents and largest impacts of a term's blocks."""
        a, b = self.block[term], self.block[term + 1]
        return self.view["block_first"][a:b], self.view["block_max"][a:b]

    def unpack(self, term: int, chosen=None):
        """Documents and impacts of the chosen blocks of a term, or of all."""
        import numpy as np

        if term in self.whole:
            return self.whole[term]
        first, _ = self.blocks(term)
        blocks = np.arange(len(first)) if chosen is None else chosen
        at = self.start[term] + blocks[:, None] * BLOCK + np.arange(BLOCK)
        real = at < self.start[term + 1]
        at = np.where(real, at, self.start[term])
        place = (first[blocks][:, None] + np.cumsum(
            np.where(real, self.view["gaps"][at], 0), axis=1, dtype=np.int64
        ))[real]
        at = at[real]
        tf = self.view["counts"][at].astype(np.int64)
        large = np.flatnonzero(tf == 255)
        tf[large] = self.view["large"][np.searchsorted(self.view["large_at"], at[large])]
        impact = 1_000_000_000 * tf // (1000 * tf + 20 * self.view["norms"][place])
        if chosen is None:
            self.whole[term] = place, impact
        return place, impact

    def search(self, weights: list[tuple[bytes, int]], best: _Best) -> None:
        """Adds the documents that belong among the item's best."""
        lists = sorted(
            (w * int(self.blocks(t)[1].max()), t, w)
            for t, w in ((self.number.get(term), w) for term, w in weights)
            if t is not None and w > 0
        )
        end, low, step = len(self.ids), 0, FIRST_LOOK
        while lists and low < end:
            high = end if best.least > 1 else min(end, low + step)
            self._between(lists, low, high, best)
            low, step = high, step * 4

    def _between(self, lists: list, low: int, high: int, best: _Best) -> None:
        import numpy as np

        below, total = [0], 0  # what the lists before the i-th can give together
        for bound, _, _ in lists:
            total += bound
            below.append(total)
        essential = next((i for i in range(len(lists)) if below[i + 1] >= best.least), len(lists))
        score = np.zeros(high - low, dtype=np.int64)
        for _, term, weight in lists[essential:]:
            place, impact = self.unpack(term)
            a, b = np.searchsorted(place, (low, high))
            score[place[a:b] - low] += weight * impact[a:b]
        found = np.flatnonzero(score)
        found = found[score[found] + below[essential] >= best.least]
        for i in range(essential - 1, -1, -1):
            if not len(found):
                return
            _, term, weight = lists[i]
            first, most = self.blocks(term)
            block = np.searchsorted(first, found + low, side="right") - 1
            bound = np.where(block >= 0, weight * most[block], 0)
            stays = score[found] + bound + below[i] >= best.least
            found, block = found[stays], block[stays]
            chosen = np.unique(block[block >= 0])
            if len(chosen):
                place, impact = self.unpack(term, chosen)
                at = np.minimum(np.searchsorted(place, found + low), len(place) - 1)
                hit = place[at] == found + low
                score[found[hit]] += weight * impact[at[hit]]
            found = found[score[found] + below[i] >= best.least]
        if len(found):
            best.add(score[found], self.ids[found + low], self.no_id[found + low])


def _search(segments: DataFrame, items: list[tuple], kind: str, k: int) -> DataFrame:
    """``item_id, doc_id, score``: of each task the best documents of every item."""
    schema = f"item_id {kind}, doc_id bigint, score bigint"
    target = arrow_schema(schema)
    shared = segments.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        best = [_Best(k) for _ in queries]
        for batch in batches:
            for at in range(batch.num_rows):
                segment = _Segment(batch.slice(at, 1).to_pylist()[0])
                for (_, weights), mine in zip(queries, best, strict=True):
                    segment.search(weights, mine)
        for (item, _), mine in zip(queries, best, strict=True):
            yield pa.RecordBatch.from_arrays([
                pa.array([item] * len(mine.score), target.field("item_id").type),
                pa.array(mine.doc, pa.int64(), mask=mine.no_id), pa.array(mine.score, pa.int64()),
            ], schema=target)

    return segments.mapInArrow(run, schema)


def search(
    segments: DataFrame, size: Corpus, items: DataFrame, k: int = 50,
    query_terms: int = QUERY_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item.

    ``items`` has ``item_id`` and ``text``. They are searched in blocks of about
    ``query_terms`` terms, so what is shipped to a task is bounded by that or the
    longest item.
    """
    def make():
        split = splitter()
        return lambda columns: {"terms": [list(dict.fromkeys(split(t))) for t in columns["text"]]}

    kind = items.schema["item_id"].dataType.simpleString()
    asked = written(
        in_batches(items.select("item_id", "text"), make, f"item_id {kind}, terms array<binary>")
        .groupBy("item_id")
        .agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms"))
        .where("size(terms) > 0"),
        "items",
    )
    n_terms = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = max(1, -(-n_terms // query_terms))
    parts = []
    for block in range(n_blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == block).collect()
        df = frequencies(segments, {bytes(t) for row in rows for t in row.terms})
        weight = {
            t: math.floor(1000 * math.log((2 * size.n_docs + 2) / (2 * n + 1)))
            for t, n in df.items()
        }
        queries = [
            (row.item_id, [(t, weight[t]) for t in map(bytes, row.terms) if t in weight])
            for row in rows
        ]
        parts.append(_search(segments, queries, kind, k))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        reduce(DataFrame.union, parts)
        .select("item_id", F.row_number().over(order).alias("rank"), "doc_id", "score")
        .where(F.col("rank") <= k)
    )


def best_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """Index of all documents, then the ``k`` best of each item."""
    size = corpus(docs)
    return search(written(index(docs, size), "segments"), size, items, k)

"""BPE encoding and decoding of whole texts with a public vocabulary file.

Texts are normalised (NFC, white space runs to one space, lower case), cut into
words and encoded. The words that a partition has not met before are encoded
together by a pair occurrence index: every adjacent pair of symbols is mapped to
all its positions, the mergeable pairs wait in a heap by rank, and the lowest
rank is applied at all its positions at once, which updates the lists of the
neighbouring pairs only. The ids of words and of their runs between white space are
kept packed in one bounded store, so a text costs one look-up a run: a word alone is cut
into itself, so both can share it. The store lives with the broadcast vocabulary and serves
all tasks of a Python worker.

The vocabulary is a fixed file; its size does not follow the data. It is read
once by the driver and broadcast.

Defined results: a NULL or empty text has no ids and decodes to the empty text;
texts of any length are encoded whole; the file's special tokens in a text get
their own ids, as its library does by default.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import DataFrame

from .tables import in_batches

KEPT_WORDS = 600_000  # words and runs a worker remembers; beyond it the store starts anew

# Fixed values of the vocabulary's format: white space, word pattern, printable bytes.
SPACES = "[\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]+"
WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
PRINTABLE = (range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100))


class Vocabulary(NamedTuple):
    ids: dict[str, int]
    merges: list[tuple[str, str]]
    special: dict[str, int]
    suffix: str


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model = content["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    return Vocabulary(model["vocab"], merges, special, model["end_of_word_suffix"] or "")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else one from 256 on."""
    shown = {b for part in PRINTABLE for b in part}
    letters, more = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in shown else more))
        more += byte not in shown
    return letters


class Encoder:
    """Words to ids and ids to text for one vocabulary."""

    def __init__(self, vocabulary: Vocabulary, kept_words: int = KEPT_WORDS):
        import regex

        ids, suffix = vocabulary.ids, vocabulary.suffix
        self.rank = {
            (ids[a], ids[b]): (rank, ids[a + b])
            for rank, (a, b) in enumerate(vocabulary.merges)
        }
        letters = byte_letters()
        self.inner = [ids[x] for x in letters]
        self.last = [ids[x + suffix] for x in letters]
        self.special = vocabulary.special
        self.tokens = {i: t for t, i in {**ids, **vocabulary.special}.items()}
        self.kept: dict[str, bytes] = {}
        self.kept_words = kept_words
        self.spaces = regex.compile(SPACES)
        self.words = regex.compile(WORDS)
        names = sorted(self.special, key=len, reverse=True)
        self.cuts = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def merge(self, words: list[list[int]]) -> list[list[int]]:
        """Symbol lists with all merges applied, lowest rank first over all words at once."""
        symbol: list[int] = []
        after: list[int] = []
        before: list[int] = []
        first = []
        where: dict[tuple[int, int], list[int]] = defaultdict(list)
        rank = self.rank
        for word in words:
            base = len(symbol)
            first.append(base)
            symbol += word
            after += [*range(base + 1, base + len(word)), -1]
            before += [-1, *range(base, base + len(word) - 1)]
            for at, pair in enumerate(zip(word, word[1:], strict=False), base):
                where[pair].append(at)
        waiting = [(rank[pair], pair) for pair in where if pair in rank]
        heapq.heapify(waiting)
        while waiting:
            (_, merged), pair = heapq.heappop(waiting)
            places = where.pop(pair, None)
            if places is None:
                continue
            places.sort()
            left, right = pair
            for at in places:
                follows = after[at]
                if symbol[at] != left or follows < 0 or symbol[follows] != right:
                    continue  # an earlier merge has used one of the two
                beyond = after[follows]
                symbol[at], symbol[follows], after[at] = merged, -1, beyond
                changed = []
                if beyond >= 0:
                    before[beyond] = at
                    changed.append(((merged, symbol[beyond]), at))
                if before[at] >= 0:
                    changed.append(((symbol[before[at]], merged), before[at]))
                for new, place in changed:
                    if new in rank:
                        if new not in where:
                            heapq.heappush(waiting, (rank[new], new))
                        where[new].append(place)
        done = []
        for at in first:
            ids = []
            while at >= 0:
                ids.append(symbol[at])
                at = after[at]
            done.append(ids)
        return done

    def _runs(self, text: str) -> list[str]:
        """The normalised text, cut at white space."""
        import unicodedata

        # Lower case letter by letter: no special rule for a sigma at the end of a word.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if any(mark in text for mark in "\x1c\x1d\x1e\x1f"):  # white space to str.split only
            return self.spaces.split(text)
        return text.split()

    def _learn(self, runs: set[str]) -> None:
        import numpy as np

        kept = self.kept
        parts = {run: self.words.findall(run) for run in runs}
        words = list({w for found in parts.values() for w in found if w not in kept})
        inner, last = self.inner, self.last
        lists = self.merge(
            [[*map(inner.__getitem__, r[:-1]), last[r[-1]]] for r in map(str.encode, words)]
        )
        flat = np.array([i for ids in lists for i in ids], dtype="<u4").tobytes()
        at = 0
        for word, ids in zip(words, lists, strict=True):
            kept[word] = flat[at:at + 4 * len(ids)]
            at += 4 * len(ids)
        for run, found in parts.items():
            if run not in kept:
                kept[run] = b"".join([kept[w] for w in found])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut: list[list[bytes | list[str]]] = []
        for text in texts:
            pieces: list[bytes | list[str]] = []
            found = self.cuts.split(text or "") if self.cuts else [text or ""]
            for i, piece in enumerate(found):
                if i % 2:
                    pieces.append(self.special[piece].to_bytes(4, "little"))
                else:
                    pieces.append(self._runs(piece))
            cut.append(pieces)
        used = {run for p in cut for x in p if not isinstance(x, bytes) for run in x}
        if len(self.kept) > self.kept_words:
            self.kept.clear()
        new = used.difference(self.kept)
        if new:
            self._learn(new)
        kept = self.kept.__getitem__
        return [
            b"".join([x if isinstance(x, bytes) else b"".join(map(kept, x)) for x in pieces])
            for pieces in cut
        ]

    def decode(self, packed: list[bytes]) -> list[str]:
        """The tokens of the ids, joined by a space, as the file names no decoder."""
        import numpy as np

        token = self.tokens.__getitem__
        return [" ".join(map(token, np.frombuffer(p, dtype="<u4").tolist())) for p in packed]


def encode(
    docs: DataFrame,
    path: str,
    keep: dict[str, str],
    outputs: dict[str, str] | None = None,
    kept_words: int = KEPT_WORDS,
) -> DataFrame:
    """The columns of ``keep`` (name to type) and what ``outputs`` asks for:
    ``ids`` (binary, packed), ``n_tokens``, ``decoded``, ``ids_sha256``, ``decoded_sha256``."""
    outputs = outputs or {"ids": "binary", "n_tokens": "bigint"}
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((*read_vocabulary(path), {}))

    def make():
        import hashlib

        *vocabulary, here = shared.value  # the last is a store of this worker's own
        coder = here.get("coder") or here.setdefault(
            "coder", Encoder(Vocabulary(*vocabulary), kept_words)
        )

        def step(columns):
            packed = coder.encode(columns["text"])
            made: dict[str, object] = {}
            if "ids" in outputs:
                made["ids"] = packed
            if "n_tokens" in outputs:
                made["n_tokens"] = [len(p) // 4 for p in packed]
            if "ids_sha256" in outputs:
                made["ids_sha256"] = [hashlib.sha256(p).hexdigest() for p in packed]
            if "decoded" in outputs or "decoded_sha256" in outputs:
                decoded = coder.decode(packed)
                if "decoded" in outputs:
                    made["decoded"] = decoded
                if "decoded_sha256" in outputs:
                    made["decoded_sha256"] = [
                        hashlib.sha256(t.encode()).hexdigest() for t in decoded
                    ]
            return made

        return step

    schema = ", ".join(f"`{n}` {t}" for n, t in {**keep, **outputs}.items())
    return in_batches(docs.select(*dict.fromkeys([*keep, "text"])), make, schema)


def decode(rows: DataFrame, path: str, keep: dict[str, str]) -> DataFrame:
    """The columns of ``keep`` and the ``text`` of the packed ``ids``; NULL ids give no text."""
    vocabulary = rows.sparkSession.sparkContext.broadcast(tuple(read_vocabulary(path)))

    def make():
        coder = Encoder(Vocabulary(*vocabulary.value))
        return lambda columns: {"text": coder.decode([bytes(i or b"") for i in columns["ids"]])}

    schema = ", ".join(f"`{n}` {t}" for n, t in {**keep, "text": "string"}.items())
    return in_batches(rows.select(*dict.fromkeys([*keep, "ids"])), make, schema)

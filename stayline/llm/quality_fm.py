"""Text quality by a factorisation machine.

Features of a text are its hashed words (tf, normalised to length 1), structure statistics
and metadata (length, lines), the latter as one of a few ranges each. Every feature has a
weight and a vector of ``RANK`` numbers; pairs interact through the product of their vectors.
A score costs linear time by the sum-of-squares identity

    sum over pairs <v_i, v_j> x_i x_j  =  1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i (v_if x_i)^2 ].

Trained by AdaGrad on a bounded labelled sample, in a fixed order from a fixed start; the
model's size is that of its tables. Defined results: NULL and empty texts are scored by
their statistics; without labels, or with labels all alike, the model is its bias.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .learning import MAX_ROWS, fold, labelled_sample, slots, within_bytes, word_hasher
from .tables import in_batches, written

BITS = 15
RANK = 6
RANGES = 16
EPOCHS = 5
RATE, REGULAR = 0.1, 1e-5
STATS = (
    "symbols", "pipes", "digits", "capitals", "marks", "word_length", "distinct_words",
    "repeated_lines", "repeated_windows", "line_words", "chars", "lines",
)


def statistics():
    """Texts to their statistics, each within 0 to 1."""
    import numpy as np

    classes = np.zeros((256, 6))
    for byte in range(256):
        c = chr(byte)
        classes[byte] = (
            c in "#*$%&<>", c == "|", byte < 128 and c.isdigit(), byte < 128 and c.isupper(),
            c in ".,;:!?", c in " \t\n\x0b\x0c\r",
        )

    def of(text: str | None, hashes) -> list[float]:
        raw = (text or "").encode()
        counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) @ classes
        size = max(1.0, len(raw) - counts[5])
        n = len(hashes)
        lines = [x for x in raw.split(b"\n") if x.strip()]
        windows = hashes[:-3] * np.uint64(31) + hashes[1:-2] * np.uint64(17) if n > 4 else hashes[:0]
        if n > 4:
            windows = windows + hashes[2:-1] * np.uint64(7) + hashes[3:]
        return [
            *(min(1.0, counts[:5] @ np.eye(5)[i] / size * 4) for i in range(5)),
            min(1.0, size / max(1, n) / 20),
            len(np.unique(hashes)) / max(1, n),
            1 - len(set(lines)) / max(1, len(lines)),
            1 - len(np.unique(windows)) / max(1, len(windows)),
            min(1.0, n / max(1, len(lines)) / 60),
            min(1.0, np.log1p(len(raw)) / 16),
            min(1.0, np.log1p(len(lines)) / 10),
        ]

    return of


def featurizer(bits: int = BITS):
    """Texts to places and values of their features."""
    import numpy as np

    hashes, stats = word_hasher(), statistics()

    def features(text: str | None):
        h = hashes(text)
        place, count = np.unique(slots(h, 5, bits), return_counts=True)
        value = np.log1p(count)
        value /= max(1e-9, np.sqrt((value * value).sum()))
        ranges = np.minimum(np.array(stats(text, h)) ** 0.5 * RANGES, RANGES - 1).astype(np.int32)
        own = (1 << bits) + np.arange(len(STATS), dtype=np.int32) * RANGES + ranges
        return np.concatenate([place, own]), np.concatenate([value, np.full(len(STATS), 0.5)])

    return features


def _raw_score(bias, w, v, place, value):
    vx = v[place] * value[:, None]
    total = vx.sum(axis=0)
    return bias + w[place] @ value + 0.5 * (total @ total - (vx * vx).sum()), total, vx


def _fit(frame, bits: int):
    """Bias, weights and vectors from rows of ``label, place, value``."""
    import numpy as np

    size = (1 << bits) + len(STATS) * RANGES
    w, v = np.zeros(size), np.random.default_rng(7).normal(0, 0.05, (size, RANK))
    gw, gv, bias, gb = np.full(size, 1e-8), np.full((size, RANK), 1e-8), 0.0, 1e-8
    rows = [
        (label, np.frombuffer(p, dtype="<i4"), np.frombuffer(x, dtype="<f4").astype(float))
        for label, p, x in zip(frame["label"], frame["place"], frame["value"], strict=True)
    ]
    for _ in range(EPOCHS):
        for label, place, value in rows:
            raw, total, vx = _raw_score(bias, w, v, place, value)
            g = 1 / (1 + np.exp(-np.clip(raw, -35, 35))) - label
            gb += g * g
            bias -= RATE * g / gb ** 0.5
            step = g * value + REGULAR * w[place]
            gw[place] += step * step
            w[place] -= RATE * step / np.sqrt(gw[place])
            step = g * value[:, None] * (total - vx) + REGULAR * v[place]
            gv[place] += step * step
            v[place] -= RATE * step / np.sqrt(gv[place])
    return bias, w.astype("<f4"), v.astype("<f4")


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS, max_rows: int = MAX_ROWS) -> tuple:
    """``bias, weights, vectors`` from labelled documents whose fold is not 0 of 5."""
    import numpy as np

    sample = labelled_sample(docs, labels, "quality", fold(5) != 0, max_rows)

    def make():
        features = featurizer(bits)

        def step(columns):
            made = [features(t) for t in columns["text"]]
            return {"place": [p.astype("<i4").tobytes() for p, _ in made],
                    "value": [x.astype("<f4").tobytes() for _, x in made]}

        return step

    rows = within_bytes(written(
        in_batches(sample, make, "doc_id bigint, label int, place binary, value binary"),
        "quality-sample",
    ), "place", "value")

    def learn(frame):
        import pandas as pd

        bias, w, v = _fit(frame.sort_values("doc_id"), bits)
        return pd.DataFrame({"bias": [bias], "w": [w.tobytes()], "v": [v.tobytes()]})

    # The sample is bounded in rows and bytes; one group holds it, and the model is one row.
    model = rows.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(
        learn, "bias double, w binary, v binary"
    ).first()
    size = (1 << bits) + len(STATS) * RANGES
    if model is None:
        return 0.0, np.zeros(size, "<f4"), np.zeros((size, RANK), "<f4")
    return (
        model.bias, np.frombuffer(model.w, "<f4"),
        np.frombuffer(model.v, "<f4").reshape(size, RANK),
    )


def score(
    docs: DataFrame, model: tuple, keep: dict[str, str], bits: int = BITS, name: str = "score"
) -> DataFrame:
    """The columns of ``keep`` (name to type) and the score of ``text``, from 0 to 1, as ``name``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        import numpy as np

        bias, w, v = shared.value
        features = featurizer(bits)

        def one(text: str | None) -> float:
            raw = _raw_score(bias, w, v, *features(text))[0]
            return float(1 / (1 + np.exp(-np.clip(raw, -35, 35))))

        return lambda columns: {name: [one(t) for t in columns["text"]]}

    schema = ", ".join(f"`{n}` {t}" for n, t in {**keep, name: "double"}.items())
    return in_batches(docs.select(*dict.fromkeys([*keep, "text"])), make, schema)

"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct places of its words, word pairs and pairs
with one word between in a table of ``2 ** BITS``. Every coordinate has its own
learning rate; L1 leaves few weights other than zero, and only those are sent to
the scoring tasks.

The labelled sample is bounded in rows and in bytes of features, so by default one shard
holds it; ``train`` takes more. A round starts all shards from the same state; each one
passes over its rows in a fixed order, and Spark averages the changes of each coordinate
over the shards that met it into the next state. The state is bounded by the table,
whatever the corpus.

Defined results: NULL and empty texts get the score of the bias alone; labels
that are all alike, or none, give a model of the bias; a NULL ``doc_id`` is held
out of nothing and keeps its row.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .learning import MAX_ROWS, labelled_sample, slots, within_bytes, word_hasher
from .tables import in_batches, written

BITS = 18
SHARDS = 1  # the sample is bounded; more shards learn faster from a larger one, with less of L1
ROUNDS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 6.0, 0.0


class Weights(NamedTuple):
    """The weights that are not zero, by place; the bias stands behind the last place."""
    place: list[int]
    weight: list[float]
    bits: int


def featurizer(bits: int):
    """Texts to the places of their words, pairs and skip pairs, repeats included."""
    import numpy as np

    hashes = word_hasher()
    by = np.uint64(0x100000001B3)

    def features(text: str | None) -> np.ndarray:
        h = hashes(text)
        return np.concatenate([
            slots(h, 1, bits), slots(h[:-1] * by + h[1:], 2, bits),
            slots(h[:-2] * by + h[2:], 3, bits),
        ])

    return features


def _weights(z, n):
    import numpy as np

    step = (BETA + np.sqrt(n)) / ALPHA + L2
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / step)


def _bias(z, n):
    return -z * ALPHA / (BETA + n ** 0.5)


def _learner(state, size: int):
    """One shard's pass over its rows, as changes of the coordinates."""
    import numpy as np
    import pandas as pd

    def learn(frame):
        z, n = state.value[0].copy(), state.value[1].copy()
        frame = frame.sort_values("doc_id")
        for label, packed in zip(frame["label"], frame["features"], strict=True):
            at = np.frombuffer(packed, dtype="<i4")
            w = _weights(z[at], n[at])
            bias = _bias(z[size], n[size])
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - label
            grown = np.sqrt(n[at] + g * g)
            z[at] += g - (grown - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
            z[size] += g - ((n[size] + g * g) ** 0.5 - n[size] ** 0.5) / ALPHA * bias
            n[size] += g * g
        dz, dn = z - state.value[0], n - state.value[1]
        place = np.flatnonzero(dn)
        return pd.DataFrame({"place": place, "dz": dz[place], "dn": dn[place]})

    return learn


def train(sample: DataFrame, bits: int = BITS, shards: int = SHARDS, rounds: int = ROUNDS) -> Weights:
    """Weights from rows of ``doc_id, text, label``."""
    import numpy as np

    spark = sample.sparkSession

    def make():
        features = featurizer(bits)
        return lambda columns: {"features": [
            np.unique(features(t)).astype("<i4").tobytes() for t in columns["text"]
        ]}

    rows = within_bytes(written(
        in_batches(sample, make, "doc_id bigint, label int, features binary"), "toxic-sample"
    ), "features").withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    for _ in range(rounds):
        state = spark.sparkContext.broadcast((z, n))
        changed = rows.groupBy("shard").applyInPandas(
            _learner(state, size), "place bigint, dz double, dn double"
        )
        # Averaged over the shards that met the coordinate, in a fixed order of addition.
        changes = changed.groupBy("place").agg(
            F.count("*").alias("met"),
            *(F.array_sort(F.collect_list(c)).alias(c) for c in ("dz", "dn")),
        ).select("place", *(
            (F.aggregate(c, F.lit(0.0), lambda x, y: x + y) / F.col("met")).alias(c)
            for c in ("dz", "dn")
        )).toArrow()
        place = changes["place"].to_numpy()
        z[place] += changes["dz"].to_numpy()
        n[place] += changes["dn"].to_numpy()
        state.unpersist()
    weights = _weights(z, n)
    weights[size] = _bias(z[size], n[size])
    place = np.flatnonzero(weights)
    return Weights(place.tolist(), weights[place].tolist(), bits)


def score(
    docs: DataFrame, weights: Weights, keep: dict[str, str], name: str = "score"
) -> DataFrame:
    """The columns of ``keep`` (name to type) and the score of ``text``, from 0 to 1, as ``name``."""
    import numpy as np

    size = 1 << weights.bits
    shared = docs.sparkSession.sparkContext.broadcast(tuple(weights))

    def make():
        place, weight, bits = shared.value
        table = np.zeros(size + 1)
        table[place] = weight
        features = featurizer(bits)

        def one(text: str | None) -> float:
            at = features(text)
            at = np.unique(at[table[at] != 0])
            return float(1 / (1 + np.exp(-np.clip(table[at].sum() + table[size], -35, 35))))

        return lambda columns: {name: [one(t) for t in columns["text"]]}

    schema = ", ".join(f"`{n}` {t}" for n, t in {**keep, name: "double"}.items())
    return in_batches(docs.select(*dict.fromkeys([*keep, "text"])), make, schema)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Weights:
    """Weights from the labelled documents whose fold is not 1 of 3."""
    from .learning import fold

    return train(labelled_sample(docs, labels, "toxic", fold(3) != 1, max_rows))

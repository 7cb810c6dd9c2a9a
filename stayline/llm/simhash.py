"""SimHash near-duplicates with covering locality-sensitive hashing.

A document's fingerprint is the bitwise majority of the hashes of its word
shingles. Tables of structured bit masks find the links: every bit position
gets a non-zero vector of ``radius + 1`` bits, and table ``v`` keeps the
positions whose vector has an odd product with ``v``. The vectors of ``radius``
differing positions never span the whole space, so some ``v`` is orthogonal to
all of them: two fingerprints within the radius agree in that table, always.

Only distinct fingerprints are searched; copies join their class by key.
Buckets of a table are compared pair by pair while they are small. In a larger
bucket fingerprints meet at midpoints instead: each one names all points within
half the radius that keep the bucket's bits, and all that name one point are
linked to the smallest of them. Both ways are exact; neither emits all pairs of
a large group.

Defined results: a NULL text counts as empty; a text without words has
fingerprint 0 and links like any other; repeated rows get the same class; a
NULL ``doc_id`` keeps its row and never names a class unless the whole class
has none (then the class id is NULL).
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import in_batches, row_key, written

PAIRWISE = 64  # distinct fingerprints in a bucket that are still compared in pairs


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _fingerprinter(shingle: int):
    import numpy as np
    import xxhash

    digest = xxhash.xxh64_digest

    def one(text: str | None) -> int:
        words = (text or "").encode().lower().split()
        if not words:
            return 0
        size = min(shingle, len(words))
        joined = memoryview(b" ".join(words))
        ends, at = [], -1
        for word in words:
            at += len(word) + 1
            ends.append(at)
        starts = [0, *(e + 1 for e in ends[:-1])]
        hashes = b"".join(
            [digest(joined[s:e], 42) for s, e in zip(starts, ends[size - 1:], strict=False)]
        )
        rows = np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8)
        counts = np.zeros(64, dtype=np.int64)
        for start in range(0, len(rows), 1 << 16):
            bits = np.unpackbits(rows[start:start + (1 << 16)], axis=1)
            counts += bits.sum(axis=0, dtype=np.uint32)
        return int(np.packbits(counts * 2 > len(rows)).view(">i8")[0])

    return lambda columns: {"fingerprint": [one(text) for text in columns["text"]]}


def fingerprints(docs: DataFrame, keep: dict[str, str], shingle: int = 3) -> DataFrame:
    """The columns of ``keep`` (name to type) and the ``fingerprint`` of ``text``."""
    schema = ", ".join(f"`{n}` {t}" for n, t in keep.items()) + ", fingerprint bigint"
    return in_batches(
        docs.select(*dict.fromkeys([*keep, "text"])), lambda: _fingerprinter(shingle), schema
    )


def covering_masks(radius: int) -> list[int]:
    """One mask of kept bits for each table."""
    vectors = [1 + i % ((2 << radius) - 1) for i in range(64)]
    return [
        sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2)
        for v in range(1, 2 << radius)
    ]


def _flips(spark, masks: list[int], weight: int) -> DataFrame:
    """For each table the changes of up to ``weight`` bits that it does not see."""
    rows = []
    for table, mask in enumerate(masks):
        free = [1 << i for i in range(64) if not mask >> i & 1]
        for n in range(weight + 1):
            rows += [(table, _signed(sum(c))) for c in combinations(free, n)]
    return F.broadcast(spark.createDataFrame(rows, "tab int, flip bigint"))


def links(prints: DataFrame, radius: int, pairwise: int = PAIRWISE) -> DataFrame:
    """Links ``a, b`` between the distinct values of ``fingerprint`` that connect the
    same groups as all pairs of at most ``radius`` differing bits would."""
    spark = prints.sparkSession
    masks = covering_masks(radius)
    keyed = prints.select(
        F.col("fingerprint").alias("fp"),
        F.posexplode(F.array(*(
            F.col("fingerprint").bitwiseAND(F.lit(_signed(m))) for m in masks
        ))).alias("tab", "key"),
    )
    sizes = keyed.groupBy("tab", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(keyed.join(sizes, ["tab", "key"]), "buckets")

    small = shared.where(F.col("n") <= pairwise)
    left = small.selectExpr("tab", "key", "fp AS a")
    right = small.selectExpr("tab", "key", "fp AS b")
    pairs = left.join(right, ["tab", "key"]).where(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    ).select("a", "b")

    large = shared.where(F.col("n") > pairwise)

    def points(weight: int) -> DataFrame:
        return large.join(_flips(spark, masks, weight), "tab").select(
            "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point")
        ).distinct()

    near = points(radius // 2)
    centres = near.groupBy("point").agg(F.min("fp").alias("a"), F.count("*").alias("n"))
    met = near.join(centres.where("n > 1"), "point").where("fp <> a").select(
        "a", F.col("fp").alias("b")
    )
    found = pairs.union(met)
    if radius % 2:  # the two halves are not equally long: the longer half names the pair
        far = points(radius - radius // 2).withColumnRenamed("fp", "b")
        found = found.union(
            near.withColumnRenamed("fp", "a").join(far, "point").where("a < b").select("a", "b")
        )
    return found.distinct()


def classes(prints: DataFrame, radius: int = 2) -> DataFrame:
    """``fingerprint, root`` for each distinct fingerprint; equal roots are one group."""
    distinct = prints.select("fingerprint").distinct()
    roots = components(links(distinct, radius))
    return distinct.join(
        roots, distinct.fingerprint == roots.node, "left"
    ).select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits), ``component_id``."""
    prints = written(fingerprints(docs, {"doc_id": "bigint"}, shingle), "prints")
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    member = written(classes(least, radius).join(least, "fingerprint"), "classes")
    named = member.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = member.join(named, "root").select("fingerprint", "component_id")
    return prints.join(by_print, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_per_group(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The documents without their near-duplicates, columns unchanged.

    Of each group the row with the smallest ``doc_id`` stays (NULL last; between
    rows of one id the one with the smaller content hash; equal rows once).
    """
    columns = docs.columns
    keyed = docs.withColumn("__row", row_key(*columns))
    prints = written(
        fingerprints(keyed, {"doc_id": "bigint", "__row": "bigint"}, shingle), "prints"
    )
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__row")
    by_print = prints.groupBy("fingerprint").agg(F.min(order).alias("first"))
    member = classes(by_print, radius).join(by_print, "fingerprint")
    stays = member.groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.__row").alias("__row")
    )
    copies = prints.groupBy("__row").agg(F.count("*").alias("__n"))
    stays = written(stays.join(copies, "__row"), "stays")
    kept = keyed.join(stays, "__row")
    single = kept.where("__n = 1").select(*columns)
    # Equal rows have one key; only they are compared as whole rows.
    return single.unionByName(kept.where("__n > 1").select(*columns).distinct())


"""Benchmark passages in documents: SimHash of item-sized windows, Hamming blocks, exact check.

Texts are lower-cased word lists; shingles are five words (a shorter text is one
shingle), weighted by how few items contain them (integers, so that sums do not depend on
their order). A window of an item's size is similar to the item if the weighted Jaccard
similarity of the shingle multisets is ``SIMILARITY`` or more; windows never reach over
the text's ends.

Such a window holds shingles of the item, in any order, that weigh at least ``SIMILARITY``
of it. Texts whose common shingles weigh less in total are left out first, so phrases that
many items and texts share lay no windows. In the rest, all windows are laid in which
enough weight meets, however far words have moved. They are fingerprinted by weighted
SimHash, and a multi-index over four 16-bit blocks finds all items within ``RADIUS`` bits
of a window. Heavy shingles can push similar windows further apart than any useful radius,
so every window is also put to the item that it was laid for: the result is that of
comparing all windows with all items. Candidates of both sources are compared exactly.

Items of fewer than five words match where all their words stand in a row, anywhere in a
text. Equal windows are handled once. Benchmark tables are broadcast after they have been
counted; beyond ``BROADCAST_ROWS`` the joins shuffle instead, with equal results. All of
it is DataFrame functions.

Defined results: NULL or wordless texts and items match nothing; a NULL ``doc_id``
or ``item_id`` is reported as such; repeated rows are one finding; items that repeat
each other are all reported; columns of the documents may have any names.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import SPACE, free_name, written

WORDS = 5
RADIUS = 15  # bits that the block index covers
BLOCKS = 4
SIMILARITY = 0.8
BROADCAST_ROWS = 1_000_000


def _text_key() -> Column:
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))


def _with_words(table: DataFrame, columns: list[Column]) -> DataFrame:
    """``columns`` and the word list ``__words``."""
    lower = F.lower(F.coalesce("text", F.lit("")))
    return table.select(
        *columns, F.filter(F.split(lower, f"[{SPACE}]+"), lambda w: w != "").alias("__words")
    )


def _runs_of(n: int) -> Column:
    """Hashes of all ``n`` words in a row of ``__words``."""
    return F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("__words") - n, F.lit(0))),
        lambda i: F.xxhash64(*(F.get("__words", i + k) for k in range(n))),
    )


def _with_shingles(table: DataFrame, columns: list[Column]) -> DataFrame:
    """``columns``, the shingle hashes ``sh`` in order (NULL without words), ``n_words``.

    The word list is a column of its own. Users explode ``sh`` with the outer form: the
    plain one makes Catalyst infer a filter on ``sh``, push it below and split anew
    for every shingle.
    """
    words = _with_words(table, columns)
    return words.select(
        *[c for c in words.columns if c != "__words"],
        F.when(F.size("__words") > 0, _runs_of(WORDS)).alias("sh"),
        F.size("__words").alias("n_words"),
    )


def _fingerprint(rows: DataFrame, by: str) -> DataFrame:
    """``by, print`` from rows of ``by, hash, weight``: the sign of the weighted sum of each bit."""
    sums = rows.groupBy(by).agg(*(
        F.sum(F.col("weight") * (F.shiftright("hash", b).bitwiseAND(F.lit(1)) * 2 - 1)).alias(
            f"b{b}"
        )
        for b in range(64)
    ))
    bits = [
        F.when(F.col(f"b{b}") > 0, F.lit((1 << b) - ((b == 63) << 64))).otherwise(F.lit(0))
        for b in range(64)
    ]
    value = bits[0]
    for bit in bits[1:]:
        value = value.bitwiseOR(bit)
    return sums.select(by, value.cast("bigint").alias("print"))


def _near_values(radius: int = RADIUS) -> list[int]:
    """All changes of a block by as many bits as the closest block can differ."""
    return [
        sum(c) for n in range(radius // BLOCKS + 1)
        for c in combinations([1 << i for i in range(16)], n)
    ]


def _near_items(prints: DataFrame, items: DataFrame, small) -> DataFrame:
    """``window, item`` of one size with prints at most ``RADIUS`` bits apart: in one of the blocks they
    differ by ``RADIUS // BLOCKS`` bits or fewer, so that block of the item, changed so, equals the
    window's."""
    def blocks(column: str) -> Column:
        return F.posexplode(F.array(*(
            F.shiftright(column, 16 * b).bitwiseAND(F.lit(0xFFFF)) for b in range(BLOCKS)
        ))).alias("block", "bits")

    changes = F.array(*(F.lit(v).cast("bigint") for v in _near_values()))
    index = items.select("item", "n", F.col("print").alias("item_print"), blocks("print")).select(
        "item", "n", "item_print", "block", F.explode(changes).alias("change"), "bits"
    ).select("item", "n", "item_print", "block", F.col("bits").bitwiseXOR(F.col("change")).alias("bits"))
    return (
        prints.select("window", "n", "print", blocks("print")).join(small(index), ["n", "block", "bits"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select("window", "item").distinct()
    )


def _dense_starts(hits: DataFrame, least_weight: int) -> DataFrame:
    """``key, item, start``: all windows of an item's size whose hits weigh ``SIMILARITY`` of it.

    ``hits`` has ``key, item, at, w, n, size, item_w``: shingles of the item in the text, one row
    a place. A window is named by its first hit and what stands before that: other shingles,
    which weigh ``least_weight`` at least, and together no more than the similarity leaves.
    """
    place = Window.partitionBy("key", "item").orderBy("pos", "closing")
    ends = hits.select(
        "key", "item", "at", "n", "size", "item_w",
        F.inline(F.array(
            F.struct(F.col("at").alias("pos"), F.lit(0).alias("closing"), F.col("w").alias("w")),
            F.struct((F.col("at") + F.col("n") - 1).alias("pos"), F.lit(1).alias("closing"),
                     F.lit(0).cast("bigint").alias("w")),
        )),
    )
    summed = ends.withColumn("upto", F.sum("w").over(place.rowsBetween(Window.unboundedPreceding, 0)))
    by_hit = summed.groupBy("key", "item", "at").agg(
        F.max(F.when(F.col("closing") == 1, F.col("upto"))).alias("to_end"),
        F.max(F.when(F.col("closing") == 0, F.col("upto") - F.col("w"))).alias("before"),
        F.any_value("n").alias("n"), F.any_value("size").alias("size"),
        F.any_value("item_w").alias("item_w"),
    ).withColumn(
        "prev", F.coalesce(F.lag("at").over(Window.partitionBy("key", "item").orderBy("at")), F.lit(-1))
    )
    most_before = F.floor(F.col("item_w") * (1 / SIMILARITY - 1) / least_weight)
    first = F.greatest(F.col("prev") + 1, F.col("at") - most_before, F.lit(0))
    return (
        by_hit.where(F.col("to_end") - F.col("before") >= SIMILARITY * F.col("item_w"))
        .select("key", "item", "n", "size", F.explode(F.sequence(first.cast("int"), F.col("at"))).alias("s"))
        .select("key", "item", "n", F.greatest(
            F.lit(0), F.least(F.col("s"), F.col("size") - F.col("n"))
        ).alias("start")).distinct()
    )


def findings(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, key, item_id, start_word, n_words, hamming, similarity``: for each document
    text and item the most similar window (the first of equals).

    ``key`` is the hash of the document's text.
    """
    key = _text_key().alias("key")
    item = F.xxhash64(
        F.col("item_id").isNull(), "item_id", F.coalesce("text", F.lit(""))
    ).alias("item")
    items = written(
        _with_shingles(benchmark, [F.col("item_id"), item]).where(F.col("n_words") >= WORDS)
        .dropDuplicates(["item"])
        .withColumnRenamed("n_words", "item_words"), "benchmark",
    )
    places = items.select(
        "item", F.size("sh").alias("n"), F.posexplode_outer("sh").alias("offset", "hash")
    ).where("hash IS NOT NULL")
    counted = places.agg(F.count("*"), F.countDistinct("item")).first()
    n_places, n_items = counted[0], max(counted[1], 1)
    weighted = written(
        places.groupBy("hash").agg(F.countDistinct("item").alias("df"))
        .withColumn("weight", F.round(1000 * (1 + F.log(n_items / F.col("df")))).cast("bigint")),
        "shingle-weights",
    ).select("hash", "weight")
    unseen = F.round(1000 * (1 + F.log(F.lit(float(n_items))))).cast("bigint")
    least_weight = weighted.agg(F.min("weight")).first()[0] or 1000
    own = written(
        places.groupBy("item", "hash").agg(F.count("*").alias("tf"), F.any_value("n").alias("n"))
        .join(weighted, "hash").select("item", "hash", "tf", F.col("weight").alias("w"), "n"),
        "item-shingles",
    )
    item_total = own.groupBy("item").agg(F.sum(F.col("w") * F.col("tf")).alias("item_w"))

    def small(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if n_places <= BROADCAST_ROWS else table

    # Every place of a text where a shingle of an item stands, equal texts once.
    texts = _with_shingles(docs, [key])
    hits = written(
        texts.select("key", F.size("sh").alias("size"), F.posexplode_outer("sh").alias("at", "hash"))
        .join(small(own.select("hash").distinct()), "hash", "left_semi").distinct(), "shingle-hits",
    )
    enough = hits.select("key", "hash").distinct().join(small(own), "hash").groupBy("key", "item").agg(
        F.sum(F.col("w") * F.col("tf")).alias("met")
    ).join(small(item_total), "item").where(F.col("met") >= SIMILARITY * F.col("item_w"))
    starts = written(_dense_starts(
        enough.join(hits, "key").join(small(own.select("item", "hash", "w", "n")), ["item", "hash"])
        .select("key", "item", "at", "w", "n", "size", "item_w"), least_weight,
    ), "window-starts")
    held = starts.select("key").distinct()
    held = F.broadcast(held) if held.count() <= BROADCAST_ROWS else held
    shingles = _with_shingles(
        docs.select(key, "text").join(held, "key", "left_semi").dropDuplicates(["key"]),
        [F.col("key")],
    )
    laid = written(
        starts.join(shingles, "key").select(
            "key", "item", "start", "n", F.slice("sh", F.col("start") + 1, F.col("n")).alias("sh")
        ).withColumn("window", F.xxhash64("sh")), "windows",
    )

    tokens = laid.select("window", "sh").dropDuplicates(["window"]).select(
        "window", F.explode("sh").alias("hash")
    ).groupBy("window", "hash").agg(F.count("*").alias("tf"))
    tokens = written(
        tokens.join(small(weighted), "hash", "left").select(
            "window", "hash", "tf", F.coalesce("weight", unseen).alias("w")
        ), "window-shingles",
    )
    sized = laid.select("window", "n").distinct()
    window_prints = written(_fingerprint(
        tokens.select("window", "hash", (F.col("w") * F.col("tf")).alias("weight")), "window"
    ), "window-prints")
    item_prints = written(_fingerprint(
        own.select("item", "hash", (F.col("w") * F.col("tf")).alias("weight")), "item"
    ), "item-prints")
    item_sizes = own.select("item", "n").distinct()
    candidates = _near_items(
        window_prints.join(sized, "window"), item_prints.join(item_sizes, "item"), small
    ).union(
        laid.select("window", "item")
    ).distinct()
    both = candidates.join(tokens, "window").join(
        own.select("item", "hash", F.col("tf").alias("item_tf")), ["item", "hash"]
    )
    common = both.groupBy("window", "item").agg(
        F.sum(F.col("w") * F.least("tf", "item_tf")).alias("common")
    )
    total = tokens.groupBy("window").agg(F.sum(F.col("w") * F.col("tf")).alias("window_w"))
    similar = written(
        common.join(total, "window").join(item_total, "item")
        .withColumn("similarity", F.col("common") / (
            F.col("window_w") + F.col("item_w") - F.col("common")
        ))
        .where(F.col("similarity") >= SIMILARITY)
        .select("window", "item", "similarity"), "similar-windows",
    )
    verified = similar.join(window_prints, "window").join(
        item_prints.withColumnRenamed("print", "item_print"), "item"
    ).select(
        "window", "item", "similarity",
        F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))).alias("hamming"),
    )
    best = F.max_by(
        F.struct("start", "hamming", "similarity"),
        F.struct("similarity", -F.col("hamming"), -F.col("start")),
    ).alias("best")
    # A window may be similar to other items of its size than the one it was laid for.
    by_text = (
        laid.select("key", "start", "window").distinct().join(verified, "window")
        .groupBy("key", "item").agg(best).join(items.select("item", "item_id", "item_words"), "item")
        .select(
            "key", "item_id", F.col("best.start").alias("start_word"),
            F.col("item_words").alias("n_words"), F.col("best.hamming").alias("hamming"),
            F.col("best.similarity").alias("similarity"),
        )
    )
    by_text = by_text.union(_short_items(docs, benchmark, key))
    return docs.select("doc_id", key).distinct().join(by_text, "key").select(
        "doc_id", "key", "item_id", "start_word", "n_words", "hamming", "similarity"
    )


def _short_items(docs: DataFrame, benchmark: DataFrame, key: Column) -> DataFrame:
    """Items of fewer than ``WORDS`` words, where all of them stand in a row."""
    worded = _with_words(benchmark, [F.col("item_id")]).withColumn("n_words", F.size("__words"))
    short = written(worded.where((F.col("n_words") > 0) & (F.col("n_words") < WORDS)).distinct(), "short-items")
    sizes = [r.n_words for r in short.select("n_words").distinct().orderBy("n_words").collect()]
    none = short.select(
        F.lit(None).cast("binary").alias("key"), "item_id", F.lit(0).alias("start_word"), "n_words",
        F.lit(0).alias("hamming"), F.lit(1.0).alias("similarity"),
    ).limit(0)
    texts = _with_words(docs, [key])
    for n in sizes:
        wanted = short.where(F.col("n_words") == n).select("item_id", _runs_of(n)[0].alias("hash"))
        found = texts.where(F.size("__words") >= n).select("key", F.posexplode(_runs_of(n)).alias("at", "hash"))
        none = none.union(
            found.join(wanted, "hash").groupBy("key", "item_id").agg(F.min("at").alias("start_word"))
            .select("key", "item_id", "start_word", F.lit(n).alias("n_words"),
                    F.lit(0).alias("hamming"), F.lit(1.0).alias("similarity"))
        )
    return none


def without_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark passage, columns unchanged."""
    name = free_name(docs, "key")
    found = findings(docs, benchmark).select(F.col("key").alias(name)).distinct()
    return docs.withColumn(name, _text_key()).join(found, name, "left_anti").select(*docs.columns)

"""Quality rules whose cutoffs are risk controlled on labelled holdouts.

Each rule rejects a document if a rate of its text exceeds a cutoff. Within each stratum
(language and length band) every cutoff of a rule's grid is tested: of ``n`` labelled good
documents ``k`` lie above it, and the cutoff is certified if a false rejection rate of
``ALPHA`` would leave so few or fewer with a probability of at most ``DELTA`` over the number of
all tests. That is the exact binomial (Clopper-Pearson) bound with Bonferroni's
correction: with probability ``1 - DELTA`` no chosen cutoff rejects more than ``ALPHA`` of the
good documents of its stratum. Of the certified cutoffs the one that rejects most
labelled bad documents is taken, the most lenient of equals. A rule without a certified
cutoff rejects nothing in that stratum.

Repeated word windows are found within a row: pairs of a window's whole 64-bit hash and its
place are sorted, which brings equal windows together, and the gaps between repeated
places give the words covered. All of it is DataFrame functions; the only shuffles carry
numbers, never text.

Defined results: a NULL or empty text has no words and fails the base rule; a NULL language
is a stratum of its own; labels that contradict each other count as bad; NULL labels or ids
are not used; without labels only the base rule decides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import SPACE, written

WINDOW = 8
ALPHA = 0.01
DELTA = 0.05
BANDS = (100, 1000)  # words

RULES = {
    "symbols": ("n_symbols / word_chars", (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3)),
    "repeated_lines": ("n_dup_lines / n_lines", (0.05, 0.1, 0.2, 0.3, 0.4, 0.5)),
    "repeated_words": ("n_repeat_words / n_words", (0.02, 0.05, 0.1, 0.15, 0.2, 0.25)),
    "long_words": ("word_chars / n_words", (6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0)),
}


def _windows(words: str) -> Column:
    """Sorted window hashes, each with its place."""
    made = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(words) - WINDOW, F.lit(0))),
        lambda i: F.struct(
            F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))).alias("hash"), i.alias("place"),
        ),
    )
    return F.when(F.size(words) >= WINDOW, F.sort_array(made)).otherwise(
        F.array().cast("array<struct<hash:bigint,place:int>>")
    )


def metrics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the counts of each text."""
    text = F.coalesce("text", F.lit(""))
    blank = " \t\n\x0b\x0c\r"
    lines = docs.select(
        *keep,
        F.transform(
            F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != ""), lambda w: F.xxhash64(w)
        ).alias("__w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("__lines"),
        F.length(F.translate(text, blank, "")).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).alias("n_symbols"),
    )
    sums = ["word_chars", "n_symbols"]
    sorted_ = lines.select(
        *keep, *sums, F.size("__w").alias("n_words"), F.size("__lines").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).alias("n_dup_lines"),
        _windows("__w").alias("__s"),
    )
    sums += ["n_words", "n_lines", "n_dup_lines"]

    def same(x: Column, other: Column) -> Column:
        return F.coalesce(x["hash"] == other["hash"], F.lit(False))

    places = sorted_.select(*keep, *sums, F.filter(
        "__s", lambda x, i: same(x, F.get("__s", i - 1)) | same(x, F.get("__s", i + 1))
    ).alias("__r"))
    places = places.select(*keep, *sums, F.sort_array(
        F.transform("__r", lambda x: x["place"])
    ).alias("__p"))
    covered = F.aggregate(
        F.transform("__p", lambda p, i: F.least(
            F.lit(WINDOW).cast("bigint"), F.coalesce(F.get("__p", i + 1) - p, F.lit(WINDOW)).cast("bigint")
        )),
        F.lit(0).cast("bigint"), lambda a, x: a + x,
    )
    return places.select(
        *keep, *(F.col(c).cast("bigint").alias(c) for c in sums),
        covered.alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _value(rule: str) -> Column:
    above, below = RULES[rule][0].split(" / ")
    return F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(0.0)


def _stratum() -> list[Column]:
    band = reduce(lambda c, b: c + (F.col("n_words") >= b).cast("int"), BANDS, F.lit(0))
    return [F.coalesce("lang", F.lit("")).alias("in_lang"), F.col("lang").isNull().alias("no_lang"),
            band.alias("band")]


def binomial_tail(n: str, k: str, p: float) -> Column:
    """P(X <= k) of a binomial, its terms built up in logarithms."""
    return F.expr(f"""
        aggregate(
            CASE WHEN {k} > 0 THEN sequence(1L, {k}) ELSE array() END,
            named_struct('term', {n} * ln(1 - {p}D), 'sum', exp({n} * ln(1 - {p}D))),
            (a, i) -> named_struct(
                'term', a.term + ln(({n} - i + 1) / i) + ln({p}D / (1 - {p}D)),
                'sum', a.sum + exp(a.term + ln(({n} - i + 1) / i) + ln({p}D / (1 - {p}D)))),
            a -> a.sum)""")


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``in_lang, no_lang, band, cuts``: a map of rule to cutoff for each stratum."""
    by = ["in_lang", "no_lang", "band"]
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    # An id with several texts counts once, with the row that is least in its numbers.
    numbers = [c for c in measured.columns if c not in ("doc_id", "lang")]
    rows = (
        measured.where(~base_failed()).join(known, "doc_id").groupBy("doc_id", "quality")
        .agg(F.min(F.struct(*sorted(numbers), "lang")).alias("row")).select("quality", "row.*")
        .select(*_stratum(), "quality", *(_value(r).alias(r) for r in RULES))
    )
    tests = [(r, c) for r, (_, grid) in RULES.items() for c in grid]
    good, bad = F.col("quality") == 1, F.col("quality") != 1
    counted = rows.groupBy(*by).agg(
        F.count(F.when(good, 1)).alias("n"),
        F.array(*(
            F.struct(
                F.lit(rule).alias("rule"), F.lit(cut).alias("cut"),
                F.count(F.when(good & (F.col(rule) > cut), 1)).alias("k"),
                F.count(F.when(bad & (F.col(rule) > cut), 1)).alias("caught"),
            ) for rule, cut in tests
        )).alias("tests"),
    )
    counted = written(counted, "rule-counts")  # a row a stratum
    strata = counted.count()
    level = delta / max(1, strata * len(tests))
    tested = counted.select(*by, "n", F.explode("tests").alias("t")).select(*by, "n", "t.*")
    # More above the cutoff than the allowed rate itself can never be certified.
    certified = tested.where((F.col("k") <= alpha * F.col("n")) & (F.col("n") > 0)).where(
        binomial_tail("n", "k", alpha) <= level
    )
    return (
        certified.groupBy(*by, "rule").agg(F.max_by("cut", F.struct("caught", "cut")).alias("cut"))
        .groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cut"))).alias("cuts"))
    )


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: its counts, ``base_failed`` and ``kept``."""
    measured = written(metrics(docs, ["doc_id", "lang"]), "text-counts")
    by = ["in_lang", "no_lang", "band"]
    judged = measured.select("*", *_stratum()).join(cutoffs(measured, labels), by, "left")
    breaks = reduce(
        lambda a, b: a | b,
        (F.coalesce(_value(r) > F.col("cuts")[r], F.lit(False)) for r in RULES),
    )
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & ~breaks).alias("kept"),
    )

"""How far the rule score and the supplied churn score agree.

Ranks are exact, ties share the middle one, and no task sees a whole column: values are
counted first, distinct values dealt by range, and every range starts at the sum of those
before it. Ranks are kept doubled, so they are whole numbers and all sums are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import written

_BIG = "decimal(38,0)"


def doubled_ranks(rows: DataFrame, column: str) -> DataFrame:
    """``<column>, n, below, rank2``: each value's rows, the rows below it, twice its middle rank.

    NULLs have no rank. The driver sees one sum per range.
    """
    counted = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    # Written, so that both uses see the same ranges.
    ranges = written(
        counted.repartitionByRange(column).withColumn("part", F.spark_partition_id()), "ranges"
    )
    offset, starts = 0, []
    for row in ranges.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        starts += [F.lit(row.part), F.lit(offset).cast("bigint")]
        offset += row.n
    if not starts:
        return ranges.select(column, "n", *(F.lit(0).cast("bigint").alias(c) for c in ("below", "rank2")))
    in_range = Window.partitionBy("part").orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    below = F.create_map(*starts)[F.col("part")] + F.coalesce(F.sum("n").over(in_range), F.lit(0))
    return ranges.withColumn("below", below).select(
        column, "n", "below", (2 * F.col("below") + F.col("n") + 1).alias("rank2")
    )


def _paired(rows: DataFrame) -> DataFrame:
    """Counts of the pairs of both scores and the level, with doubled ranks."""
    both = rows.where(F.col("score").isNotNull() & F.col("supplied").isNotNull())
    pairs = written(both.groupBy("score", "supplied", "risk_level").agg(F.count("*").alias("users")), "pairs")
    weighed = both.select("score", "supplied")
    of_score = doubled_ranks(weighed, "score").select("score", F.col("rank2").alias("r"))
    of_supplied = doubled_ranks(weighed, "supplied").select(
        "supplied", F.col("rank2").alias("s"), F.col("below")
    )
    return pairs.join(of_score, "score").join(of_supplied, "supplied")


def score_agreement(rows: DataFrame) -> DataFrame:
    """One row from ``score, risk_level, supplied``: rank correlation of both scores, and how well
    the supplied one tells the rules' bands apart (area under the curve, ties count half)."""
    n = F.col("users").cast(_BIG)
    total = F.sum(n)
    paired = _paired(rows)
    size = paired.agg(total).first()[0] or 0
    r, s = (F.col(c).cast(_BIG) - F.lit(int(size) + 1) for c in ("r", "s"))  # twice the distance to the mean

    def summed(value) -> F.Column:
        return F.sum((n * value.cast("decimal(30,0)")).cast(_BIG))

    def area(levels: tuple[str, ...], name: str):
        hit = F.col("risk_level").isin(*levels)
        k = F.coalesce(F.sum(F.when(hit, n)), F.lit(0).cast(_BIG))
        ranks = F.sum(F.when(hit, (n * F.col("s")).cast(_BIG)))
        # (ranks / 2 - k (k + 1) / 2) / (k (n - k))
        return (
            (ranks - k * (k + 1)).cast("double") / 2
            / F.nullif(k.cast("double") * (total - k).cast("double"), F.lit(0.0))
        ).alias(name)

    sums = paired.select("users", "risk_level", "s", (r * s).cast("decimal(30,0)").alias("rs"),
                         (r * r).cast("decimal(30,0)").alias("rr"),
                         (s * s).cast("decimal(30,0)").alias("ss"))
    return sums.agg(
        F.coalesce(total, F.lit(0)).cast("bigint").alias("users"),
        (summed(F.col("rs")).cast("double") / F.nullif(
            F.sqrt(summed(F.col("rr")).cast("double")) * F.sqrt(summed(F.col("ss")).cast("double")),
            F.lit(0.0),
        )).alias("spearman"),
        area(("alto",), "auc_high"), area(("alto", "medio"), "auc_at_risk"),
    )


def agreement_deciles(rows: DataFrame) -> DataFrame:
    """Users by level in each tenth of the supplied score; equal scores share a tenth."""
    paired = _paired(rows)
    size = int(paired.agg(F.sum("users")).first()[0] or 0)
    if not size:
        return paired.selectExpr("CAST(1 AS INT) AS decile", "risk_level", "users").limit(0)
    tenth = (F.floor(F.col("below") * 10 / F.lit(size)) + 1).cast("int")
    return paired.groupBy(tenth.alias("decile"), "risk_level").agg(F.sum("users").alias("users"))

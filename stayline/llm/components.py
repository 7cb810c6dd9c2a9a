"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung below the node's smallest neighbour."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m")
    )
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung below the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").selectExpr("v AS u", "m AS v")
    return moved.union(least.selectExpr("u", "m AS v"))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; root is the smallest node reachable.

    The links are contracted in rounds until every node hangs below its root.
    A round is a few shuffles with partial minima; each is written, so a lost
    executor costs one round at most. The driver sees two numbers a round.
    """
    now = written(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.selectExpr("u AS node", "v AS root").union(
                now.selectExpr("v AS node", "v AS root").distinct()
            )
        before = state
        now = written(_small_star(_large_star(now).distinct()).distinct(), "links")

"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node's neighbourhood. Rows may repeat, but are no more than the links."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    others = down.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return least.select("a", F.col("least").alias("b")).unionByName(others).distinct()


def _unsettled(stars: DataFrame) -> int:
    """How many nodes have two smaller neighbours, or both a smaller and a larger one. Without any, every link leads to the least node of its group."""
    ends = stars.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(stars.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    each = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return each.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).count()


def roots(links: DataFrame) -> DataFrame:
    """For links (a, b) of two different nodes: each linked node (a) and the least node it can reach (b).

    Links may repeat and go either way. The least node itself has no row. The
    number of rounds grows with the logarithm of the longest chain; both halves
    of a round are written, so nothing is computed twice, plans stay short and a
    lost executor costs half a round.
    """
    stars = materialize(_small_star(links), "stars")
    while _unsettled(stars):
        stars = materialize(_small_star(materialize(_large_star(stars), "large-stars")), "stars")
    return stars

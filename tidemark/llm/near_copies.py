"""One document of each group of near copies: texts whose sets of five-word shingles are alike.

Candidates come from SimHash first: fingerprints of the sets, compared through
the index over byte positions of :mod:`tidemark.llm.simhash`, and confirmed on
whole sets. Its lists can be kept only up to a few differing bits, while sets
of similarity 0.8 differ in about ten of 64, so the index alone would miss
links. What it cannot promise the bands of :mod:`tidemark.llm.minhash` find:
each set is confirmed with one leader of its bands in the same pass over the
texts, and later only with sets that no link joins to it yet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import minhash, simhash
from tidemark.session import materialize

WIDTH = 5
#: Differing bits that the index over byte positions finds for certain: its lists hold five of eight bytes.
BITS = 3


def simhash_pairs(sets: DataFrame, k: int = BITS) -> DataFrame:
    """Pairs (a, b, a_key, b_key) of different sets whose SimHash fingerprints differ in at most ``k`` bits.

    ``sets`` has (key, fp, n, sign). Sets of one fingerprint are paired with the least of
    them, and that one with the least set of a lesser fingerprint nearby, so that
    a crowd of ``n`` sets has fewer than ``2 n`` pairs.
    """
    each = materialize(sets.where("n > 0").groupBy("fp").agg(F.min("key").alias("key"), F.min("sign").alias("sign")), "signs")
    heads = each.groupBy("sign").agg(F.min(F.struct("fp", "key")).alias("head"), F.count(F.lit(1)).alias("all"))
    heads = materialize(heads.select("sign", F.col("head.fp").alias("b"), F.col("head.key").alias("b_key"), "all"), "sign-heads")
    same = each.join(heads.where("all > 1"), "sign").where("fp <> b").select(F.col("fp").alias("a"), "b", F.col("key").alias("a_key"), "b_key")
    near = simhash.links(heads.select(F.col("sign").alias("fp")), k).groupBy(F.greatest("a", "b").alias("sign")).agg(F.min(F.least("a", "b")).alias("other"))
    first = heads.select("sign", F.col("b").alias("a"), F.col("b_key").alias("a_key"))
    others = heads.select(F.col("sign").alias("other"), "b", "b_key")
    return same.unionByName(near.join(first, "sign").join(others, "other").select("a", "b", "a_key", "b_key"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the smallest key, null keys last.

    Two texts are near copies if their sets of five-word shingles have a Jaccard
    index of 0.8 or more; groups are what links of near copies lead to. Null and
    empty texts, and texts of white space, are one group. Of rows that repeat key
    and set one stays. Columns stay as they are; an empty table stays empty.
    """
    sets = minhash.marked(docs, key, text, WIDTH, simhash.majority)
    links = minhash.Links(docs, sets, key, text, WIDTH, minhash.LEAST)
    trees = links.trees(sets, simhash_pairs(sets))
    return simhash.first_of_groups(docs, sets.select("key", "fp"), trees, minhash.fingerprints(WIDTH), key, text)

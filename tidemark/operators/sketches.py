"""Approximate percentiles from mergeable sketches that are kept as a column.

A sketch of the values of a file, a day or an area is a few kilobytes whatever
the number of rows. Sketches of parts merge into one of the whole, so a table
of them answers for any union of its parts without the rows being read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a sketch; a larger one is more exact.
SIZE = 4000


def rank_error(size: int = SIZE) -> float:
    """How far the rank of an answer may lie from the asked one, as a share of the rows, in 99 of 100 cases (published figure of KLL sketches)."""
    return 2.296 / size**0.9021


def sketched(df: DataFrame, col: str, keys: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """One row per key (or one in all) with the ``sketch`` of a number column; NULLs and not-a-number are left out."""
    value = F.col(f"`{col}`").cast("double")
    return df.where(value.isNotNull() & ~F.isnan(value)).groupBy(*keys).agg(F.kll_sketch_agg_double(value, F.lit(size)).alias("sketch"))


def merged(sketches: DataFrame, keys: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """Sketches of coarser groups from those of finer ones."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))


def sketch_percentiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Rows (keys, prob, value), each value within :func:`rank_error` of its rank; a group without values gives NULLs."""
    held = F.coalesce(F.kll_sketch_get_n_double("sketch"), F.lit(0)) > 0
    values = F.when(held, F.kll_sketch_get_quantile_double("sketch", F.array(*(F.lit(float(p)) for p in probs))))
    rows = [F.struct(F.lit(float(p)).alias("prob"), F.get(values, F.lit(i)).alias("value")) for i, p in enumerate(probs)]
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], F.inline(F.array(*rows)))

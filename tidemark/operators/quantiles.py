"""Exact quantiles and modes, plain or per group, without heavy groups.

Spark's ``percentile`` keeps every distinct value of a group in one task. That
is right for groups of ordinary size and is used for them. Groups above
``HOT_ROWS`` take another exact way in three passes over the data:

1. a mergeable sketch gives a narrow bracket around each wanted rank;
2. exact counts below and inside the brackets say where the rank lies;
3. only the rows of that stretch are counted by value and ranked.

If a sketch were ever off, the counts of pass 2 move the search to the stretch
that does hold the rank, so the answer stays exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialize

HOT_ROWS = 200_000
SKETCH_ACCURACY = 10_000


def _as_double(name: str):
    return F.col(f"`{name}`").cast("double")


def _plain(df: DataFrame, cols: Sequence[str], probs: Sequence[float], keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.percentile(_as_double(c), list(probs)).alias(c) for c in cols])


def _bracketed(df: DataFrame, cols: Sequence[str], probs: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """The three-pass way, for groups too large for one task."""
    group = [*keys, "_q_col"]
    pairs = F.array(*[F.struct(F.lit(c).alias("_q_col"), _as_double(c).alias("_q_val")) for c in cols])
    long = df.select(*keys, F.inline(pairs)).where("_q_val is not null")

    slack = 2.0 / SKETCH_ACCURACY
    lows = [max(0.0, p - slack) for p in probs]
    highs = [min(1.0, p + slack) for p in probs]
    sketch = long.groupBy(*group).agg(
        F.percentile_approx("_q_val", lows + highs, SKETCH_ACCURACY).alias("_q_cut"),
        F.count("*").alias("_q_n"),
    )
    width = len(probs)
    wanted = F.array(
        *[
            F.struct(
                F.lit(i).alias("_q_at"),
                (F.lit(float(p)) * (F.col("_q_n") - 1)).alias("_q_rank"),
                F.col("_q_cut")[i].alias("_q_low"),
                F.col("_q_cut")[width + i].alias("_q_high"),
            )
            for i, p in enumerate(probs)
        ]
    )
    targets = materialize(sketch.select(*group, F.inline(wanted)), "targets")
    at = [*group, "_q_at"]

    def match(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, group)

    counted = (
        match(long, targets)
        .groupBy(*at)
        .agg(
            F.count_if(F.col("_q_val") < F.col("_q_low")).alias("_q_below"),
            F.count_if(F.col("_q_val") <= F.col("_q_high")).alias("_q_upto"),
        )
    )
    # Ranks start at 0. Keep the stretch (or stretches) that hold both
    # neighbours of the fractional rank.
    placed = targets.join(counted, at).select(
        *at,
        "_q_rank",
        F.when(F.floor("_q_rank") >= F.col("_q_below"), F.col("_q_low")).alias("_q_from"),
        F.when(F.ceil("_q_rank") < F.col("_q_upto"), F.col("_q_high")).alias("_q_to"),
        F.when(F.floor("_q_rank") >= F.col("_q_below"), F.col("_q_below")).otherwise(0).alias("_q_before"),
    )
    placed = materialize(placed, "stretches")
    inside = (F.col("_q_from").isNull() | (F.col("_q_val") >= F.col("_q_from"))) & (
        F.col("_q_to").isNull() | (F.col("_q_val") <= F.col("_q_to"))
    )
    by_value = (
        match(long, placed).where(inside).groupBy(*at, "_q_rank", "_q_before", "_q_val").agg(
            F.count("*").alias("_q_c")
        )
    )
    running = Window.partitionBy(*at).orderBy("_q_val").rowsBetween(Window.unboundedPreceding, 0)
    last = by_value.withColumn("_q_last", F.col("_q_before") + F.sum("_q_c").over(running) - 1)
    first = F.col("_q_last") - F.col("_q_c") + 1

    def value_at(rank):
        return F.max(F.when((first <= rank) & (F.col("_q_last") >= rank), F.col("_q_val")))

    share = F.first("_q_rank") - F.floor(F.first("_q_rank"))
    low, high = value_at(F.floor("_q_rank")), value_at(F.ceil("_q_rank"))
    found = last.groupBy(*at).agg((low * (1 - share) + high * share).alias("_q_value"))
    wide = []
    for c in cols:
        parts = [F.max(F.when((F.col("_q_col") == c) & (F.col("_q_at") == i), F.col("_q_value"))) for i in range(width)]
        wide.append(F.when(parts[0].isNotNull(), F.array(*parts)).alias(c))
    return found.groupBy(*keys).agg(*wide)


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    keys: Sequence[str] = (),
    hot_rows: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles: one row per key, one array per column.

    Rows with a NULL key are left out. The rows are counted first (unless the
    caller knows their number); only a table above the limit has its groups
    counted, which decides between the two ways above.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    df = df.select(*keys, *[c for c in cols if c not in keys])
    if (df.count() if rows is None else rows) <= limit:
        return _plain(df.na.drop(subset=list(keys)) if keys else df, cols, probs, keys)
    if not keys:
        return _bracketed(df, cols, probs, keys)
    df = df.na.drop(subset=list(keys))
    hot = df.groupBy(*keys).count().where(F.col("count") > limit).drop("count")
    if hot.isEmpty():
        return _plain(df, cols, probs, keys)
    cool = _plain(df.join(hot, list(keys), "left_anti"), cols, probs, keys)
    # From the groups themselves, so that one whose values are all NULL keeps its row.
    heavy = hot.join(_bracketed(df.join(hot, list(keys), "left_semi"), cols, probs, keys), list(keys), "left")
    return cool.unionByName(heavy)


def medians(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = (),
    hot_rows: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Exact median per column (and group); NULLs are skipped."""
    table = exact_quantiles(df, cols, [0.5], keys, hot_rows, rows)
    return table.select(*keys, *[F.col(f"`{c}`")[0].alias(c) for c in cols])


def value_counts(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows per (keys, column, value) of several columns, NULLs left out."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("_m_col"), F.col(f"`{c}`").cast("string").alias("_m_val")) for c in cols]
    )
    long = df.na.drop(subset=list(keys)) if keys else df
    long = long.select(*keys, F.inline(pairs)).where("_m_val is not null")
    return long.groupBy(*keys, "_m_col", "_m_val").agg(F.count("*").alias("_m_n"))


def modes_of(counts: DataFrame, schema: T.StructType, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Modes from :func:`value_counts` of the same or finer keys."""
    sums = counts.groupBy(*keys, "_m_col", "_m_val").agg(F.sum("_m_n").alias("_m_n"))
    rank = F.struct((-F.col("_m_n")).alias("c"), F.col("_m_val").alias("v"))
    picks = [F.min(F.when(F.col("_m_col") == c, rank))["v"].cast(schema[c].dataType).alias(c) for c in cols]
    return sums.groupBy(*keys).agg(*picks)


def modes(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Most frequent value per text column (and group); ties go to the smallest.

    Counts are made per (group, column, value) first, so that even a group
    with most of the rows is reduced before it meets in one task.
    """
    return modes_of(value_counts(df, cols, keys), df.schema, cols, keys)


def scalars(table: DataFrame) -> dict:
    """The single row of a key-less aggregate as plain values for literals."""
    return table.first().asDict()

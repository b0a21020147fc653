"""Summaries of whole tables: descriptions, distributions, grids.

Scalars such as extremes and quantiles come from one aggregate and enter the
next step as literals. Fixed lattices are generated and left-joined, so empty
cells show where the definition wants them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.quantiles import exact_quantiles, medians, scalars
from tidemark.operators.sketches import sketch_percentiles, sketched

QUARTILES = (0.25, 0.5, 0.75)


def _rows(df: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn one wide row into several by listing what each should hold."""
    structs = [F.struct(*[col.alias(name) for name, col in row.items()]) for row in rows]
    return df.select(F.inline(F.array(*structs)))


def missing_fraction(df: DataFrame) -> DataFrame:
    """Share of NULLs per column, in one pass."""
    wide = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("int")).alias(c) for c in df.columns])
    return _rows(wide, [{"column": F.lit(c), "missing": F.col(f"`{c}`")} for c in df.columns])


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quartiles per column."""
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(
        *[fn(F.col(f"`{c}`").cast("double")).alias(f"{name}:{c}") for c in cols for name, fn in measures.items()]
    )
    cut = scalars(exact_quantiles(df, cols, QUARTILES))
    rows = []
    for c in cols:
        row = {"column": F.lit(c), **{name: F.col(f"`{name}:{c}`") for name in measures}}
        for label, value in zip(("q25", "q50", "q75"), cut[c] or (None,) * 3):
            row[label] = F.lit(value).cast("double")
        rows.append(row)
    return _rows(wide, rows)


def count_by(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).count()


def extent(df: DataFrame, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    """Extremes and centre of a point table."""
    return df.agg(
        F.min(latitude).alias("min_lat"),
        F.max(latitude).alias("max_lat"),
        F.avg(latitude).alias("mean_lat"),
        F.min(longitude).alias("min_lon"),
        F.max(longitude).alias("max_lon"),
        F.avg(longitude).alias("mean_lon"),
    )


def percentiles(df: DataFrame, col: str, probs: Sequence[float], approximate: bool = False) -> DataFrame:
    """Percentiles as rows (prob, value): exact, or on request from one pass with a sketch and its ``rank_error``."""
    if approximate:
        return sketch_percentiles(sketched(df, col), probs)
    table = exact_quantiles(df, [col], probs)
    return _rows(table, [{"prob": F.lit(float(p)), "value": F.col(col)[i]} for i, p in enumerate(probs)])


def distinct_counts(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column; optionally by mergeable sketch."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    wide = df.agg(*[count(c).alias(c) for c in cols])
    return _rows(wide, [{"column": F.lit(c), "n_distinct": F.col(c)} for c in cols])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def _cells(df: DataFrame, x: str, y: str, dx: float) -> tuple[DataFrame, Column, Column]:
    low = df.agg(F.min(x).cast("double").alias("x"), F.min(y).cast("double").alias("y")).first()
    x0 = F.lit(None).cast("double") if low["x"] is None else F.lit(low["x"] - 0.5 * dx)
    y0 = F.lit(None).cast("double") if low["y"] is None else F.lit(low["y"] - 0.5 * dx)
    df = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumns(
        {"ix": F.floor((F.col(x) - x0) / dx), "iy": F.floor((F.col(y) - y0) / dx)}
    )
    return df, x0 + (F.col("ix") + 0.5) * dx, y0 + (F.col("iy") + 0.5) * dx


def density_grid(df: DataFrame, x: str = "easting", y: str = "northing", dx: float = 1000.0) -> DataFrame:
    """Points per square cell; cells start half a cell before the smallest point."""
    df, cx, cy = _cells(df, x, y, dx)
    return df.groupBy("ix", "iy").agg(F.count("*").alias("n")).select("ix", "iy", cx.alias("x"), cy.alias("y"), "n")


def mean_grid(
    df: DataFrame, value: str = "riskLabel", x: str = "easting", y: str = "northing", dx: float = 10000.0
) -> DataFrame:
    """Mean of a value per cell, for cells with a positive sum."""
    df, cx, cy = _cells(df, x, y, dx)
    return (
        df.groupBy("ix", "iy")
        .agg(F.avg(value).alias("mean"), F.sum(value).alias("_sum"))
        .where("_sum > 0")
        .select("ix", "iy", cx.alias("x"), cy.alias("y"), "mean")
    )


def histogram(df: DataFrame, col: str, bins: int = 30, low: float | None = None, high: float | None = None) -> DataFrame:
    """Counts of equal bins between the extremes (or given edges); the last is closed."""
    value = F.col(col).cast("double")
    if low is None or high is None:
        ends = df.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
        low = ends["low"] if low is None else low
        high = ends["high"] if high is None else high
    if low is None:
        raise ValueError(f"column {col} has no values")
    if high == low:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((value - low) / width), F.lit(bins - 1).cast("bigint"))
    counts = df.where((value >= low) & (value <= high)).groupBy(place.alias("bin")).count()
    edges = df.sparkSession.range(bins).select(
        F.col("id").alias("bin"),
        (F.lit(low) + F.col("id") * width).alias("from"),
        (F.lit(low) + (F.col("id") + 1) * width).alias("to"),
    )
    return edges.join(counts, "bin", "left").na.fill(0, ["count"])


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix as rows (a, b, r); NULLs are left out pair by pair."""
    pairs = list(combinations_with_replacement(cols, 2))
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    rows = []
    for a, b in pairs:
        r = F.col(f"`{a}|{b}`")
        rows.append({"a": F.lit(a), "b": F.lit(b), "r": r})
        if a != b:
            rows.append({"a": F.lit(b), "b": F.lit(a), "r": r})
    return _rows(wide, rows)


def _lattice(df: DataFrame, low: float, high: float, width: float) -> DataFrame:
    points = math.ceil(round((high + width - low) / width, 9))
    return df.sparkSession.range(points).select(
        F.col("id").alias("step"), (F.lit(low) + F.col("id") * width).alias("at")
    )


def _on_lattice(df: DataFrame, step: Column, lattice: DataFrame) -> DataFrame:
    counts = df.groupBy(step.alias("step")).agg(F.count("*").alias("_n"))
    return lattice.join(counts, "step", "left").na.fill(0, ["_n"])


def cumulative_distribution(df: DataFrame, col: str, low: float, high: float, width: float) -> DataFrame:
    """Share of all rows between ``low`` and each lattice value."""
    total = df.count()
    value = F.col(col)
    step = F.greatest(F.ceil((value - low) / width), F.lit(0).cast("bigint"))
    table = _on_lattice(df.where(value >= low), step, _lattice(df, low, high, width))
    running = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return table.select("at", (F.sum("_n").over(running) / F.lit(float(total))).alias("density"))


def probability_distribution(df: DataFrame, col: str, low: float, high: float, width: float) -> DataFrame:
    """Share of all rows within half a width of each lattice value."""
    total = df.count()
    step = F.floor((F.col(col) - low) / width + 0.5)
    table = _on_lattice(df.where(F.col(col).isNotNull()), step, _lattice(df, low, high, width))
    return table.select("at", (F.col("_n") / F.lit(float(total))).alias("density"))


def box_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges, and outliers per column."""
    cut = scalars(exact_quantiles(df, cols, QUARTILES))
    aggs, rows = [], []
    for c in cols:
        q1, q2, q3 = cut[c] or (None,) * 3
        value = F.col(c).cast("double")
        low = F.lit(None if q1 is None else q1 - 1.5 * (q3 - q1)).cast("double")
        high = F.lit(None if q1 is None else q3 + 1.5 * (q3 - q1)).cast("double")
        inside = (value >= low) & (value <= high)
        aggs += [
            F.min(F.when(inside, value)).alias(f"{c}:low"),
            F.max(F.when(inside, value)).alias(f"{c}:high"),
            F.count_if(~inside).alias(f"{c}:out"),
        ]
        rows.append(
            {
                "column": F.lit(c),
                "q25": F.lit(q1).cast("double"),
                "q50": F.lit(q2).cast("double"),
                "q75": F.lit(q3).cast("double"),
                "whisker_low": F.col(f"`{c}:low`"),
                "whisker_high": F.col(f"`{c}:high`"),
                "outliers": F.col(f"`{c}:out`"),
            }
        )
    return _rows(df.agg(*aggs), rows)


def shares_of_row(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Scale a set of columns so that each row sums to one."""
    total = sum((F.col(f"`{c}`") for c in cols[1:]), F.col(f"`{cols[0]}`"))
    return df.withColumns({c: F.col(f"`{c}`") / total for c in cols})


def scaled_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: column medians scaled to sum to one."""
    return shares_of_row(medians(df, cols), cols)


def data_contract(df: DataFrame, required: Sequence[str], key: str = "postcode") -> DataFrame:
    """One row of facts: rows, missing required columns, keys that repeat."""
    absent = [c for c in required if c not in df.columns]
    repeats = df.groupBy(key).count().agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n_rows"),
        F.count_if(F.col("count") > 1).alias("repeated_keys"),
    )
    return repeats.select("n_rows", F.lit(len(absent)).cast("bigint").alias("missing_columns"), "repeated_keys")

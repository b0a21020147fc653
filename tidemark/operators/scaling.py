"""Feature preparation fitted by one aggregate and applied as literals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import clamp
from tidemark.operators.quantiles import exact_quantiles, medians, modes, scalars
from tidemark.operators.ranking import category_codes
from tidemark.operators.selection import numeric_and_other


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def cap_outliers(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Clip columns to 1.5 interquartile ranges beyond their quartiles."""
    cols = _names(cols)
    cut = scalars(exact_quantiles(df, cols, [0.25, 0.75]))
    capped = {}
    for c in cols:
        if cut[c] is not None:
            q1, q3 = cut[c]
            room = 1.5 * (q3 - q1)
            capped[c] = clamp(F.col(f"`{c}`").cast("double"), F.lit(q1 - room), F.lit(q3 + room))
    return df.withColumns(capped)


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Zero mean and unit population deviation; constant columns stay centred."""
    facts = scalars(
        df.agg(*[F.avg(c).alias(f"m:{c}") for c in cols], *[F.stddev_pop(c).alias(f"s:{c}") for c in cols])
    )
    return df.withColumns({c: (F.col(c) - facts[f"m:{c}"]) / (facts[f"s:{c}"] or 1.0) for c in cols if facts[f"m:{c}"] is not None})


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Scale to 0..1; a constant column becomes 0."""
    facts = scalars(df.agg(*[F.min(c).alias(f"l:{c}") for c in cols], *[F.max(c).alias(f"h:{c}") for c in cols]))
    return df.withColumns(
        {
            c: (F.col(c) - facts[f"l:{c}"]) / float((facts[f"h:{c}"] - facts[f"l:{c}"]) or 1.0)
            for c in cols
            if facts[f"l:{c}"] is not None
        }
    )


def robust(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Centre on the median and divide by the interquartile range."""
    cut = scalars(exact_quantiles(df, cols, [0.25, 0.5, 0.75]))
    return df.withColumns(
        {c: (F.col(c) - cut[c][1]) / ((cut[c][2] - cut[c][0]) or 1.0) for c in cols if cut[c] is not None}
    )


def one_hot(df: DataFrame, col: str, categories: Sequence[str], prefix: str | None = None) -> DataFrame:
    """One 0/1 column per known category; anything else is all zeros."""
    prefix = prefix or f"{col}_"
    return df.withColumns({f"{prefix}{v}": F.when(F.col(col) == v, 1).otherwise(0) for v in sorted(categories)})


def label_codes(df: DataFrame, col: str, out: str) -> DataFrame:
    """Attach the place of each label in sorted order."""
    return df.join(category_codes(df, col, out), col, "left")


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight ``n / (classes * count)`` per row."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).count()
    facts = counts.agg(F.sum("count").alias("n"), F.count("*").alias("k")).first()
    share = float(facts["n"] or 0) / float(facts["k"] or 1)
    return df.join(counts.select(label, (F.lit(share) / F.col("count")).alias(out)), label)


def fixed_weights(df: DataFrame, label: str, weights: dict, out: str = "weight") -> DataFrame:
    column = None
    for value, weight in weights.items():
        test = F.col(label) == value
        column = F.when(test, float(weight)) if column is None else column.when(test, float(weight))
    return df.withColumn(out, column.otherwise(1.0))


def fit_fill(df: DataFrame, cols: Sequence[str]) -> dict:
    """Fill values: medians of numbers, most frequent of the rest."""
    numeric, other = numeric_and_other(df, cols)
    values: dict = {}
    if numeric:
        values |= scalars(medians(df, numeric))
    if other:
        values |= scalars(modes(df, other))
    return {name: value for name, value in values.items() if value is not None}


def apply_fill(df: DataFrame, values: dict) -> DataFrame:
    """Fill NULLs with fitted values; whole-number columns become doubles."""
    numeric, _ = numeric_and_other(df, list(values))
    return df.withColumns(
        {
            name: F.coalesce(F.col(f"`{name}`").cast("double") if name in numeric else F.col(f"`{name}`"), F.lit(value))
            for name, value in values.items()
            if name in df.columns
        }
    )

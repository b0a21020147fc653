"""Filling missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.constants import AGE_SHARES, IMPUTATION_CONSTANTS
from tidemark.functions.geodesy import add_wgs84
from tidemark.functions.postcode import postcode_district, with_postcode_keys
from tidemark.operators.knn import nearest
from tidemark.operators.lookups import fall_back
from tidemark.operators.quantiles import medians, modes, modes_of, scalars, value_counts
from tidemark.operators.ranking import keep_priority
from tidemark.operators.scaling import apply_fill
from tidemark.operators.selection import numeric_and_other
from tidemark.operators.stats import scaled_medians
from tidemark.session import materialize


def columns_with_gaps(df: DataFrame) -> list[str]:
    """Names of columns that hold a NULL; one pass, one row back."""
    row = df.agg(*[F.max(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c]]


def _as_doubles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def by_postcode(
    df: DataFrame, labelled: DataFrame, columns: Sequence[str] | None = None, constants: dict = IMPUTATION_CONSTANTS
) -> DataFrame:
    """Fill from the labelled units of the sector, then the district, then all.

    Numbers take medians, and at last the overall median. Text takes modes of
    labelled rows that are complete in all filled text columns, and at last a
    constant. Sector and district become columns of the result.
    """
    numeric, other = numeric_and_other(df, columns if columns is not None else columns_with_gaps(df))
    df, labelled = with_postcode_keys(df), with_postcode_keys(labelled)
    keys = ["postcodeSector", "postcodeDistrict"]
    if numeric:
        rows = labelled.count()
        levels = [(key, medians(labelled, numeric, [key], rows=rows)) for key in keys]
        df = fall_back(_as_doubles(df, numeric), numeric, levels, scalars(medians(labelled, numeric, rows=rows)))
    if other:
        # Counted once per sector and district; both levels are summed from that.
        counts = value_counts(labelled.na.drop(subset=other), other, keys)
        levels = [(key, modes_of(counts, labelled.schema, other, [key])) for key in keys]
        df = fall_back(df, other, levels, constants)
    return df


def by_neighbours(
    df: DataFrame,
    labelled: DataFrame,
    columns: Sequence[str] | None = None,
    k: int = 5,
    constants: dict = IMPUTATION_CONSTANTS,
) -> DataFrame:
    """Fill from the ``k`` nearest labelled units.

    The neighbours are found once per place that has a row in need of any fill
    and serve all its rows and columns; missing values among them are skipped
    afterwards. Rows may repeat a postcode or lack one.
    """
    numeric, other = numeric_and_other(df, columns if columns is not None else columns_with_gaps(df))
    filled = [*numeric, *other]
    if not filled:
        return df
    gap = F.lit(False)
    for c in filled:
        gap = gap | F.col(c).isNull()
    asked = _places(df.where(gap))
    near = nearest(asked, labelled.select("postcode", "easting", "northing", *filled), k, "_asker", "postcode")
    # A group has at most k rows, so plain aggregates are exact and cheap.
    stats = near.groupBy("_asker").agg(
        *[F.median(F.col(c).cast("double")).alias(f"_n_{c}") for c in numeric],
        *[F.mode(c, True).alias(f"_n_{c}") for c in other],
    )
    last = (scalars(medians(labelled, numeric)) if numeric else {}) | {c: constants.get(c) for c in other}
    joined = _at_places(_as_doubles(df, numeric), stats)
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_n_{c}"), F.lit(last[c])) for c in filled}
    ).drop(*[f"_n_{c}" for c in filled])


def _places(df: DataFrame) -> DataFrame:
    """The distinct places of some rows, each its own name."""
    return df.select("easting", "northing").distinct().withColumn("_asker", F.struct("easting", "northing"))


def _at_places(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Rows with what was found at their place; rows without a place find nothing."""
    found = stats.withColumns({"_e": F.col("_asker.easting"), "_n": F.col("_asker.northing")}).drop("_asker")
    return df.join(found, (df["easting"] == F.col("_e")) & (df["northing"] == F.col("_n")), "left").drop("_e", "_n")


def by_constant(df: DataFrame, constants: dict = IMPUTATION_CONSTANTS) -> DataFrame:
    """Fill every column that has a constant."""
    return apply_fill(df, {c: v for c, v in constants.items() if c in df.columns})


def within_table_by_postcode(df: DataFrame, numeric: Sequence[str], other: Sequence[str]) -> DataFrame:
    """Fill a table from itself, each step seeing what the step before filled.

    Numbers: sector, district, overall median. Text: district, sector, overall
    mode. A step reads its input twice, so each result is written once.
    """
    if numeric:
        df, rows = _as_doubles(df, numeric), df.count()
        for key in ("postcodeSector", "postcodeDistrict"):
            df = materialize(fall_back(df, numeric, [(key, medians(df, numeric, [key], rows=rows))], {}), "filled")
        df = apply_fill(df, {c: v for c, v in scalars(medians(df, numeric, rows=rows)).items() if v is not None})
    if other:
        for key in ("postcodeDistrict", "postcodeSector"):
            df = materialize(fall_back(df, other, [(key, modes(df, other, [key]))], {}), "filled")
        df = apply_fill(df, {c: v for c, v in scalars(modes(df, other)).items() if v is not None})
    return df


def within_table_by_neighbours(
    df: DataFrame, numeric: Sequence[str], other: Sequence[str], k: int = 5, key: str = "postcode"
) -> DataFrame:
    """Fill a table from its own nearest rows.

    Numbers: mean of the ``k`` nearest rows that have the value. Text: mode of
    the five nearest rows (the row itself among them), else the overall mode.
    """
    fills = []
    for c in numeric:
        asked = _places(df.where(F.col(c).isNull()))
        donors = df.where(F.col(c).isNotNull()).select(
            F.col(key).alias("_donor"), "easting", "northing", F.col(c).cast("double").alias("_value")
        )
        near = nearest(asked, donors, k, "_asker", "_donor")
        fills.append((near.groupBy("_asker").agg(F.avg("_value").alias(f"_n_{c}")), {c: None}))
    if other:
        gap = F.lit(False)
        for c in other:
            gap = gap | F.col(c).isNull()
        asked = _places(df.where(gap))
        donors = df.select(F.col(key).alias("_donor"), "easting", "northing", *other)
        near = nearest(asked, donors, 5, "_asker", "_donor")
        stats = near.groupBy("_asker").agg(*[F.mode(c, True).alias(f"_n_{c}") for c in other])
        fills.append((stats, scalars(modes(df, other))))
    df = _as_doubles(df, numeric)
    for table, last in fills:
        df = _at_places(df, table)
        df = df.withColumns({c: F.coalesce(F.col(c), F.col(f"_n_{c}"), F.lit(v)) for c, v in last.items()})
        df = df.drop(*[f"_n_{c}" for c in last])
    return df


def district_shares(districts: DataFrame) -> DataFrame:
    """Fill housing-age shares with medians scaled to sum to one."""
    return apply_fill(districts, scalars(scaled_medians(districts, AGE_SHARES)))


def adapt_bare_units(units: DataFrame, districts: DataFrame, price: float | None = None) -> DataFrame:
    """Give bare units every feature the probability model expects.

    Missing prices take the median price of the table, or ``price`` where the
    table has none.
    """
    df = units.withColumn("postcodeDistrict", postcode_district(F.col("postcode")))
    df = add_wgs84(df.join(districts, "postcodeDistrict", "left"))
    if "medianPrice" in df.columns:
        middle = scalars(medians(units, ["medianPrice"]))["medianPrice"]
        price_column = F.coalesce(F.col("medianPrice"), F.lit(price if middle is None else middle))
    else:
        price_column = F.lit(price)
    return df.withColumns(
        {
            "medianPrice": price_column.cast("double"),
            "historicallyFlooded": F.lit(0),
            "distanceToWatercourse": F.coalesce("distanceToWatercourse", F.lit(0.0)),
            "elevation": F.coalesce("elevation", F.lit(0.0)),
        }
    )


def first_per_postcode(df: DataFrame) -> DataFrame:
    """One row per postcode, for tables that may repeat one."""
    return keep_priority(df, ["postcode"], [F.col(c) for c in df.columns if c != "postcode"])

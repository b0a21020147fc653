"""Choosing columns and rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import LEVEL_FIELDS, PREPARED_UNIT_ORDER, RAINFALL_STATION_NAME, RAW_FEATURES
from tidemark.functions.readings import number_or_null


class NoRows(ValueError):
    """A selection that must leave rows left none."""


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise NoRows(message)
    return df


def raw_features(df: DataFrame) -> DataFrame:
    return df.select(*RAW_FEATURES)


def prepared_order(df: DataFrame) -> DataFrame:
    return df.select(*[name for name in PREPARED_UNIT_ORDER if name in df.columns])


def numeric_and_other(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[list[str], list[str]]:
    """Column names by type, from the schema alone."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    return numeric, [f.name for f in fields if f.name not in numeric]


def with_keys_in(df: DataFrame, requests: DataFrame, key: str = "postcode") -> DataFrame:
    """Rows whose key is requested."""
    return df.join(requests.select(key), key, "left_semi")


def without_match(requests: DataFrame, df: DataFrame, key: str = "postcode") -> DataFrame:
    """Requests whose key is not in the table."""
    return requests.join(df.select(key), key, "left_anti")


def in_range(df: DataFrame, limits: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Rows inside closed ranges per column, then without any NULL."""
    for name, (low, high) in limits.items():
        if low is not None:
            df = df.where(F.col(name) >= low)
        if high is not None:
            df = df.where(F.col(name) <= high)
    return df.na.drop("any")


def flooded_only(df: DataFrame, flag: str = "historicallyFlooded") -> DataFrame:
    if flag not in df.columns:
        raise KeyError(flag)
    return df.where(F.col(flag) == 1)


def split_stations(stations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rainfall stations (without level columns) and level stations, both located."""
    is_rain = F.col("stationName").eqNullSafe(F.lit(RAINFALL_STATION_NAME))
    located = stations.na.drop(subset=["latitude", "longitude"])
    return located.where(is_rain).drop(*LEVEL_FIELDS), located.where(~is_rain)


def not_numeric(readings: DataFrame, value: str = "value") -> DataFrame:
    """Rows with a value that is not a single number."""
    return readings.where(F.col(value).isNotNull() & number_or_null(F.col(value)).isNull())


def level_contradictions(stations: DataFrame) -> DataFrame:
    """Counts of level stations whose four level figures contradict, in one pass."""
    checks = {
        "min_above_max": F.col("minOnRecord") > F.col("maxOnRecord"),
        "low_above_high": F.col("typicalRangeLow") > F.col("typicalRangeHigh"),
        "max_below_high": F.col("maxOnRecord") < F.col("typicalRangeHigh"),
        "min_above_low": F.col("minOnRecord") > F.col("typicalRangeLow"),
    }
    return stations.agg(*[F.count_if(check).alias(name) for name, check in checks.items()])

"""Joins on postcode, sector, district, station and position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geodesy import add_wgs84
from tidemark.functions.readings import clean_value
from tidemark.operators.quantiles import medians, modes
from tidemark.operators.ranking import keep_priority, unique_per
from tidemark.operators.selection import numeric_and_other


def requests_table(spark, values: Sequence, name: str = "postcode", kind: str = "string") -> DataFrame:
    """A request list as a table that keeps order and duplicates in ``ord``."""
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"ord bigint, {name} {kind}")


def lookup_grid(requests: DataFrame, units: DataFrame) -> DataFrame:
    """Easting and northing per request, in request order; unknown gives NULL, of repeated units the smallest counts."""
    places = unique_per(units, "postcode", ["easting", "northing"])
    return requests.join(places, "postcode", "left").orderBy("ord")


def lookup_wgs84(requests: DataFrame, units: DataFrame) -> DataFrame:
    """Longitude and latitude per request, in request order."""
    found = requests.join(unique_per(units, "postcode", ["easting", "northing"]), "postcode", "left")
    return add_wgs84(found).drop("easting", "northing").orderBy("ord")


def reading_coordinates(
    readings: DataFrame, rainfall: DataFrame, level: DataFrame, store_clean_value: bool = False
) -> DataFrame:
    """Readings with the coordinates of their station.

    Rainfall readings look among rainfall stations and level readings among
    level stations; readings of an unknown station or another parameter are
    dropped. With ``store_clean_value`` the value becomes a number and rows
    without one are dropped too.
    """
    place = ["stationReference", "latitude", "longitude", "easting", "northing"]
    tagged = [
        table.select(*place, F.lit(kind).alias("parameter"))
        for table, kind in ((rainfall, "rainfall"), (level, "level"))
    ]
    stations = tagged[0].unionByName(tagged[1])
    keys = ["stationReference", "parameter"]
    stations = keep_priority(stations, keys, [F.col(c) for c in place[1:]])
    result = readings.join(stations, keys).na.drop(subset=["latitude", "longitude"])
    if store_clean_value:
        result = result.withColumn("value", clean_value(F.col("value"))).na.drop(subset=["value"])
    return result


def typical_by_group(df: DataFrame, key: str) -> DataFrame:
    """One row per group: medians of the numbers, modes of everything else."""
    numeric, other = numeric_and_other(df.drop(key))
    result = None
    if numeric:
        result = medians(df, numeric, [key])
    if other:
        picks = modes(df, other, [key])
        result = picks if result is None else result.join(picks, key, "full")
    return result


def smoothed(df: DataFrame, key: str) -> DataFrame:
    """Every row carries its group's typical values; the row count stays, rows without a key have none."""
    return df.select(key).join(typical_by_group(df, key), key, "left")


def merge_by_group(units: DataFrame, groups: DataFrame, key: str, suffix: str) -> DataFrame:
    """Inner join of units with smoothed group data; clashing names get a suffix."""
    groups = smoothed(groups, key)
    clash = {name: name + suffix for name in groups.columns if name != key and name in units.columns}
    return units.join(groups.withColumnsRenamed(clash), key)


def unit_sector_merge(units: DataFrame, sectors: DataFrame) -> DataFrame:
    return merge_by_group(units, sectors, "postcodeSector", "_sector")


def unit_district_merge(units: DataFrame, districts: DataFrame) -> DataFrame:
    return merge_by_group(units, districts, "postcodeDistrict", "_district")


def fall_back(df: DataFrame, columns: Sequence[str], levels: Sequence[tuple[str, DataFrame]], last: dict) -> DataFrame:
    """Fill columns from keyed tables in turn, then from constants.

    ``levels`` are (key, table) pairs, the most specific first; the tables hold
    one row per key and the same column names.
    """
    for i, (key, table) in enumerate(levels):
        fills = table.select(key, *[F.col(c).alias(f"_f{i}_{c}") for c in columns])
        df = df.join(fills, key, "left")
    filled = {
        c: F.coalesce(
            F.col(c), *[F.col(f"_f{i}_{c}") for i in range(len(levels))], F.lit(last.get(c))
        )
        for c in columns
    }
    return df.withColumns(filled).drop(*[f"_f{i}_{c}" for i in range(len(levels)) for c in columns])


def boundaries_present(boundaries: DataFrame, units: DataFrame, name: str, authority: str = "localAuthority") -> DataFrame:
    """Boundary rows whose trimmed name occurs among the units."""
    present = units.select(F.trim(authority).alias(name))
    return boundaries.withColumn(name, F.trim(name)).join(present, name, "left_semi")


def with_truth(predictions: DataFrame, truth: DataFrame, key: str = "postcode") -> DataFrame:
    """Predictions next to the true values, by key."""
    return predictions.join(truth, key)

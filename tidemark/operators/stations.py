"""Station table repair and the latest reading per station."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import LEVEL_FIELDS
from tidemark.functions.geodesy import add_osgb36
from tidemark.functions.numeric import quartile_band, scale_position
from tidemark.functions.readings import event_time, number_or_null, parameter_is
from tidemark.operators.quantiles import exact_quantiles, medians, scalars
from tidemark.operators.ranking import latest_per_key
from tidemark.operators.scaling import apply_fill
from tidemark.operators.selection import split_stations


def repair_levels(stations: DataFrame) -> DataFrame:
    """Make the four level figures consistent, all from their original values."""
    high, low = F.col("typicalRangeHigh"), F.col("typicalRangeLow")
    top, bottom = F.col("maxOnRecord"), F.col("minOnRecord")

    def swap_if(test: Column, new: Column, old: Column) -> Column:
        return F.when(test, new).otherwise(old)

    return stations.withColumns(
        {
            "maxOnRecord": swap_if(top < high, high, top),
            "minOnRecord": swap_if(bottom > low, low, bottom),
            "typicalRangeHigh": swap_if(high < low, low, high),
        }
    )


def fill_levels(level: DataFrame) -> DataFrame:
    """Fill level figures with medians of the complete, repaired stations."""
    typical = scalars(medians(repair_levels(level.na.drop("any")), LEVEL_FIELDS))
    return apply_fill(level, {name: value for name, value in typical.items() if value is not None})


def prepare_stations(stations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rainfall stations and filled level stations, both with grid coordinates."""
    rainfall, level = split_stations(add_osgb36(stations))
    return rainfall, fill_levels(level)


def typed_readings(readings: DataFrame) -> DataFrame:
    return readings.withColumns(
        {"dateTime": event_time(F.col("dateTime")), "value": number_or_null(F.col("value"))}
    )


def latest_readings(readings: DataFrame, parameter: str) -> DataFrame:
    """Latest reading per station for one parameter.

    A station whose latest reading lacks a value or a position is left out; an
    older reading does not take its place.
    """
    wanted = typed_readings(readings).where(parameter_is(F.col("parameter"), parameter))
    latest = latest_per_key(wanted, ["stationReference"], "dateTime", "value")
    return latest.na.drop(subset=["latitude", "longitude", "value"])


def value_bands(latest: DataFrame, value: str = "value") -> DataFrame:
    """Colour band by quartile of the whole table."""
    cut = scalars(exact_quantiles(latest, [value], [0.25, 0.5, 0.75]))[value]
    if cut is None:
        return latest.withColumn("band", F.lit(None).cast("string"))
    return latest.withColumn("band", quartile_band(F.col(value), *[F.lit(q) for q in cut]))


def latest_of_each(readings: DataFrame, parameters=("rainfall", "level")) -> DataFrame:
    """Latest reading per station for several parameters in one pass."""
    kind = F.coalesce(*[F.when(parameter_is(F.col("parameter"), p), p) for p in parameters])
    wanted = typed_readings(readings).withColumn("layer", kind).where("layer is not null")
    latest = latest_per_key(wanted, ["layer", "stationReference"], "dateTime", "value")
    return latest.na.drop(subset=["latitude", "longitude", "value"])


def colour_positions(latest: DataFrame, layer: str = "layer", value: str = "value") -> DataFrame:
    """Place of each value between the 5th and 95th percentile of its layer."""
    cut = exact_quantiles(latest, [value], [0.05, 0.95], [layer])
    ends = cut.select(layer, F.col(value)[0].alias("_low"), F.col(value)[1].alias("_high"))
    position = scale_position(F.col(value), F.col("_low"), F.col("_high"))
    return latest.join(ends, layer).withColumn("position", position).drop("_low", "_high")

"""Numeric column functions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.constants import (
    CLASS_PROBABILITY,
    LONDON_EASTING,
    LONDON_NORTHING,
    NEAR_WATERCOURSE,
    NEAR_WATERCOURSE_METRES,
    NO_WATERCOURSE,
    RAIN_CLASSES,
    RAIN_TOP_CLASS,
)


def clamp(value: Column, low: Column, high: Column) -> Column:
    """Clip that keeps NULL as NULL (``least``/``greatest`` alone would not)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def nearest_class(value: Column) -> Column:
    """Round half to even and give an integer class."""
    return F.rint(value).cast("int")


def flood_probability(risk_class: Column) -> Column:
    """Annual flood probability of a class; unknown classes count as zero."""
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in CLASS_PROBABILITY.items()))
    return F.coalesce(F.try_element_at(table, risk_class.cast("int")), F.lit(0.0))


def planar_distance(e1: Column, n1: Column, e2: Column, n2: Column) -> Column:
    return F.hypot((e1 - e2).cast("double"), (n1 - n2).cast("double"))


def distance_to_london(easting: Column, northing: Column) -> Column:
    return planar_distance(easting, northing, F.lit(LONDON_EASTING), F.lit(LONDON_NORTHING))


def interpolate_size(
    value: Column, low: Column, high: Column, smallest: float = 5.0, largest: float = 25.0, invert: bool = False
) -> Column:
    """Linear size between two anchors, held constant outside them."""
    if invert:
        smallest, largest = largest, smallest
    share = scale_position(value, low, high)
    return F.lit(smallest) + F.lit(largest - smallest) * share


def scale_position(value: Column, low: Column, high: Column) -> Column:
    """Place of a value between two anchors as a number in 0..1."""
    span = high - low
    return F.when(span > 0, clamp((value - low) / span, F.lit(0.0), F.lit(1.0))).when(
        value.isNotNull(), F.when(value >= high, F.lit(1.0)).otherwise(F.lit(0.0))
    )


def quartile_band(value: Column, q25: Column, q50: Column, q75: Column) -> Column:
    """Colour band of a value by quartile."""
    return (
        F.when(value >= q75, "red").when(value >= q50, "orange").when(value >= q25, "green").otherwise("blue")
    )


def watercourse_or_guess(name: Column, distance: Column) -> Column:
    """Name if there is one, otherwise a label that tells near from far."""
    return F.coalesce(
        name,
        F.when(distance < NEAR_WATERCOURSE_METRES, NEAR_WATERCOURSE).otherwise(NO_WATERCOURSE),
    )


def rain_class(millimetres_per_hour: Column) -> Column:
    """Met-style name of an hourly rainfall total."""
    column = F.lit(RAIN_TOP_CLASS)
    for bound, name in reversed(RAIN_CLASSES):
        column = F.when(millimetres_per_hour < bound, name).otherwise(column)
    return F.when(millimetres_per_hour.isNotNull(), column)


def dms_to_degrees(deg: Column, minutes: Column, seconds: Column) -> Column:
    return deg + minutes / F.lit(60.0) + seconds / F.lit(3600.0)


def dms_to_radians(deg: Column, minutes: Column, seconds: Column) -> Column:
    return F.radians(dms_to_degrees(deg, minutes, seconds))


def radians_to_dms(angle: Column) -> Column:
    """Struct of whole degrees, whole minutes and seconds to four places."""
    degrees = F.degrees(angle)
    minutes = (degrees - F.floor(degrees)) * 60.0
    seconds = (minutes - F.floor(minutes)) * 60.0
    return F.struct(
        F.floor(degrees).alias("degrees"),
        F.floor(minutes).alias("minutes"),
        F.round(seconds, 4).alias("seconds"),
    )

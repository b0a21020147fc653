"""Map layers as tables: one row per marker, with its colour and size."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import OTHER_RISK_COLOUR, PALETTE_SIZE, RISK_COLOURS
from tidemark.functions.numeric import interpolate_size, scale_position
from tidemark.functions.postcode import postcode_area
from tidemark.operators.lookups import boundaries_present
from tidemark.operators.quantiles import exact_quantiles, scalars
from tidemark.operators.ranking import category_codes
from tidemark.operators.selection import flooded_only
from tidemark.operators.stations import colour_positions, latest_of_each, latest_readings, value_bands
from tidemark.session import materialize

MANY_VALUES = 10


def flood_by_area(units: DataFrame, areas: Sequence[str] | None = None) -> DataFrame:
    """Units with their postcode area, its colour index and its number of units."""
    df = units.withColumn("postcodeArea", postcode_area(F.col("postcodeDistrict")))
    if areas is not None:
        df = df.where(F.col("postcodeArea").isin(list(areas)))
    per_area = df.where(F.col("postcodeArea").isNotNull()).groupBy("postcodeArea").agg(F.count("*").alias("n_area"))
    codes = category_codes(per_area, "postcodeArea", "palette")
    return df.join(per_area.join(codes, "postcodeArea"), "postcodeArea").select(
        "postcode",
        "postcodeArea",
        "postcodeDistrict",
        "postcodeSector",
        "historicallyFlooded",
        "latitude",
        "longitude",
        "palette",
        "n_area",
    )


def authority_points(units: DataFrame, authority: str = "localAuthority") -> DataFrame:
    """Units coloured by authority."""
    codes = category_codes(units, authority, "palette", PALETTE_SIZE)
    return units.join(codes, authority).select(authority, "postcode", "latitude", "longitude", "palette")


def risk_colour(risk):
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in RISK_COLOURS.items()))
    return F.coalesce(F.try_element_at(table, risk.cast("int")), F.lit(OTHER_RISK_COLOUR))


def flooded_points(units: DataFrame, risk: str = "riskLabel") -> DataFrame:
    """Historically flooded units coloured by risk."""
    return flooded_only(units).select(
        "postcode", "latitude", "longitude", F.col(risk).alias("risk"), risk_colour(F.col(risk)).alias("colour")
    )


def flooded_authorities(units: DataFrame, boundaries: DataFrame, name: str) -> DataFrame:
    """Boundaries with flooded units, and their colour index in sorted order."""
    present = boundaries_present(boundaries, flooded_only(units), name)
    return present.join(category_codes(present, name, "palette", PALETTE_SIZE), name)


def weather(readings: DataFrame, parameter: str) -> DataFrame:
    """Latest value per station with its quartile colour.

    The latest rows, one per station, are written once: the quartiles and the
    colours both need them, and the readings are read only once.
    """
    latest = materialize(latest_readings(readings, parameter), "latest")
    return value_bands(latest).select("stationReference", "dateTime", "latitude", "longitude", "value", "band")


def rainfall_and_level(readings: DataFrame) -> DataFrame:
    """Latest rainfall and level per station, each placed on its own scale."""
    return colour_positions(materialize(latest_of_each(readings), "latest")).select(
        "layer", "stationReference", "dateTime", "latitude", "longitude", "value", "position"
    )


def with_colour_position(df: DataFrame, feature: str) -> DataFrame:
    """Place of a feature on its colour scale, 0..1; rows without it are dropped.

    Text, or at most ten distinct values, gives even steps in sorted order;
    anything else is placed between the 1st and 99th percentile.
    """
    known = df.where(F.col(feature).isNotNull())
    few = known.select(feature).distinct().limit(MANY_VALUES + 1).count() <= MANY_VALUES
    if few or isinstance(df.schema[feature].dataType, T.StringType):
        codes = category_codes(known, feature, "_code")
        last = codes.agg(F.max("_code").alias("last")).first()["last"] or 0
        place = F.col("_code") / F.lit(float(last)) if last else F.lit(0.5)
        return known.join(codes, feature).withColumn("position", place).drop("_code")
    low, high = scalars(exact_quantiles(known, [feature], [0.01, 0.99]))[feature]
    return known.withColumn("position", scale_position(F.col(feature).cast("double"), F.lit(low), F.lit(high)))


def with_marker_size(df: DataFrame, feature: str, invert: bool = False) -> DataFrame:
    """Marker size 5..25 between the 1st and 99th percentile of a feature."""
    cut = scalars(exact_quantiles(df, [feature], [0.01, 0.99]))[feature]
    if cut is None:
        return df.withColumn("size", F.lit(None).cast("double"))
    size = interpolate_size(F.col(feature).cast("double"), F.lit(cut[0]), F.lit(cut[1]), invert=invert)
    return df.withColumn("size", size)


def colour_and_size(df: DataFrame, colour: str, size: str | None = None, invert: bool = False) -> DataFrame:
    """Point layer for any two features."""
    df = df.na.drop(subset=["latitude", "longitude"])
    df = with_marker_size(df, size, invert) if size else df.withColumn("size", F.lit(6.0))
    df = with_colour_position(df, colour)
    names = [colour, *([size] if size and size != colour else [])]
    return df.select("postcode", "latitude", "longitude", *names, "position", "size")


def flood_and_weather(units: DataFrame, readings: DataFrame, parameter: str = "rainfall") -> DataFrame:
    """Flooded units and latest readings in one table with a layer name."""
    flood = flooded_points(units).select(
        F.lit("flood").alias("layer"),
        F.col("postcode").alias("key"),
        "latitude",
        "longitude",
        F.col("risk").cast("double").alias("value"),
        "colour",
    )
    rain = weather(readings, parameter).select(
        F.lit("weather").alias("layer"),
        F.col("stationReference").alias("key"),
        "latitude",
        "longitude",
        "value",
        F.col("band").alias("colour"),
    )
    return flood.unionByName(rain)

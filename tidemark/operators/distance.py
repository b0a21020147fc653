"""Distances between two sets of points.

A full distance matrix of two large tables has no place on a cluster. Two
bounded forms are given instead: against a short list of places known to the
caller, and between all pairs of two tables within a given radius.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import EARTH_RADIUS
from tidemark.functions.numeric import planar_distance
from tidemark.session import materialize

#: A cell with more rows than this is split among tasks, so many rows to each.
ROWS_PER_SALT = 100_000


def great_circle(lat1: Column, lon1: Column, lat2: Column, lon2: Column, degrees: bool = True) -> Column:
    """Haversine distance in metres on a sphere of mean radius."""
    if degrees:
        lat1, lon1, lat2, lon2 = (F.radians(c) for c in (lat1, lon1, lat2, lon2))
    s, t = F.sin((lat2 - lat1) / 2), F.sin((lon2 - lon1) / 2)
    a = s * s + F.cos(lat1) * F.cos(lat2) * t * t
    return F.lit(2 * EARTH_RADIUS) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def _with_places(df: DataFrame, places: Sequence[tuple], names: tuple[str, str, str]) -> DataFrame:
    if not places:
        raise ValueError("give a place")
    rows = [
        F.struct(F.lit(p[0]).alias(names[0]), F.lit(float(p[1])).alias(names[1]), F.lit(float(p[2])).alias(names[2]))
        for p in places
    ]
    return df.select("*", F.inline(F.array(*rows)))


def to_places(df: DataFrame, places: Sequence[tuple], easting: str = "easting", northing: str = "northing") -> DataFrame:
    """Plane distance of every row to every (name, easting, northing) place."""
    df = _with_places(df, places, ("place", "_pe", "_pn"))
    dist = planar_distance(F.col(easting), F.col(northing), F.col("_pe"), F.col("_pn"))
    return df.withColumn("dist", dist).drop("_pe", "_pn")


def to_places_wgs84(df: DataFrame, places: Sequence[tuple], latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    """Great-circle distance of every row to every (name, latitude, longitude) place."""
    df = _with_places(df, places, ("place", "_pa", "_po"))
    dist = great_circle(F.col(latitude), F.col(longitude), F.col("_pa"), F.col("_po"))
    return df.withColumn("dist", dist).drop("_pa", "_po")


def _cell_join(left: DataFrame, right: DataFrame, axes: Sequence[str], size: float, salt_key: str) -> DataFrame:
    """Pairs in the same or a neighbouring cell; a crowded cell has salts of its own.

    ``left`` rows keep one cell and one salt, ``right`` rows go to all
    neighbours and to all salts of each.
    """
    cells = [f"_c{axis}" for axis in axes]
    left = left.withColumns({c: F.floor(F.col(f"_l{a}") / size) for c, a in zip(cells, axes)})
    crowded = left.groupBy(*cells).count().where(F.col("count") > ROWS_PER_SALT)
    crowded = crowded.select(*cells, F.ceil(F.col("count") / ROWS_PER_SALT).cast("int").alias("_salts"))
    some = not crowded.isEmpty()
    one = F.lit(0)
    if some:
        crowded = materialize(crowded, "crowded")
        left = left.join(crowded, cells, "left")
        one = F.pmod(F.xxhash64(salt_key), F.coalesce("_salts", F.lit(1))).cast("int")
    left = left.withColumn("_salt", one).drop("_salts")
    steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
    for c, a in zip(cells, axes):
        right = right.withColumn("_step", F.explode(steps)).withColumn(
            c, F.floor(F.col(f"_r{a}") / size) + F.col("_step")
        )
    right = right.drop("_step")
    if some:
        right = right.join(crowded, cells, "left")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)) if some else F.lit(0)
    right = right.withColumn("_salt", every).drop("_salts")
    return left.join(right, [*cells, "_salt"]).drop(*cells, "_salt")


def pairs_within(left: DataFrame, right: DataFrame, radius: float, left_id: str, right_id: str) -> DataFrame:
    """Pairs (left_id, right_id, dist) at most ``radius`` metres apart in the plane."""
    xy = ["easting", "northing"]
    left = left.select(left_id, *[F.col(c).cast("double").alias(f"_l{c}") for c in xy]).na.drop("any")
    right = right.select(right_id, *[F.col(c).cast("double").alias(f"_r{c}") for c in xy]).na.drop("any")
    pairs = _cell_join(left, right, xy, radius, left_id)
    dist = planar_distance(F.col("_leasting"), F.col("_lnorthing"), F.col("_reasting"), F.col("_rnorthing"))
    return pairs.select(left_id, right_id, dist.alias("dist")).where(F.col("dist") <= radius)


def pairs_within_wgs84(left: DataFrame, right: DataFrame, radius: float, left_id: str, right_id: str) -> DataFrame:
    """Pairs (left_id, right_id, dist) at most ``radius`` metres apart on the globe.

    The cells are cubes around the points' places in space, as wide as the
    straight line under an arc of ``radius``, so poles and the date line need
    no special care.
    """
    chord = 2 * EARTH_RADIUS * math.sin(min(radius / (2 * EARTH_RADIUS), math.pi / 2)) + 1.0

    def placed(df: DataFrame, key: str, side: str) -> DataFrame:
        df = df.select(key, "latitude", "longitude").na.drop("any")
        lat, lon = F.radians("latitude"), F.radians("longitude")
        return df.select(
            key,
            F.col("latitude").alias(f"_{side}lat"),
            F.col("longitude").alias(f"_{side}lon"),
            (EARTH_RADIUS * F.cos(lat) * F.cos(lon)).alias(f"_{side}x"),
            (EARTH_RADIUS * F.cos(lat) * F.sin(lon)).alias(f"_{side}y"),
            (EARTH_RADIUS * F.sin(lat)).alias(f"_{side}z"),
        )

    pairs = _cell_join(placed(left, left_id, "l"), placed(right, right_id, "r"), ["x", "y", "z"], chord, left_id)
    dist = great_circle(F.col("_llat"), F.col("_llon"), F.col("_rlat"), F.col("_rlon"))
    return pairs.select(left_id, right_id, dist.alias("dist")).where(F.col("dist") <= radius)

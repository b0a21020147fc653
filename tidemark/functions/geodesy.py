"""British National Grid <-> WGS84 over point tables.

The jobs work in stages of ``withColumns``. Catalyst keeps such stages apart
when a column is used more than once, so the plan stays linear in the number
of stages and all of it runs inside generated code, without Python. The results
leave through a generator: a later filter on them stops there, where pushing it
down would paste every stage into the next and blow up the plan.

Formulas: Ordnance Survey, "A guide to coordinate systems in Great Britain".
The fixed-point loops of that guide converge by a factor of about 150 per
turn, so a fixed number of turns per row replaces the data-dependent loop and
rows cannot influence each other.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as c


@dataclass(frozen=True)
class Figure:
    """Ellipsoid as used here: scaled semi-major axis, eccentricity, height."""

    a: float
    b: float
    scale: float
    height: float = 0.0

    @property
    def axis(self) -> float:
        return self.a * self.scale

    @property
    def e2(self) -> float:
        return 1.0 - (self.b / self.a) ** 2

    @property
    def n(self) -> float:
        return (self.a - self.b) / (self.a + self.b)


AIRY = Figure(c.AIRY_A, c.AIRY_B, c.AIRY_SCALE, c.AIRY_HEIGHT)
GRS = Figure(c.GRS_A, c.GRS_B, c.GRS_SCALE)
LAT0 = math.radians(c.ORIGIN_LAT)
LON0 = math.radians(c.ORIGIN_LON)
ARC_TURNS = 5
LATITUDE_TURNS = 4

_RX, _RY, _RZ = (math.radians(s / 3600.0) for s in c.SHIFT_ARCSEC)
SHIFT = np.array(
    [
        [1 + c.SHIFT_SCALE, -_RZ, _RY],
        [_RZ, 1 + c.SHIFT_SCALE, -_RX],
        [-_RY, _RX, 1 + c.SHIFT_SCALE],
    ]
)
UNSHIFT = np.linalg.inv(SHIFT)


def arc_factors() -> tuple[float, float, float, float, float]:
    """Meridian arc from the true origin as ``k + a*lat - b*sin 2lat + ...``.

    The series of the guide, with each product of a sine of the difference
    and a cosine of the sum written as a difference of two sines, so that a
    turn needs two trigonometric calls instead of six.
    """
    n, n2, n3 = AIRY.n, AIRY.n**2, AIRY.n**3
    reach = AIRY.b * AIRY.scale
    a = reach * (1 + n + 1.25 * n2 + 1.25 * n3)
    b = reach * (1.5 * n + 1.5 * n2 + 1.3125 * n3)
    c4 = reach * 0.9375 * (n2 + n3)
    d = reach * 35.0 / 48.0 * n3
    k = -(a * LAT0 - b * math.sin(2 * LAT0) + c4 * math.sin(4 * LAT0) - d * math.sin(6 * LAT0))
    return k, a, b, c4, d


def _meridian_arc(lat: Column) -> Column:
    k, a, b, c4, d = arc_factors()
    s, co = F.sin(2 * lat), F.cos(2 * lat)
    return k + a * lat - s * (b - c4 * 2 * co + d * (3 - 4 * s * s))


def _flattening(lat: Column, figure: Figure) -> Column:
    return 1 - figure.e2 * F.sin(lat) * F.sin(lat)


def _prime_vertical(lat: Column, figure: Figure) -> Column:
    return F.lit(figure.axis) / F.sqrt(_flattening(lat, figure))


def _curvature_ratio(lat: Column, figure: Figure) -> Column:
    """Radius of curvature east-west over that north-south."""
    return _flattening(lat, figure) / (1 - figure.e2)


def _horner(x2: Column, *factors) -> Column:
    """Polynomial in an already squared variable, lowest order first."""
    total = F.lit(0.0)
    for factor in reversed(factors):
        total = factor + x2 * total
    return total


def _sealed(df: DataFrame, results: dict[str, Column], scratch: list[str]) -> DataFrame:
    """Attach results behind a generator and drop the scratch columns."""
    names = {f"_gd_out{i}": name for i, name in enumerate(results)}
    keep = [F.col(f"`{n}`") for n in df.columns if n not in results and n not in scratch]
    fields = [col.alias(tag) for tag, col in zip(names, results.values())]
    return df.select(*keep, F.inline(F.array(F.struct(*fields)))).withColumnsRenamed(names)


def to_cartesian(df: DataFrame, lat: str, lon: str, out: tuple[str, str, str], figure: Figure) -> DataFrame:
    """Add x, y, z of a geodetic position given in radians."""
    tmp = ("_gd_x", "_gd_y", "_gd_z")
    df = _cartesian(df, lat, lon, tmp, figure)
    return _sealed(df, {o: F.col(t) for o, t in zip(out, tmp)}, list(tmp))


def to_geodetic(df: DataFrame, xyz: tuple[str, str, str], lat: str, lon: str, figure: Figure) -> DataFrame:
    """Add latitude and longitude in radians of a Cartesian position."""
    df = _geodetic(df, xyz, "_gd_la", "_gd_lo", figure)
    return _sealed(df, {lat: F.col("_gd_la"), lon: F.col("_gd_lo")}, ["_gd_la", "_gd_lo"])


def shift_datum(df: DataFrame, lat: str, lon: str, to_wgs84: bool) -> DataFrame:
    """Replace latitude/longitude (radians) by those on the other datum."""
    df = _shift(df.withColumns({"_gd_la": F.col(lat), "_gd_lo": F.col(lon)}), to_wgs84)
    return _sealed(df, {lat: F.col("_gd_la"), lon: F.col("_gd_lo")}, ["_gd_la", "_gd_lo"])


def _cartesian(df: DataFrame, lat: str, lon: str, out: tuple[str, str, str], figure: Figure) -> DataFrame:
    nu = "_gd_nu"
    df = df.withColumn(nu, _prime_vertical(F.col(lat), figure))
    upright = F.col(nu) + figure.height
    return df.withColumns(
        {
            out[0]: upright * F.cos(lat) * F.cos(lon),
            out[1]: upright * F.cos(lat) * F.sin(lon),
            out[2]: (F.col(nu) * (1 - figure.e2) + figure.height) * F.sin(lat),
        }
    ).drop(nu)


def _geodetic(df: DataFrame, xyz: tuple[str, str, str], lat: str, lon: str, figure: Figure) -> DataFrame:
    x, y, z = (F.col(name) for name in xyz)
    df = df.withColumn("_gd_p", F.hypot(x, y)).withColumn(
        "_gd_t", F.atan2(z, F.col("_gd_p") * (1 - figure.e2))
    )
    for _ in range(LATITUDE_TURNS):
        lift = figure.e2 * _prime_vertical(F.col("_gd_t"), figure) * F.sin("_gd_t")
        df = df.withColumn("_gd_t", F.atan2(z + lift, F.col("_gd_p")))
    return df.withColumns({lat: F.col("_gd_t"), lon: F.atan2(y, x)}).drop("_gd_p", "_gd_t")


def _rotate(df: DataFrame, xyz: tuple[str, str, str], out: tuple[str, str, str], inverse: bool) -> DataFrame:
    cols = [F.col(name) for name in xyz]
    if inverse:
        cols = [col - move for col, move in zip(cols, c.SHIFT_METRES)]
        moves, matrix = (0.0, 0.0, 0.0), UNSHIFT
    else:
        moves, matrix = c.SHIFT_METRES, SHIFT
    rows = {}
    for name, move, factors in zip(out, moves, matrix.tolist()):
        rows[name] = F.lit(move) + factors[0] * cols[0] + factors[1] * cols[1] + factors[2] * cols[2]
    return df.withColumns(rows)


def _shift(df: DataFrame, to_wgs84: bool) -> DataFrame:
    """Move the scratch position ``_gd_la``, ``_gd_lo`` to the other datum."""
    source, target = (AIRY, GRS) if to_wgs84 else (GRS, AIRY)
    a, b = ("_gd_x", "_gd_y", "_gd_z"), ("_gd_x2", "_gd_y2", "_gd_z2")
    df = _cartesian(df, "_gd_la", "_gd_lo", a, source)
    df = _rotate(df, a, b, inverse=to_wgs84)
    return _geodetic(df, b, "_gd_la", "_gd_lo", target).drop(*a, *b)


def add_wgs84(
    df: DataFrame,
    easting: str = "easting",
    northing: str = "northing",
    latitude: str = "latitude",
    longitude: str = "longitude",
    radians: bool = False,
) -> DataFrame:
    """Add WGS84 latitude and longitude of National Grid coordinates."""
    north = F.col(northing).cast("double") - c.ORIGIN_NORTHING
    df = df.withColumn("_gd_lat", LAT0 + north / AIRY.axis)
    for _ in range(ARC_TURNS):
        df = df.withColumn(
            "_gd_lat", F.col("_gd_lat") + (north - _meridian_arc(F.col("_gd_lat"))) / AIRY.axis
        )
    df = df.withColumns(
        {
            "_gd_n": _prime_vertical(F.col("_gd_lat"), AIRY),
            "_gd_q": _curvature_ratio(F.col("_gd_lat"), AIRY),
            "_gd_t": F.tan("_gd_lat"),
        }
    )
    # Offset east of the true origin in units of the radius of curvature.
    df = df.withColumns(
        {
            "_gd_u": (F.col(easting).cast("double") - c.ORIGIN_EASTING) / F.col("_gd_n"),
            "_gd_t2": F.col("_gd_t") * F.col("_gd_t"),
        }
    ).withColumn("_gd_u2", F.col("_gd_u") * F.col("_gd_u"))
    t2, q, u, u2 = (F.col(name) for name in ("_gd_t2", "_gd_q", "_gd_u", "_gd_u2"))
    eta2 = q - 1
    lat_series = _horner(
        u2,
        F.lit(0.5),
        -(5 + 3 * t2 + eta2 - 9 * t2 * eta2) / 24.0,
        _horner(t2, F.lit(61.0), F.lit(90.0), F.lit(45.0)) / 720.0,
    )
    lon_series = _horner(
        u2,
        F.lit(1.0),
        -(q + 2 * t2) / 6.0,
        _horner(t2, F.lit(5.0), F.lit(28.0), F.lit(24.0)) / 120.0,
        -_horner(t2, F.lit(61.0), F.lit(662.0), F.lit(1320.0), F.lit(720.0)) / 5040.0,
    )
    df = df.withColumns(
        {
            "_gd_la": F.col("_gd_lat") - F.col("_gd_t") * q * u2 * lat_series,
            "_gd_lo": LON0 + u * lon_series / F.cos("_gd_lat"),
        }
    )
    df = _shift(df, to_wgs84=True)
    unit = (lambda col: col) if radians else F.degrees
    results = {latitude: unit(F.col("_gd_la")), longitude: unit(F.col("_gd_lo"))}
    return _sealed(df, results, [n for n in df.columns if n.startswith("_gd_")])


def add_osgb36(
    df: DataFrame,
    latitude: str = "latitude",
    longitude: str = "longitude",
    easting: str = "easting",
    northing: str = "northing",
    radians: bool = False,
    whole: bool = False,
) -> DataFrame:
    """Add National Grid easting and northing of WGS84 coordinates."""
    unit = (lambda col: col) if radians else F.radians
    df = df.withColumns(
        {
            "_gd_la": unit(F.col(latitude).cast("double")),
            "_gd_lo": unit(F.col(longitude).cast("double")),
        }
    )
    df = _shift(df, to_wgs84=False)
    df = df.withColumns(
        {
            "_gd_n": _prime_vertical(F.col("_gd_la"), AIRY),
            "_gd_q": _curvature_ratio(F.col("_gd_la"), AIRY),
            "_gd_t": F.tan("_gd_la"),
            "_gd_u": (F.col("_gd_lo") - LON0) * F.cos("_gd_la"),
        }
    ).withColumns({"_gd_t2": F.col("_gd_t") * F.col("_gd_t"), "_gd_u2": F.col("_gd_u") * F.col("_gd_u")})
    n, q, t2, u, u2 = (F.col(name) for name in ("_gd_n", "_gd_q", "_gd_t2", "_gd_u", "_gd_u2"))
    eta2 = q - 1
    # Powers of the scaled longitude offset: cos(lat) is folded into u.
    east = n * u * _horner(
        u2,
        F.lit(1.0),
        (q - t2) / 6.0,
        (_horner(t2, F.lit(5.0), F.lit(-18.0), F.lit(1.0)) + eta2 * (14.0 - 58.0 * t2)) / 120.0,
    )
    north = n * F.col("_gd_t") * u2 * _horner(
        u2,
        F.lit(0.5),
        (5 - t2 + 9 * eta2) / 24.0,
        _horner(t2, F.lit(61.0), F.lit(-58.0), F.lit(1.0)) / 720.0,
    )
    result = {
        easting: c.ORIGIN_EASTING + east,
        northing: c.ORIGIN_NORTHING + _meridian_arc(F.col("_gd_la")) + north,
    }
    if whole:
        result = {name: col.cast("bigint") for name, col in result.items()}
    return _sealed(df, result, [n for n in df.columns if n.startswith("_gd_")])


@F.pandas_udf(
    T.StructType([T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())])
)
def wgs84_of(easting: pd.Series, northing: pd.Series) -> pd.DataFrame:
    """Arrow form of :func:`add_wgs84` for callers who want one expression."""
    k, a, b, c4, d = arc_factors()
    north = northing.to_numpy("float64", na_value=np.nan) - c.ORIGIN_NORTHING
    lat = LAT0 + north / AIRY.axis
    for _ in range(ARC_TURNS):
        s, co = np.sin(2 * lat), np.cos(2 * lat)
        lat = lat + (north - (k + a * lat - s * (b - 2 * c4 * co + d * (3 - 4 * s * s)))) / AIRY.axis
    curve = 1 - AIRY.e2 * np.sin(lat) ** 2
    nu = AIRY.axis / np.sqrt(curve)
    q = curve / (1 - AIRY.e2)
    u = (easting.to_numpy("float64", na_value=np.nan) - c.ORIGIN_EASTING) / nu
    t2, u2, eta2 = np.tan(lat) ** 2, u**2, q - 1
    la = lat - np.tan(lat) * q * u2 * (
        0.5 - u2 * (5 + 3 * t2 + eta2 - 9 * t2 * eta2) / 24 + u2**2 * (61 + 90 * t2 + 45 * t2**2) / 720
    )
    lo = LON0 + u / np.cos(lat) * (
        1
        - u2 * (q + 2 * t2) / 6
        + u2**2 * (5 + 28 * t2 + 24 * t2**2) / 120
        - u2**3 * (61 + 662 * t2 + 1320 * t2**2 + 720 * t2**3) / 5040
    )
    nu = AIRY.axis / np.sqrt(1 - AIRY.e2 * np.sin(la) ** 2)
    place = np.stack(
        [
            (nu + AIRY.height) * np.cos(la) * np.cos(lo),
            (nu + AIRY.height) * np.cos(la) * np.sin(lo),
            ((1 - AIRY.e2) * nu + AIRY.height) * np.sin(la),
        ]
    )
    x, y, z = UNSHIFT @ (place - np.array(c.SHIFT_METRES)[:, None])
    p = np.hypot(x, y)
    lat = np.arctan2(z, p * (1 - GRS.e2))
    for _ in range(LATITUDE_TURNS):
        lift = GRS.e2 * GRS.axis / np.sqrt(1 - GRS.e2 * np.sin(lat) ** 2) * np.sin(lat)
        lat = np.arctan2(z + lift, p)
    return pd.DataFrame({"latitude": np.degrees(lat), "longitude": np.degrees(np.arctan2(y, x))})

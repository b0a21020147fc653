"""Coordinate conversions. The SQL twins spell the same series as CTE chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import constants as c
from tidemark.functions import geodesy as g
from tidemark.functions.numeric import dms_to_degrees, dms_to_radians, radians_to_dms
from tidemark.plans.catalog import query
from tidemark.plans.catalog.common import rounded
from tidemark.sources.views import Views

WGS84_SQL = "geo_out"
OSGB36_SQL = "grid_out"


def _n(value: float) -> str:
    return f"({value!r}e0)" if "e" not in repr(value) else f"({value!r})"


def _nu(lat: str, figure: g.Figure) -> str:
    return f"({_n(figure.axis)} / sqrt(1 - {_n(figure.e2)} * sin({lat}) * sin({lat})))"


def _arc(lat: str) -> str:
    """The meridian arc in the product form of the guide."""
    n = g.AIRY.n
    gap, total = f"({lat} - {_n(g.LAT0)})", f"({lat} + {_n(g.LAT0)})"
    return (
        f"{_n(g.AIRY.b * g.AIRY.scale)} * ({_n(1 + n + 1.25 * n**2 + 1.25 * n**3)} * {gap}"
        f" - {_n(3 * n + 3 * n**2 + 21 / 8 * n**3)} * sin({gap}) * cos({total})"
        f" + {_n(15 / 8 * n**2 + 15 / 8 * n**3)} * sin(2 * {gap}) * cos(2 * {total})"
        f" - {_n(35 / 24 * n**3)} * sin(3 * {gap}) * cos(3 * {total}))"
    )


def _shift(source: str, out: str, to_wgs84: bool) -> str:
    """CTEs from ``source(la, lo)`` in radians to ``out(la, lo)`` on the other datum."""
    a, b = (g.AIRY, g.GRS) if to_wgs84 else (g.GRS, g.AIRY)
    nu = _nu("la", a)
    parts = [
        f"{out}_x as materialized (select * exclude (la, lo), ({nu} + {_n(a.height)}) * cos(la) * cos(lo) as x,"
        f" ({nu} + {_n(a.height)}) * cos(la) * sin(lo) as y,"
        f" ((1 - {_n(a.e2)}) * {nu} + {_n(a.height)}) * sin(la) as z from {source})"
    ]
    t = c.SHIFT_METRES
    m = (g.UNSHIFT if to_wgs84 else g.SHIFT).tolist()
    if to_wgs84:
        xyz = [f"(x - {_n(t[0])})", f"(y - {_n(t[1])})", f"(z - {_n(t[2])})"]
        plus = ["0", "0", "0"]
    else:
        xyz, plus = ["x", "y", "z"], [_n(v) for v in t]
    rows = [f"{plus[i]} + " + " + ".join(f"{_n(m[i][j])} * {xyz[j]}" for j in range(3)) for i in range(3)]
    parts.append(
        f"{out}_r as materialized (select * exclude (x, y, z), {rows[0]} as x, {rows[1]} as y, {rows[2]} as z from {out}_x)"
    )
    parts.append(
        f"{out}_0 as materialized (select *, sqrt(x * x + y * y) as p, atan2(z, sqrt(x * x + y * y) * (1 - {_n(b.e2)})) as la"
        f" from {out}_r)"
    )
    turns = 8
    for i in range(turns):
        parts.append(
            f"{out}_{i + 1} as materialized (select * exclude (la), atan2(z + {_n(b.e2)} * {_nu('la', b)} * sin(la), p) as la"
            f" from {out}_{i})"
        )
    parts.append(f"{out} as materialized (select * exclude (x, y, z, p, la), la, atan2(y, x) as lo from {out}_{turns})")
    return ",\n".join(parts)


def wgs84_sql(source: str) -> str:
    """CTEs that add latitude and longitude to ``source(easting, northing)``."""
    axis = g.AIRY.axis
    parts = [f"geo_0 as materialized (select *, {_n(g.LAT0)} + (northing + 100000) / {_n(axis)} as ph from {source})"]
    turns = 9
    for i in range(turns):
        parts.append(
            f"geo_{i + 1} as materialized (select * exclude (ph), ph + (northing + 100000 - {_arc('ph')}) / {_n(axis)} as ph"
            f" from geo_{i})"
        )
    nu = _nu("ph", g.AIRY)
    parts.append(
        f"geo_n as materialized (select *, {nu} as nu, {_n(axis * (1 - g.AIRY.e2))}"
        f" / pow(1 - {_n(g.AIRY.e2)} * sin(ph) * sin(ph), 1.5) as rho, tan(ph) as t, 1 / cos(ph) as sec,"
        f" easting - 400000.0e0 as de from geo_{turns})"
    )
    parts.append("geo_m as materialized (select *, nu / rho - 1 as eta2 from geo_n)")
    parts.append(
        "geo_s as materialized (select * exclude (ph, nu, rho, t, sec, de, eta2),"
        " ph - t / (2 * rho * nu) * pow(de, 2)"
        " + t / (24 * rho * pow(nu, 3)) * (5 + 3 * t * t + eta2 - 9 * t * t * eta2) * pow(de, 4)"
        " - t / (720 * rho * pow(nu, 5)) * (61 + 90 * t * t + 45 * pow(t, 4)) * pow(de, 6) as la,"
        f" {_n(g.LON0)} + sec / nu * de - sec / (6 * pow(nu, 3)) * (nu / rho + 2 * t * t) * pow(de, 3)"
        " + sec / (120 * pow(nu, 5)) * (5 + 28 * t * t + 24 * pow(t, 4)) * pow(de, 5)"
        " - sec / (5040 * pow(nu, 7)) * (61 + 662 * t * t + 1320 * pow(t, 4) + 720 * pow(t, 6)) * pow(de, 7) as lo"
        " from geo_m)"
    )
    parts.append(_shift("geo_s", "geo_w", True))
    parts.append(
        f"{WGS84_SQL} as materialized (select * exclude (la, lo), degrees(la) as latitude, degrees(lo) as longitude from geo_w)"
    )
    return ",\n".join(parts)


def osgb36_sql(source: str) -> str:
    """CTEs that add easting and northing to ``source(latitude, longitude)``."""
    parts = [f"grid_a as materialized (select *, radians(latitude) as la, radians(longitude) as lo from {source})"]
    parts.append(_shift("grid_a", "grid_w", False))
    parts.append(
        f"grid_n as materialized (select *, {_nu('la', g.AIRY)} as nu, {_n(g.AIRY.axis * (1 - g.AIRY.e2))}"
        f" / pow(1 - {_n(g.AIRY.e2)} * sin(la) * sin(la), 1.5) as rho, tan(la) as t, lo - {_n(g.LON0)} as dl"
        " from grid_w)"
    )
    parts.append("grid_m as materialized (select *, nu / rho - 1 as eta2 from grid_n)")
    parts.append(
        f"{OSGB36_SQL} as materialized (select * exclude (la, lo, nu, rho, t, dl, eta2),"
        " 400000 + nu * cos(la) * dl + nu / 6 * pow(cos(la), 3) * (nu / rho - t * t) * pow(dl, 3)"
        " + nu / 120 * pow(cos(la), 5) * (5 - 18 * t * t + pow(t, 4) + 14 * eta2 - 58 * t * t * eta2) * pow(dl, 5)"
        " as easting,"
        f" {_arc('la')} - 100000 + nu / 2 * sin(la) * cos(la) * pow(dl, 2)"
        " + nu / 24 * sin(la) * pow(cos(la), 3) * (5 - t * t + 9 * eta2) * pow(dl, 4)"
        " + nu / 720 * sin(la) * pow(cos(la), 5) * (61 - 58 * t * t + pow(t, 4)) * pow(dl, 6) as northing"
        " from grid_m)"
    )
    return ",\n".join(parts)


@query(
    "geo1_wgs84_to_osgb36",
    f"""with {osgb36_sql("stations")} select stationReference, round(easting, 5) as easting,
        round(northing, 5) as northing from {OSGB36_SQL}""",
    ("stations",),
)
def geo1(v: Views):
    return rounded(g.add_osgb36(v.stations).select("stationReference", "easting", "northing"), 5, "easting", "northing")


@query(
    "geo1_whole_metres",
    f"""with {osgb36_sql("stations")} select stationReference, cast(trunc(easting) as bigint) as easting,
        cast(trunc(northing) as bigint) as northing from {OSGB36_SQL}""",
    ("stations",),
)
def geo1_whole(v: Views):
    return g.add_osgb36(v.stations, whole=True).select("stationReference", "easting", "northing")


@query(
    "geo2_osgb36_to_wgs84",
    f"""with {wgs84_sql("unit")} select postcode, round(latitude, 8) as latitude, round(longitude, 8) as longitude
        from {WGS84_SQL}""",
    ("unit",),
)
def geo2(v: Views):
    return rounded(g.add_wgs84(v.unit).select("postcode", "latitude", "longitude"), 8, "latitude", "longitude")


@query(
    "udx6_conversion_as_expression",
    f"""with {wgs84_sql("unit")} select postcode, round(latitude, 8) as latitude, round(longitude, 8) as longitude
        from {WGS84_SQL}""",
    ("unit",),
)
def udx6(v: Views):
    place = g.wgs84_of(F.col("easting"), F.col("northing"))
    df = v.unit.select("postcode", place.alias("w")).select("postcode", "w.latitude", "w.longitude")
    return rounded(df, 8, "latitude", "longitude")


_RADIANS = "select stationReference, radians(latitude) as la, radians(longitude) as lo from stations"


@query(
    "geo3_datum_shift",
    f"""with r as ({_RADIANS}), {_shift("r", "o", False)}
        select stationReference, round(degrees(la), 8) as latitude, round(degrees(lo), 8) as longitude from o""",
    ("stations",),
)
def geo3(v: Views):
    df = v.stations.select(
        "stationReference", F.radians("latitude").alias("la"), F.radians("longitude").alias("lo")
    )
    df = g.shift_datum(df, "la", "lo", to_wgs84=False)
    return df.select(
        "stationReference",
        F.round(F.degrees("la"), 8).alias("latitude"),
        F.round(F.degrees("lo"), 8).alias("longitude"),
    )


@query(
    "geo3_datum_shift_back",
    f"""with r as ({_RADIANS}), {_shift("r", "o", True)}
        select stationReference, round(degrees(la), 8) as latitude, round(degrees(lo), 8) as longitude from o""",
    ("stations",),
)
def geo3_back(v: Views):
    df = v.stations.select(
        "stationReference", F.radians("latitude").alias("la"), F.radians("longitude").alias("lo")
    )
    df = g.shift_datum(df, "la", "lo", to_wgs84=True)
    return df.select(
        "stationReference",
        F.round(F.degrees("la"), 8).alias("latitude"),
        F.round(F.degrees("lo"), 8).alias("longitude"),
    )


def _cartesian_sql(figure: g.Figure) -> str:
    nu = _nu("la", figure)
    return (
        f"({nu} + {_n(figure.height)}) * cos(la) * cos(lo) as x, ({nu} + {_n(figure.height)}) * cos(la) * sin(lo) as y,"
        f" ((1 - {_n(figure.e2)}) * {nu} + {_n(figure.height)}) * sin(la) as z"
    )


@query(
    "geo4_cartesian",
    f"""with r as ({_RADIANS}), p as (select stationReference, {_cartesian_sql(g.AIRY)} from r)
        select stationReference, round(x, 4) as x, round(y, 4) as y, round(z, 4) as z from p""",
    ("stations",),
)
def geo4(v: Views):
    df = v.stations.select(
        "stationReference", F.radians("latitude").alias("la"), F.radians("longitude").alias("lo")
    )
    return rounded(
        g.to_cartesian(df, "la", "lo", ("x", "y", "z"), g.AIRY).drop("la", "lo"), 4, "x", "y", "z"
    )


@query(
    "geo4_cartesian_round_trip",
    "select stationReference, round(latitude, 8) as latitude, round(longitude, 8) as longitude from stations",
    ("stations",),
)
def geo4_back(v: Views):
    df = v.stations.select(
        "stationReference", F.radians("latitude").alias("la"), F.radians("longitude").alias("lo")
    )
    df = g.to_cartesian(df, "la", "lo", ("x", "y", "z"), g.GRS).drop("la", "lo")
    df = g.to_geodetic(df, ("x", "y", "z"), "la", "lo", g.GRS)
    return df.select(
        "stationReference",
        F.round(F.degrees("la"), 8).alias("latitude"),
        F.round(F.degrees("lo"), 8).alias("longitude"),
    )


@query(
    "geo5_angle_forms",
    """with o as materialized (select stationReference, latitude + 0.0001e0 as la from stations),
        d as (select stationReference, cast(floor(la) as bigint) as deg, (la - floor(la)) * 60 as m from o),
        e as (select *, cast(floor(m) as bigint) as mins, round((m - floor(m)) * 60, 2) as secs from d)
        select stationReference, deg as degrees, mins as minutes, secs as seconds,
          round(deg + mins / 60.0e0 + secs / 3600.0e0, 6) as back,
          round(radians(deg + mins / 60.0e0 + secs / 3600.0e0), 8) as angle from e""",
    ("stations",),
)
def geo5(v: Views):
    # The offset keeps whole minutes off the rounding edge.
    angle = F.radians(F.col("latitude") + 0.0001)
    df = v.stations.select("stationReference", F.inline(F.array(radians_to_dms(angle))))
    df = df.withColumn("seconds", F.round("seconds", 2))
    parts = [F.col(name).cast("double") for name in ("degrees", "minutes", "seconds")]
    return df.select(
        "*", F.round(dms_to_degrees(*parts), 6).alias("back"), F.round(dms_to_radians(*parts), 8).alias("angle")
    )


@query(
    "geo6_add_coordinates",
    f"""with {wgs84_sql("labelled")} select postcode, easting, northing, round(latitude, 8) as latitude,
        round(longitude, 8) as longitude from {WGS84_SQL}""",
    ("labelled",),
)
def geo6(v: Views):
    df = g.add_wgs84(v.labelled).select("postcode", "easting", "northing", "latitude", "longitude")
    return rounded(df, 8, "latitude", "longitude")

"""Nearest-neighbour and distance joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.distance import pairs_within, pairs_within_wgs84, to_places, to_places_wgs84
from tidemark.operators.knn import nearest, nearest_one
from tidemark.operators.location import knn_authority, knn_risk, modal_authority, place_facts, risk_surface
from tidemark.plans.catalog import query
from tidemark.plans.catalog.common import mode_sql, near_sql, rounded
from tidemark.plans.catalog.geodesy import OSGB36_SQL, osgb36_sql
from tidemark.sources.views import Views

ASKED = "q as (select postcode as qid, easting, northing from unlabelled)"


def asked(v: Views):
    return v.unlabelled.select(F.col("postcode").alias("qid"), "easting", "northing")


@query(
    "jon8_nearest_unit",
    f"""with {ASKED}, r as (select postcode, easting, northing, soilType, elevation from labelled),
        {near_sql("near", "q", "r", 1)} select qid, postcode, easting, northing, soilType, elevation, d2 from near""",
    ("labelled", "unlabelled"),
)
def jon8(v: Views):
    reference = v.labelled.select("postcode", "easting", "northing", "soilType", "elevation")
    return nearest_one(asked(v), reference, "qid")


@query(
    "jon9_nearest_fifteen",
    f"""with {ASKED}, r as (select postcode, easting, northing, riskLabel from labelled),
        {near_sql("near", "q", "r", 15)} select qid, rank, postcode, riskLabel, d2 from near""",
    ("labelled", "unlabelled"),
)
def jon9(v: Views):
    reference = v.labelled.select("postcode", "easting", "northing", "riskLabel")
    return nearest(asked(v), reference, 15, "qid", "postcode").drop("easting", "northing")


PLACES = [("London", 530000, 180000), ("Bath", 374999, 165441), ("Haywards Heath", 535295, 123643)]
PLACES_SQL = ", ".join(f"('{p}', {e}.0e0, {n}.0e0)" for p, e, n in PLACES)


@query(
    "jon10_distance_to_places",
    f"""select k, p.place, round(sqrt((easting - p.e) ** 2 + (northing - p.n) ** 2), 6) as dist
        from unit, (values {PLACES_SQL}) p(place, e, n)""",
    ("unit",),
)
def jon10(v: Views):
    return rounded(to_places(v.unit.select("k", "easting", "northing"), PLACES).select("k", "place", "dist"), 6, "dist")


@query(
    "jon10_pairs_within_radius",
    """select l.postcode as unit, r.postcode as other, round(sqrt(((l.easting - r.easting) * (l.easting - r.easting)
         + (l.northing - r.northing) * (l.northing - r.northing)) * 1.0e0), 6) as dist
       from unlabelled l join labelled r on (l.easting - r.easting) * (l.easting - r.easting)
         + (l.northing - r.northing) * (l.northing - r.northing) <= 4000000""",
    ("labelled", "unlabelled"),
)
def jon10_pairs(v: Views):
    left = v.unlabelled.select(F.col("postcode").alias("unit"), "easting", "northing")
    right = v.labelled.select(F.col("postcode").alias("other"), "easting", "northing")
    return rounded(pairs_within(left, right, 2000.0, "unit", "other"), 6, "dist")


def _haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371009 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))"
    )


CITIES = [("London", 51.507, -0.128), ("Leeds", 53.8, -1.55)]
CITIES_SQL = ", ".join(f"('{p}', {a}e0, {o}e0)" for p, a, o in CITIES)


@query(
    "jon11_great_circle_to_places",
    f"""select stationReference, c.place, round({_haversine_sql("latitude", "longitude", "c.a", "c.o")}, 3) as dist
        from stations, (values {CITIES_SQL}) c(place, a, o)""",
    ("stations",),
)
def jon11(v: Views):
    df = v.stations.select("stationReference", "latitude", "longitude")
    return rounded(to_places_wgs84(df, CITIES).select("stationReference", "place", "dist"), 3, "dist")


@query(
    "jon11_great_circle_pairs",
    f"""with s as (select * from stations where latitude is not null and longitude is not null),
        p as (select l.stationReference as station, r.stationReference as other,
          {_haversine_sql("l.latitude", "l.longitude", "r.latitude", "r.longitude")} as dist
          from s l, s r where l.stationName = 'Rainfall station' and r.stationName <> 'Rainfall station')
        select station, other, round(dist, 3) as dist from p where dist <= 40000""",
    ("stations",),
)
def jon11_pairs(v: Views):
    rain = F.col("stationName") == "Rainfall station"
    left = v.stations.where(rain).withColumnRenamed("stationReference", "station")
    right = v.stations.where(~rain).withColumnRenamed("stationReference", "other")
    return rounded(pairs_within_wgs84(left, right, 40_000.0, "station", "other"), 3, "dist")


@query(
    "loc1_modal_authority",
    f"with {mode_sql('m', 'labelled', 'localAuthority')} select qid, m.localAuthority from (select postcode as qid from unlabelled), m",
    ("labelled", "unlabelled"),
)
def loc1(v: Views):
    return modal_authority(asked(v).select("qid"), v.labelled)


def authority_sql(queries: str, out: str = "vote") -> str:
    return f"""
{out}_r as (select postcode, easting, northing, localAuthority from labelled where localAuthority is not null),
{near_sql(out + "_n", queries, out + "_r", 5)},
{out} as (select qid, localAuthority from (select qid, localAuthority,
  row_number() over (partition by qid order by count(*) desc, localAuthority) as rn from {out}_n
  group by qid, localAuthority) where rn = 1)"""


def risk_sql(queries: str, out: str = "risk") -> str:
    return f"""
{out}_r as (select postcode, easting, northing, riskLabel from labelled where riskLabel is not null),
{near_sql(out + "_n", queries, out + "_r", 15)},
{out} as (select qid, cast(round_even(coalesce(avg(case when d2 = 0 then riskLabel end),
  sum(riskLabel / sqrt(case when d2 = 0 then null else d2 end)) / sum(1 / sqrt(case when d2 = 0 then null else d2 end))), 0) as int)
  as riskLabel from {out}_n group by qid)"""


@query(
    "loc2_knn_authority",
    f"with {ASKED}, {authority_sql('q')} select qid, localAuthority from vote",
    ("labelled", "unlabelled"),
)
def loc2(v: Views):
    return knn_authority(asked(v), v.labelled, "qid")


@query(
    "loc3_knn_risk",
    f"with {ASKED}, {risk_sql('q')} select qid, riskLabel from risk",
    ("labelled", "unlabelled"),
)
def loc3(v: Views):
    return knn_risk(asked(v), v.labelled, "qid")


@query(
    "loc4_place_facts",
    f"""with {osgb36_sql("stations")}, q as (select stationReference as qid, easting, northing from {OSGB36_SQL}
          where latitude is not null and longitude is not null), {authority_sql("q")}, {risk_sql("q")}
        select qid, localAuthority, riskLabel from vote join risk using (qid)""",
    ("stations", "labelled"),
)
def loc4(v: Views):
    points = v.stations.select(F.col("stationReference").alias("qid"), "latitude", "longitude")
    return place_facts(points, v.labelled, "qid")


@query(
    "ext1_risk_surface",
    f"""with b as (select min(easting) as x0, max(easting) as x1, min(northing) as y0, max(northing) as y1 from labelled),
        x as (select i, x0 + i * 4000 as easting from b, range(1000) r(i) where x0 + i * 4000 <= x1),
        y as (select i as j, y0 + i * 4000 as northing from b, range(1000) r(i) where y0 + i * 4000 <= y1),
        q as materialized (select i * 1000 + j as qid, easting, northing from x, y), {risk_sql("q")}
        select easting * 1.0e0 as easting, northing * 1.0e0 as northing, riskLabel from risk join q using (qid)""",
    ("labelled",),
)
def ext1(v: Views):
    return risk_surface(v.labelled, 4000.0)



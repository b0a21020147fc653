"""Map layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.constants import PALETTE_SIZE, RISK_COLOURS
from tidemark.operators import layers
from tidemark.plans.catalog import query
from tidemark.plans.catalog.common import (
    KEYED,
    LOCATED,
    latest_sql,
    located_readings,
    located_units,
    plain_time,
    rounded,
)
from tidemark.plans.catalog.geodesy import WGS84_SQL, wgs84_sql
from tidemark.plans.catalog.windows import BAND
from tidemark.sources.views import Views

PLACE = "round(latitude, 8) as latitude, round(longitude, 8) as longitude"
COLOUR = "case riskLabel " + " ".join(f"when {k} then '{c}'" for k, c in RISK_COLOURS.items()) + " else 'black' end"


def _placed(df):
    return rounded(df, 8, "latitude", "longitude")


@query(
    "lyr1_flood_by_area",
    f"""with {wgs84_sql("unit")}, k as (select {KEYED}, substr(postcode, 1, 2) as postcodeArea from {WGS84_SQL}),
        a as (select postcodeArea, count(*) as n_area, cast(dense_rank() over (order by postcodeArea) - 1 as int) as palette
          from k where postcodeArea in ('BA', 'NP', 'SW') group by postcodeArea)
        select postcode, postcodeArea, postcodeDistrict, postcodeSector, historicallyFlooded, {PLACE}, palette, n_area
        from k join a using (postcodeArea)""",
    ("unit",),
)
def lyr1(v: Views):
    return _placed(layers.flood_by_area(located_units(v), ["BA", "NP", "SW"]))


@query(
    "lyr2_authority_points",
    f"""with {wgs84_sql("unit")}, c as (select localAuthority, cast((dense_rank() over (order by localAuthority) - 1) % {PALETTE_SIZE} as int)
          as palette from (select distinct localAuthority from unit where localAuthority is not null))
        select localAuthority, postcode, {PLACE}, palette from {WGS84_SQL} join c using (localAuthority)""",
    ("unit",),
)
def lyr2(v: Views):
    return _placed(layers.authority_points(located_units(v)))


@query(
    "lyr3_flooded_points",
    f"""with {wgs84_sql("unit")} select postcode, {PLACE}, riskLabel as risk, {COLOUR} as colour
        from {WGS84_SQL} where historicallyFlooded = 1""",
    ("unit",),
)
def lyr3(v: Views):
    return _placed(layers.flooded_points(located_units(v)))


@query(
    "lyr3_flooded_authorities",
    f"""with p as (select n_nationkey as boundary, n_name as name from nation
          where n_name in (select localAuthority from unit where historicallyFlooded = 1 and localAuthority is not null))
        select boundary, name, cast((dense_rank() over (order by name) - 1) % {PALETTE_SIZE} as int) as palette from p""",
    ("unit",),
)
def lyr3_authorities(v: Views):
    boundaries = v.table("nation").select(F.col("n_nationkey").alias("boundary"), F.col("n_name").alias("name"))
    return layers.flooded_authorities(v.unit, boundaries, "name")


@query(
    "lyr4_weather",
    f"""with {LOCATED}, {latest_sql("lat", "rainfall")} select stationReference, dateTime, latitude, longitude, value,
        {BAND} as band from lat""",
    ("readings", "stations"),
)
def lyr4(v: Views):
    return plain_time(layers.weather(located_readings(v), "rainfall"))


def _position(name: str) -> str:
    return f"""select '{name}' as layer, stationReference, dateTime, latitude, longitude, value,
      round(least(greatest((value - q.lo) / (q.hi - q.lo), 0), 1), 9) as position from lat_{name},
      (select quantile_cont(value, 0.05) as lo, quantile_cont(value, 0.95) as hi from lat_{name}) q"""


@query(
    "lyr5_rainfall_and_level",
    f"""with {LOCATED}, {latest_sql("lat_rainfall", "rainfall")}, {latest_sql("lat_level", "level")}
        {_position("rainfall")} union all {_position("level")}""",
    ("readings", "stations"),
)
def lyr5(v: Views):
    return rounded(plain_time(layers.rainfall_and_level(located_readings(v))), 9, "position")


@query(
    "lyr6_colour_and_size",
    f"""with {wgs84_sql("unit")}, q as (select quantile_cont(medianPrice, 0.01) as lo, quantile_cont(medianPrice, 0.99) as hi from unit)
        select postcode, {PLACE}, riskLabel, medianPrice, round((riskLabel - 1) / 6.0e0, 9) as position,
          round(case when medianPrice is not null then 5 + 20 * least(greatest((medianPrice - lo) / (hi - lo), 0), 1) end, 6) as size
        from {WGS84_SQL}, q where riskLabel is not null""",
    ("unit",),
)
def lyr6(v: Views):
    df = layers.colour_and_size(located_units(v), "riskLabel", "medianPrice")
    return rounded(rounded(_placed(df), 9, "position"), 6, "size")


@query(
    "lyr7_flood_and_weather",
    f"""with {wgs84_sql("unit")}, {LOCATED}, {latest_sql("lat", "rainfall")}
        select 'flood' as layer, postcode as key, {PLACE}, riskLabel * 1.0e0 as value, {COLOUR} as colour
        from {WGS84_SQL} where historicallyFlooded = 1
        union all select 'weather', stationReference, {PLACE}, value, {BAND} from lat""",
    ("unit", "readings", "stations"),
)
def lyr7(v: Views):
    return _placed(layers.flood_and_weather(located_units(v), located_readings(v)))

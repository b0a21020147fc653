"""Key joins: lookups, merges, fall-back chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.geodesy import add_osgb36
from tidemark.functions.postcode import with_postcode_keys
from tidemark.operators.lookups import (
    boundaries_present,
    fall_back,
    lookup_grid,
    lookup_wgs84,
    reading_coordinates,
    unit_district_merge,
    unit_sector_merge,
)
from tidemark.operators.quantiles import medians, scalars
from tidemark.operators.selection import split_stations
from tidemark.plans.catalog import query
from tidemark.plans.catalog.common import KEYED, LOCATED, REQUESTS, keyed, requests, rounded
from tidemark.plans.catalog.geodesy import WGS84_SQL, wgs84_sql
from tidemark.sources.views import Views


@query(
    "jon1_lookup_easting_northing",
    f"""with {REQUESTS} select r.ord, r.postcode, u.easting, u.northing from requests r
        left join unit u on r.postcode = u.postcode""",
    ("unit",),
)
def jon1(v: Views):
    return lookup_grid(requests(v), v.unit)


@query(
    "jon2_lookup_lat_long",
    f"""with {REQUESTS}, places as (select r.ord, r.postcode, u.easting, u.northing from requests r
          left join unit u on r.postcode = u.postcode), {wgs84_sql("places")}
        select ord, postcode, round(latitude, 8) as latitude, round(longitude, 8) as longitude from {WGS84_SQL}""",
    ("unit",),
)
def jon2(v: Views):
    return rounded(lookup_wgs84(requests(v), v.unit), 8, "latitude", "longitude")


def _located(v: Views, clean: bool):
    rainfall, level = split_stations(add_osgb36(v.stations))
    df = reading_coordinates(v.readings, rainfall, level, store_clean_value=clean)
    return df.drop("easting", "northing")


@query("jon3_reading_coordinates", f"with {LOCATED} select * from loc", ("readings", "stations"))
def jon3(v: Views):
    return _located(v, False)


@query(
    "jon3_reading_coordinates_clean",
    f"""with {LOCATED}, c as (select * exclude (value),
          coalesce(try_cast(value as double), try_cast(split_part(value, '|', 1) as double)) as value from loc)
        select * from c where value is not null""",
    ("readings", "stations"),
)
def jon3_clean(v: Views):
    return _located(v, True)


@query(
    "jon4_unit_sector_merge",
    f"""with u as (select {KEYED}, 1 as households from labelled),
        s as (select postcodeSector, median(households) as h, median(numberOfPostcodeUnits) as n, median(headcount) as p
              from sector_data group by postcodeSector)
        select u.k, u.postcode, u.postcodeSector, u.households, s.h as households_sector,
          s.n as numberOfPostcodeUnits, s.p as headcount
        from u join s on u.postcodeSector = s.postcodeSector""",
    ("labelled", "sector_data"),
)
def jon4(v: Views):
    units = keyed(v.labelled).select("k", "postcode", "postcodeSector", F.lit(1).alias("households"))
    return unit_sector_merge(units, v.sector_data)


@query(
    "jon5_unit_district_merge",
    f"""with u as (select {KEYED} from labelled), d as (select postcodeDistrict, median(catsPerHousehold) as c,
          median(`pre_1900`) as p from district_data group by postcodeDistrict)
        select u.k, u.postcode, u.postcodeDistrict, d.c as catsPerHousehold, d.p as `pre_1900`
        from u join d on u.postcodeDistrict = d.postcodeDistrict""",
    ("labelled", "district_data"),
)
def jon5(v: Views):
    units = keyed(v.labelled).select("k", "postcode", "postcodeDistrict")
    return unit_district_merge(units, v.district_data.select("postcodeDistrict", "catsPerHousehold", "pre_1900"))


@query(
    "jon6_unit_left_district",
    f"""with u as (select {KEYED} from unit) select u.k, u.postcode, u.postcodeDistrict, d.dogsPerHousehold
        from u left join district_data d on u.postcodeDistrict = d.postcodeDistrict""",
    ("unit", "district_data"),
)
def jon6(v: Views):
    units = keyed(v.unit).select("k", "postcode", "postcodeDistrict")
    return units.join(v.district_data.select("postcodeDistrict", "dogsPerHousehold"), "postcodeDistrict", "left")


@query(
    "jon7_fallback_chain",
    f"""with l as (select {KEYED} from labelled), u as (select {KEYED} from unlabelled),
        s as (select postcodeSector, median(elevation) as m from l group by 1),
        d as (select postcodeDistrict, median(elevation) as m from l group by 1)
        select u.k, u.postcode, coalesce(u.elevation, s.m, d.m, (select median(elevation) from l)) as elevation
        from u left join s on u.postcodeSector = s.postcodeSector
        left join d on u.postcodeDistrict = d.postcodeDistrict""",
    ("labelled", "unlabelled"),
)
def jon7(v: Views):
    labelled = keyed(v.labelled)
    levels = [(key, medians(labelled, ["elevation"], [key])) for key in ("postcodeSector", "postcodeDistrict")]
    units = with_postcode_keys(v.unlabelled)
    filled = fall_back(units, ["elevation"], levels, scalars(medians(labelled, ["elevation"])))
    return filled.select("k", "postcode", "elevation")


@query(
    "jon12_boundaries_present",
    """with b as (select n_nationkey as boundary, concat('  ', n_name, ' ') as name from nation)
       select boundary, trim(name) as name from b
       where trim(name) in (select localAuthority from unit where historicallyFlooded = 1 and localAuthority is not null)""",
    ("unit",),
)
def jon12(v: Views):
    boundaries = v.table("nation").select(
        F.col("n_nationkey").alias("boundary"), F.concat(F.lit("  "), F.col("n_name"), F.lit(" ")).alias("name")
    )
    return boundaries_present(boundaries, v.unit.where("historicallyFlooded = 1"), "name")

"""Pieces shared by the registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geodesy import add_osgb36, add_wgs84
from tidemark.operators.lookups import reading_coordinates
from tidemark.operators.selection import split_stations
from tidemark.sources.views import Views

# Keys of the canonical postcodes of the views.
SECTOR = "substr(postcode, 1, length(postcode) - 2)"
DISTRICT = "split_part(postcode, ' ', 1)"
KEYED = f"*, {SECTOR} as postcodeSector, {DISTRICT} as postcodeDistrict"


def plain_time(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps without zone, as the data folder holds them."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names or ("dateTime",)})


def rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(f"`{n}`"), places) for n in names})


def keyed(df: DataFrame) -> DataFrame:
    """Sector and district of canonical postcodes."""
    return df.withColumns(
        {
            "postcodeSector": F.expr("substring(postcode, 1, length(postcode) - 2)"),
            "postcodeDistrict": F.split("postcode", " ")[0],
        }
    )


def located_units(v: Views) -> DataFrame:
    return add_wgs84(keyed(v.unit))


def located_readings(v: Views) -> DataFrame:
    """Readings with station coordinates; level figures stay as they are."""
    rainfall, level = split_stations(add_osgb36(v.stations))
    return reading_coordinates(v.readings, rainfall, level)


# Readings joined with the position of a fitting station, for SQL twins.
LOCATED = """
loc as (select r.dateTime, r.stationReference, r.parameter, r.unitName, r.value, s.latitude, s.longitude
  from readings r join stations s on r.stationReference = s.stationReference
   and ((r.parameter = 'rainfall' and s.stationName = 'Rainfall station')
     or (r.parameter = 'level' and s.stationName <> 'Rainfall station'))
  where s.latitude is not null and s.longitude is not null)"""


def latest_sql(name: str, parameter: str) -> str:
    return f"""
{name} as (select * from (
  select stationReference, dateTime, latitude, longitude, v as value,
    row_number() over (partition by stationReference order by dateTime desc nulls first, v desc nulls last) as rn
  from (select *, try_cast(value as double) as v from loc where lower(parameter) like '%{parameter}%'))
  where rn = 1 and latitude is not null and longitude is not null and value is not null)"""


def mode_sql(name: str, table: str, col: str, key: str | None = None) -> str:
    """CTE with the most frequent value, ties to the smallest."""
    part = f"partition by {key}" if key else ""
    head = f"{key}, " if key else ""
    return f"""
{name} as (select {head}{col} from (
  select {head}{col}, row_number() over ({part} order by count(*) desc, {col}) as rn
  from {table} where {col} is not null group by {head}{col}) where rn = 1)"""


def near_sql(name: str, queries: str, reference: str, k: int, extra: str = "") -> str:
    """CTE with the k nearest rows by brute force; queries need qid, easting, northing."""
    return f"""
{name} as (select * from (
  select q.qid, r.*, (q.easting - r.easting) * (q.easting - r.easting) * 1.0e0
      + (q.northing - r.northing) * (q.northing - r.northing) as d2,
    row_number() over (partition by q.qid order by (q.easting - r.easting) * (q.easting - r.easting) * 1.0e0
      + (q.northing - r.northing) * (q.northing - r.northing), r.postcode) as rank
  from {queries} q cross join {reference} r {extra}) where rank <= {k})"""


# A request list that grows with the data: every unit, some of them again, and strangers beside them.
REQUESTS = """
requests as (select k as ord, postcode from unit
  union all select k + 1000000000 as ord, postcode from unit where k % 9 = 0
  union all select k + 2000000000 as ord, concat('ZZ', cast(k as varchar(10)), ' 9ZZ') as postcode from unit where k % 10 = 7)"""


def requests(v: Views) -> DataFrame:
    unit = v.unit.select("k", "postcode")
    later = lambda more: (F.col("k") + F.lit(more)).alias("ord")
    again = unit.where("k % 9 = 0").select(later(1_000_000_000), "postcode")
    strange = F.concat(F.lit("ZZ"), F.col("k").cast("string"), F.lit(" 9ZZ")).alias("postcode")
    strangers = unit.where("k % 10 = 7").select(later(2_000_000_000), strange)
    return unit.withColumnRenamed("k", "ord").unionByName(again).unionByName(strangers)

"""Latest rows, priorities, bands, codes, neighbour ranks and in-table statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.constants import PALETTE_SIZE, RAW_FEATURES
from tidemark.operators.impute import within_table_by_postcode
from tidemark.operators.knn import nearest
from tidemark.operators.ranking import category_codes, upsert
from tidemark.operators.stations import latest_readings, value_bands
from tidemark.plans.catalog import query
from tidemark.plans.catalog.common import (
    KEYED,
    LOCATED,
    keyed,
    latest_sql,
    located_readings,
    mode_sql,
    near_sql,
    plain_time,
)
from tidemark.sources.views import Views

RAW = ", ".join(RAW_FEATURES)


@query(
    "win1_latest_rainfall",
    f"with {LOCATED}, {latest_sql('lat', 'rainfall')} select stationReference, dateTime, latitude, longitude, value from lat",
    ("readings", "stations"),
)
def win1(v: Views):
    latest = latest_readings(located_readings(v), "rainfall")
    return plain_time(latest).select("stationReference", "dateTime", "latitude", "longitude", "value")


_CHANGED = f"""changed as (select postcode, easting + 1 as easting, northing, 'Changed' as soilType, elevation,
  nearestWatercourse, distanceToWatercourse, localAuthority from unit where k % 5 = 1 or k % 20 = 0),
base as (select {RAW} from labelled)"""


def _changed(v: Views):
    return v.unit.where("k % 5 = 1 or k % 20 = 0").select(*RAW_FEATURES).withColumns(
        {"easting": F.col("easting") + 1, "soilType": F.lit("Changed")}
    )


@query(
    "win2_first_table_wins",
    f"""with {_CHANGED} select * from base
        union all select * from changed where postcode not in (select postcode from base)""",
    ("unit", "labelled"),
)
def win2(v: Views):
    return upsert(v.labelled.select(*RAW_FEATURES), _changed(v), "postcode", newest_wins=False)


@query(
    "win2_last_table_wins",
    f"""with {_CHANGED} select * from changed
        union all select * from base where postcode not in (select postcode from changed)""",
    ("unit", "labelled"),
)
def win2_last(v: Views):
    return upsert(v.labelled.select(*RAW_FEATURES), _changed(v), "postcode")


BAND = """case when value >= (select quantile_cont(value, 0.75) from lat) then 'red'
  when value >= (select quantile_cont(value, 0.5) from lat) then 'orange'
  when value >= (select quantile_cont(value, 0.25) from lat) then 'green' else 'blue' end"""


@query(
    "win3_quartile_bands",
    f"with {LOCATED}, {latest_sql('lat', 'level')} select stationReference, value, {BAND} as band from lat",
    ("readings", "stations"),
)
def win3(v: Views):
    return value_bands(latest_readings(located_readings(v), "level")).select("stationReference", "value", "band")


@query(
    "win4_palette_index",
    f"""with c as (select localAuthority, cast((dense_rank() over (order by localAuthority) - 1) % {PALETTE_SIZE} as int)
          as palette from (select distinct localAuthority from unit where localAuthority is not null))
        select u.postcode, u.localAuthority, c.palette from unit u left join c on u.localAuthority = c.localAuthority""",
    ("unit",),
)
def win4(v: Views):
    codes = category_codes(v.unit, "localAuthority", "palette", PALETTE_SIZE)
    return v.unit.select("postcode", "localAuthority").join(codes, "localAuthority", "left")


@query(
    "win5_neighbour_ranks",
    f"""with q as (select postcode as qid, easting, northing from unlabelled), r as (select postcode, easting, northing from labelled),
        {near_sql("near", "q", "r", 5)} select qid, rank, postcode, d2 from near""",
    ("labelled", "unlabelled"),
)
def win5(v: Views):
    asked = v.unlabelled.select(F.col("postcode").alias("qid"), "easting", "northing")
    near = nearest(asked, v.labelled.select("postcode", "easting", "northing"), 5, "qid", "postcode")
    return near.select("qid", "rank", "postcode", "d2")


@query(
    "win6_in_table_statistics",
    f"""with u as (select k, postcode, elevation, soilType, {KEYED.replace("*, ", "")} from unit),
        u1 as (select * exclude (elevation), coalesce(elevation, median(elevation) over (partition by postcodeSector)) as elevation from u),
        u2 as (select * exclude (elevation), coalesce(elevation, median(elevation) over (partition by postcodeDistrict)) as elevation from u1),
        u3 as (select * exclude (elevation), coalesce(elevation, (select median(elevation) from u2)) as elevation from u2),
        {mode_sql("md", "u3", "soilType", "postcodeDistrict")},
        u4 as (select u3.* exclude (soilType), coalesce(u3.soilType, md.soilType) as soilType from u3 left join md using (postcodeDistrict)),
        {mode_sql("ms", "u4", "soilType", "postcodeSector")},
        u5 as (select u4.* exclude (soilType), coalesce(u4.soilType, ms.soilType) as soilType from u4 left join ms using (postcodeSector)),
        {mode_sql("mg", "u5", "soilType")}
        select k, postcode, elevation, coalesce(soilType, (select soilType from mg)) as soilType from u5""",
    ("unit",),
)
def win6(v: Views):
    df = keyed(v.unit).select("k", "postcode", "elevation", "soilType", "postcodeSector", "postcodeDistrict")
    return within_table_by_postcode(df, ["elevation"], ["soilType"]).select("k", "postcode", "elevation", "soilType")

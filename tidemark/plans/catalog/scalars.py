"""Text, number and time functions as table jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.constants import CLASS_PROBABILITY, ENGLAND_MEDIAN_PRICE
from tidemark.functions import numeric as n
from tidemark.functions.postcode import (
    canonical_postcode,
    district_of_sector,
    postcode_area,
    postcode_district,
    postcode_sector,
)
from tidemark.functions.readings import (
    clean_value,
    event_time,
    measure_qualifier,
    measure_station,
    measure_unit,
    tidy_qualifier,
)
from tidemark.operators.location import england_median_price, minimum_risk, never_flooded
from tidemark.operators.quantiles import exact_quantiles, scalars
from tidemark.operators.scaling import balanced_weights, cap_outliers, fixed_weights
from tidemark.operators.selection import split_stations
from tidemark.operators.layers import with_colour_position
from tidemark.operators.stations import repair_levels
from tidemark.plans.catalog import query
from tidemark.plans.catalog.common import DISTRICT, SECTOR, keyed, plain_time, rounded
from tidemark.sources.views import Views


def mangled(v: Views):
    """Units with postcodes written in six careless ways."""
    text = F.col("postcode")
    joined = F.replace(text, F.lit(" "), F.lit(""))
    raw = (
        F.when(F.col("k") % 6 == 0, F.lower(text))
        .when(F.col("k") % 6 == 1, joined)
        .when(F.col("k") % 6 == 2, F.replace(text, F.lit(" "), F.lit("_")))
        .when(F.col("k") % 6 == 3, F.replace(text, F.lit(" "), F.lit("-")))
        .when(F.col("k") % 6 == 4, F.lower(F.concat(F.lit("  "), F.replace(text, F.lit(" "), F.lit("   ")))))
        .otherwise(F.concat(F.replace(text, F.lit(" "), F.lit("+")), F.lit(" ")))
    )
    return v.unit.select("k", "postcode", raw.alias("raw"))


@query("str1_canonical_postcode", "select k, postcode as canonical from unit", ("unit",))
def str1(v: Views):
    return mangled(v).select("k", canonical_postcode(F.col("raw")).alias("canonical"))


@query("str2_district", f"select k, {DISTRICT} as district from unit", ("unit",))
def str2(v: Views):
    return mangled(v).select("k", postcode_district(F.col("raw")).alias("district"))


@query("str3_sector", f"select k, {SECTOR} as sector from unit", ("unit",))
def str3(v: Views):
    return mangled(v).select("k", postcode_sector(F.col("raw")).alias("sector"))


@query(
    "str4_district_of_sector",
    "select postcodeSector, split_part(postcodeSector, ' ', 1) as d1, split_part(postcodeSector, ' ', 1) as d2 from sector_data",
    ("sector_data",),
)
def str4(v: Views):
    sector = F.col("postcodeSector")
    return v.sector_data.select(
        "postcodeSector",
        district_of_sector(sector).alias("d1"),
        district_of_sector(F.replace(sector, F.lit(" "), F.lit("_"))).alias("d2"),
    )


@query(
    "str5_clean_value",
    """select dateTime, stationReference, parameter, coalesce(try_cast(value as double),
         try_cast(split_part(value, '|', 1) as double)) as value from readings""",
    ("readings",),
)
def str5(v: Views):
    return v.readings.select("dateTime", "stationReference", "parameter", clean_value(F.col("value")).alias("value"))


def measure_ids(v: Views):
    odd = "case when event_id % 50 = 0 then 'http://x/nothing' else concat('http://x/id/measures/', cast(user_id as string), 'TH-rainfall-tipping_bucket-raingauge_', event_type, '-t-15_min-mm/readings/2025') end"
    return v.table("events").selectExpr("event_id", f"{odd} as measure")


@query(
    "str6_measure_id_parts",
    """select event_id, case when event_id % 50 <> 0 then concat(cast(user_id as varchar), 'TH') end as station,
         case when event_id % 50 <> 0 then concat('tipping_bucket-raingauge_', event_type) end as qualifier,
         case when event_id % 50 <> 0 then 'mm/readings' end as unit from events""",
)
def str6(v: Views):
    m = F.col("measure")
    return measure_ids(v).select(
        "event_id",
        measure_station(m).alias("station"),
        measure_qualifier(m).alias("qualifier"),
        measure_unit(m).alias("unit"),
    )


@query(
    "str7_postcode_area",
    "select k, substr(postcode, 1, 2) as area from unit",
    ("unit",),
)
def str7(v: Views):
    return keyed(v.unit).select("k", postcode_area(F.col("postcodeDistrict")).alias("area"))


@query(
    "str8_tidy_qualifier",
    """select event_id, concat('Tipping Bucket-Raingauge ', upper(substr(event_type, 1, 1)), substr(event_type, 2)) as qualifier
       from events where event_id % 50 <> 0""",
)
def str8(v: Views):
    found = measure_ids(v).select("event_id", measure_qualifier(F.col("measure")).alias("qualifier")).where("qualifier is not null")
    return found.withColumn("qualifier", tidy_qualifier(F.col("qualifier")))


CAPPED = ["elevation", "medianPrice", "distanceToWatercourse"]


@query(
    "num1_cap_outliers",
    "with q as (select "
    + ", ".join(
        f"quantile_cont({c}, 0.25) as {c}_1, quantile_cont({c}, 0.75) as {c}_3" for c in CAPPED
    )
    + " from unit) select k, "
    + ", ".join(
        f"case when {c} is not null then least(greatest({c}, {c}_1 - 1.5 * ({c}_3 - {c}_1)),"
        f" {c}_3 + 1.5 * ({c}_3 - {c}_1)) end as {c}"
        for c in CAPPED
    )
    + " from unit, q",
    ("unit",),
)
def num1(v: Views):
    return cap_outliers(v.unit, CAPPED).select("k", *CAPPED)


@query(
    "num2_log_transform",
    """select k, round(ln(1 + medianPrice), 9) as logged, round(exp(ln(1 + medianPrice)) - 1, 3) as back from unit""",
    ("unit",),
)
def num2(v: Views):
    logged = F.log1p("medianPrice")
    return v.unit.select("k", F.round(logged, 9).alias("logged"), F.round(F.expm1(logged), 3).alias("back"))


@query(
    "num3_nearest_class",
    "select k, cast(round_even(riskLabel + (k % 3) / 2.0e0, 0) as int) as class from unit",
    ("unit",),
)
def num3(v: Views):
    return v.unit.select("k", n.nearest_class(F.col("riskLabel") + (F.col("k") % 3) / 2.0).alias("class"))


@query(
    "num4_marker_size",
    """with q as (select quantile_cont(medianPrice, 0.01) as lo, quantile_cont(medianPrice, 0.99) as hi from unit)
       select k, round(case when medianPrice is not null then 5 + 20 * least(greatest((medianPrice - lo) / (hi - lo), 0), 1) end, 6) as size,
         round(case when medianPrice is not null then 25 - 20 * least(greatest((medianPrice - lo) / (hi - lo), 0), 1) end, 6) as inverted
       from unit, q""",
    ("unit",),
)
def num4(v: Views):
    low, high = scalars(exact_quantiles(v.unit, ["medianPrice"], [0.01, 0.99]))["medianPrice"]
    ends = F.lit(low), F.lit(high)
    price = F.col("medianPrice")
    return v.unit.select(
        "k",
        F.round(n.interpolate_size(price, *ends), 6).alias("size"),
        F.round(n.interpolate_size(price, *ends, invert=True), 6).alias("inverted"),
    )


@query(
    "num5_colour_position",
    """with q as (select quantile_cont(elevation, 0.01) as lo, quantile_cont(elevation, 0.99) as hi from unit),
       c as (select soilType, dense_rank() over (order by soilType) - 1 as code from (select distinct soilType from unit where soilType is not null))
       select u.k, round(least(greatest((elevation - lo) / (hi - lo), 0), 1), 6) as by_elevation,
         round((riskLabel - 1) / 6.0e0, 6) as by_risk, round(code * 1.0e0 / (select max(code) from c), 6) as by_soil
       from unit u join q on true join c using (soilType) where elevation is not null""",
    ("unit",),
)
def num5(v: Views):
    df = with_colour_position(v.unit, "elevation").withColumnRenamed("position", "by_elevation")
    df = with_colour_position(df, "riskLabel").withColumnRenamed("position", "by_risk")
    df = with_colour_position(df, "soilType").withColumnRenamed("position", "by_soil")
    return rounded(df.select("k", "by_elevation", "by_risk", "by_soil"), 6, "by_elevation", "by_risk", "by_soil")


@query(
    "num6_distance_to_london",
    "select k, round(sqrt((easting - 530000.0e0) ** 2 + (northing - 180000.0e0) ** 2), 6) as dist from unit",
    ("unit",),
)
def num6(v: Views):
    return v.unit.select("k", F.round(n.distance_to_london(F.col("easting"), F.col("northing")), 6).alias("dist"))


PROBABILITY = "case riskLabel " + " ".join(f"when {k} then {p}e0" for k, p in CLASS_PROBABILITY.items()) + " else 0.0e0 end"


@query(
    "num7_class_probability",
    f"""with x as (select k, case when k % 29 = 0 then 9 when k % 31 = 0 then null else riskLabel end as riskLabel from unit)
        select k, {PROBABILITY} as probability from x""",
    ("unit",),
)
def num7(v: Views):
    label = F.when(F.col("k") % 29 == 0, 9).when(F.col("k") % 31 == 0, F.lit(None)).otherwise(F.col("riskLabel"))
    return v.unit.select("k", n.flood_probability(label).alias("probability"))


@query(
    "num8_fill_watercourse",
    """select k, coalesce(nearestWatercourse, case when distanceToWatercourse < 2000 then 'UnknownNearbyWatercourse'
         else 'NoWatercourse' end) as nearestWatercourse from unit""",
    ("unit",),
)
def num8(v: Views):
    filled = n.watercourse_or_guess(F.col("nearestWatercourse"), F.col("distanceToWatercourse"))
    return v.unit.select("k", filled.alias("nearestWatercourse"))


@query(
    "num9_repair_levels",
    """select stationReference, case when maxOnRecord < typicalRangeHigh then typicalRangeHigh else maxOnRecord end as maxOnRecord,
         case when minOnRecord > typicalRangeLow then typicalRangeLow else minOnRecord end as minOnRecord,
         case when typicalRangeHigh < typicalRangeLow then typicalRangeLow else typicalRangeHigh end as typicalRangeHigh,
         typicalRangeLow from stations where stationName <> 'Rainfall station' and latitude is not null and longitude is not null""",
    ("stations",),
)
def num9(v: Views):
    return repair_levels(split_stations(v.stations)[1]).drop("stationName", "latitude", "longitude")


@query(
    "num10_constant_columns",
    f"select k, 1 as riskLabel, {ENGLAND_MEDIAN_PRICE}e0 as medianPrice, false as historicallyFlooded from unit",
    ("unit",),
)
def num10(v: Views):
    return never_flooded(england_median_price(minimum_risk(v.unit.select("k"))))


@query(
    "num11_class_weights",
    """with c as (select riskLabel, count(*) as n from unit group by 1)
       select k, round((select sum(n) from c) * 1.0e0 / (select count(*) from c) / n, 9) as weight,
         case when historicallyFlooded = 1 then 3.0e0 else 1.0e0 end as flood_weight
       from unit join c using (riskLabel)""",
    ("unit",),
)
def num11(v: Views):
    df = balanced_weights(v.unit, "riskLabel")
    df = fixed_weights(df, "historicallyFlooded", {0: 1.0, 1: 3.0}, "flood_weight")
    return rounded(df.select("k", "weight", "flood_weight"), 9, "weight")


@query(
    "dat1_parse_times",
    """select event_id, case when event_id % 10 = 0 then null else date_trunc('second', ts) end as time from events""",
)
def dat1(v: Views):
    text = F.when(F.col("event_id") % 10 == 0, F.lit("not a time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    return plain_time(v.table("events").select("event_id", event_time(text).alias("time")), "time")


@query(
    "jsn1_nested_fields",
    "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
)
def jsn1(v: Views):
    return v.table("events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))

"""Projections, filters and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.constants import RAW_FEATURES
from tidemark.functions.numeric import planar_distance
from tidemark.functions.readings import parameter_is
from tidemark.operators.lookups import with_truth
from tidemark.operators.ranking import hash_split, stacked, upsert
from tidemark.operators.selection import (
    flooded_only,
    in_range,
    level_contradictions,
    not_numeric,
    numeric_and_other,
    prepared_order,
    raw_features,
    require_rows,
    split_stations,
    with_keys_in,
    without_match,
)
from tidemark.plans.catalog import query
from tidemark.plans.catalog.common import KEYED, REQUESTS, keyed, requests
from tidemark.sources.views import Views

RAW = ", ".join(RAW_FEATURES)


@query("prj1_raw_features", f"select {RAW} from unit", ("unit",))
def prj1(v: Views):
    return raw_features(v.unit)


@query(
    "prj2_drop_columns",
    "select k, postcode, easting, northing, soilType, elevation, distanceToWatercourse, riskLabel from unit",
    ("unit",),
)
def prj2(v: Views):
    return v.unit.drop("medianPrice", "historicallyFlooded", "localAuthority", "nearestWatercourse", "not_there")


@query(
    "prj3_canonical_order",
    f"select postcode, postcodeDistrict, postcodeSector, {', '.join(RAW_FEATURES[1:])}, riskLabel, medianPrice,"
    f" historicallyFlooded from (select {KEYED} from unit)",
    ("unit",),
)
def prj3(v: Views):
    return prepared_order(keyed(v.unit))


@query(
    "prj4_split_by_type",
    """select 'numeric' as kind, count(easting) + count(northing) + count(elevation) + count(distanceToWatercourse)
         + count(riskLabel) + count(medianPrice) + count(historicallyFlooded) as filled from unit
       union all select 'other', count(postcode) + count(soilType) + count(nearestWatercourse) + count(localAuthority)
         from unit""",
    ("unit",),
)
def prj4(v: Views):
    table = v.unit.drop("k")
    numeric, other = numeric_and_other(table)
    wide = table.agg(*[F.count(c).alias(c) for c in table.columns])
    kinds = [("numeric", numeric), ("other", other)]
    rows = [F.struct(F.lit(n).alias("kind"), sum((F.col(c) for c in cols), F.lit(0)).cast("bigint").alias("filled")) for n, cols in kinds]
    return wide.select(F.inline(F.array(*rows)))


@query(
    "flt1_requested_rows",
    f"with {REQUESTS} select * from unit where postcode in (select postcode from requests)",
    ("unit",),
)
def flt1(v: Views):
    return with_keys_in(v.unit, requests(v))


@query(
    "flt2_requests_without_features",
    f"with {REQUESTS} select * from requests where postcode not in (select postcode from labelled)",
    ("unit", "labelled"),
)
def flt2(v: Views):
    return without_match(requests(v), v.labelled)


@query(
    "flt3_range_filter",
    """select * from unit where riskLabel >= 2 and riskLabel <= 6 and distanceToWatercourse <= 2000
       and soilType is not null and elevation is not null and nearestWatercourse is not null
       and localAuthority is not null and medianPrice is not null""",
    ("unit",),
)
def flt3(v: Views):
    return require_rows(
        in_range(v.unit, {"riskLabel": (2, 6), "distanceToWatercourse": (None, 2000)}), "nothing left"
    )


@query("flt4_parameter_contains", "select * from readings where parameter ilike '%rain%'", ("readings",))
def flt4(v: Views):
    return v.readings.where(parameter_is(F.col("parameter"), "RAIN"))


@query(
    "flt5_drop_incomplete",
    """select * from stations where stationReference is not null and stationName is not null and latitude is not null
       and longitude is not null and maxOnRecord is not null and minOnRecord is not null
       and typicalRangeHigh is not null and typicalRangeLow is not null""",
    ("stations",),
)
def flt5(v: Views):
    return v.stations.na.drop(subset=["latitude", "longitude"]).na.drop("any")


@query(
    "flt6_rainfall_stations",
    """select stationReference, stationName, latitude, longitude from stations
       where stationName = 'Rainfall station' and latitude is not null and longitude is not null""",
    ("stations",),
)
def flt6_rain(v: Views):
    return split_stations(v.stations)[0]


@query(
    "flt6_level_stations",
    """select * from stations where stationName is distinct from 'Rainfall station' and latitude is not null
       and longitude is not null""",
    ("stations",),
)
def flt6_level(v: Views):
    return split_stations(v.stations)[1]


@query("flt7_flooded_only", "select * from unit where historicallyFlooded = 1", ("unit",))
def flt7(v: Views):
    return require_rows(flooded_only(v.unit), "no flooded unit")


@query(
    "flt9_invalid_values",
    "select * from readings where value is not null and try_cast(value as double) is null",
    ("readings",),
)
def flt9(v: Views):
    return not_numeric(v.readings)


@query(
    "flt10_level_contradictions",
    """select cast(count(*) filter (minOnRecord > maxOnRecord) as bigint) as min_above_max,
         cast(count(*) filter (typicalRangeLow > typicalRangeHigh) as bigint) as low_above_high,
         cast(count(*) filter (maxOnRecord < typicalRangeHigh) as bigint) as max_below_high,
         cast(count(*) filter (minOnRecord > typicalRangeLow) as bigint) as min_above_low
       from stations where stationName <> 'Rainfall station' and latitude is not null and longitude is not null""",
    ("stations",),
)
def flt10(v: Views):
    return level_contradictions(split_stations(v.stations)[1])


@query("srt1_by_station_and_time", "select stationReference, dateTime, value from readings", ("readings",))
def srt1(v: Views):
    return v.readings.select("stationReference", "dateTime", "value").orderBy("stationReference", "dateTime")


@query("srt2_head", "select * from unit order by postcode limit 20", ("unit",))
def srt2(v: Views):
    return v.unit.orderBy("postcode").limit(20)


SPLIT = """case when (('0x' || substr(md5(postcode || ':42'), 1, 12))::bigint % 1000003) % 10 < 1 then 'test'
  when (('0x' || substr(md5(postcode || ':42'), 1, 12))::bigint % 1000003) % 10 < 2 then 'location_test' else 'train' end"""


@query(
    "srt4_top_k_by_distance",
    """select postcode, round(sqrt((easting - 200000.0e0) ** 2 + (northing - 60000.0e0) ** 2), 6) as dist from unit
       order by (easting - 200000.0e0) ** 2 + (northing - 60000.0e0) ** 2, postcode limit 25""",
    ("unit",),
)
def srt4(v: Views):
    dist = planar_distance(F.col("easting"), F.col("northing"), F.lit(200000.0), F.lit(60000.0))
    near = v.unit.select("postcode", dist.alias("dist")).orderBy("dist", "postcode").limit(25)
    return near.withColumn("dist", F.round("dist", 6))


@query("srt3_seeded_split", f"select k, postcode, {SPLIT} as split from unit", ("unit",))
def srt3(v: Views):
    return hash_split(v.unit.select("k", "postcode"), "postcode", {"test": 1, "location_test": 1, "train": 8})


@query(
    "set1_union_by_name",
    f"select {RAW}, riskLabel, 0 as part from labelled union all select {RAW}, null, 1 from unlabelled",
    ("labelled", "unlabelled"),
)
def set1(v: Views):
    return stacked([v.labelled.select(*RAW_FEATURES, "riskLabel"), raw_features(v.unlabelled)], "part")


@query(
    "set2_train_difference",
    f"select * from labelled where postcode not in (select postcode from labelled where {SPLIT} <> 'train')",
    ("labelled",),
)
def set2(v: Views):
    split = hash_split(v.labelled, "postcode", {"test": 1, "location_test": 1, "train": 8})
    return v.labelled.join(split.where("split <> 'train'").select("postcode"), "postcode", "left_anti")


@query(
    "set3_predictions_with_fallback",
    f"""with {REQUESTS} select r.ord, r.postcode, coalesce(l.medianPrice, 245000.0e0) as medianPrice
        from requests r left join labelled l on r.postcode = l.postcode""",
    ("unit", "labelled"),
)
def set3(v: Views):
    from tidemark.plans.prices import with_price_fallback

    return with_price_fallback(requests(v), v.labelled.select("postcode", "medianPrice"))


NEW_DATA = f"""new as (select {RAW}, 7 as riskLabel, 1.0e0 as medianPrice, 1 as historicallyFlooded from unit where k % 4 = 0),
base as (select {RAW}, riskLabel, medianPrice, historicallyFlooded from labelled)"""


@query(
    "set4_upsert_labelled",
    f"with {NEW_DATA} select * from new union all select * from base where postcode not in (select postcode from new)",
    ("unit", "labelled"),
)
def set4(v: Views):
    labels = ["riskLabel", "medianPrice", "historicallyFlooded"]
    new = v.unit.where("k % 4 = 0").select(*RAW_FEATURES).withColumns(
        {"riskLabel": F.lit(7), "medianPrice": F.lit(1.0), "historicallyFlooded": F.lit(1)}
    )
    return upsert(v.labelled.select(*RAW_FEATURES, *labels), new, "postcode")


@query(
    "jon13_predictions_with_truth",
    f"""select postcode, riskLabel, cast(1 + (('0x' || substr(md5(cast(k as varchar) || ':42'), 1, 12))::bigint % 1000003) % 7 as int) as guess
        from labelled""",
    ("labelled",),
)
def jon13(v: Views):
    from tidemark.plans.catalog.scans import guessed_classes

    return with_truth(guessed_classes(v).select("postcode", "guess"), v.labelled.select("postcode", "riskLabel"))

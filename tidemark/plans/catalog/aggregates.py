"""Group statistics, descriptions, distributions, grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.constants import AGE_SHARES, RAW_FEATURES
from tidemark.functions.postcode import postcode_area
from tidemark.operators import sketches, stats
from tidemark.operators.lookups import smoothed
from tidemark.operators.quantiles import medians, modes
from tidemark.operators.selection import split_stations
from tidemark.plans.catalog import query
from tidemark.plans.catalog.common import DISTRICT, KEYED, keyed, located_units, mode_sql, rounded
from tidemark.plans.catalog.geodesy import WGS84_SQL, wgs84_sql
from tidemark.sources.views import Views

NUMBERS = ["elevation", "distanceToWatercourse", "medianPrice"]
TEXTS = ["soilType", "nearestWatercourse", "localAuthority"]


@query(
    "agg1_group_replace",
    f"""with l as (select {KEYED} from labelled), {mode_sql("m", "l", "soilType", "postcodeDistrict")},
        d as (select postcodeDistrict, median(elevation) as elevation, median(riskLabel) as riskLabel from l group by 1)
        select l.postcodeDistrict, d.elevation, d.riskLabel, m.soilType
        from l join d using (postcodeDistrict) join m using (postcodeDistrict)""",
    ("labelled",),
)
def agg1(v: Views):
    return smoothed(keyed(v.labelled).select("postcodeDistrict", "elevation", "riskLabel", "soilType"), "postcodeDistrict")


@query(
    "agg2_group_medians",
    f"""select postcodeSector, median(elevation) as elevation, median(distanceToWatercourse) as distanceToWatercourse,
        median(medianPrice) as medianPrice from (select {KEYED} from labelled) group by postcodeSector""",
    ("labelled",),
)
def agg2(v: Views):
    return medians(keyed(v.labelled), NUMBERS, ["postcodeSector"])


@query(
    "agg3_group_modes",
    f"""with l as (select {KEYED} from labelled where soilType is not null and nearestWatercourse is not null
          and localAuthority is not null), {mode_sql("a", "l", "soilType", "postcodeDistrict")},
        {mode_sql("b", "l", "nearestWatercourse", "postcodeDistrict")},
        {mode_sql("c", "l", "localAuthority", "postcodeDistrict")}
        select * from a join b using (postcodeDistrict) join c using (postcodeDistrict)""",
    ("labelled",),
)
def agg3(v: Views):
    return modes(keyed(v.labelled).na.drop(subset=TEXTS), TEXTS, ["postcodeDistrict"])


@query(
    "agg4_global_median_mode",
    f"""with {mode_sql("m", "labelled", "localAuthority")}, d as (select median(medianPrice) as medianPrice from labelled)
        select * from d, m""",
    ("labelled",),
)
def agg4(v: Views):
    middle = medians(v.labelled, ["medianPrice"]).first()["medianPrice"]
    return modes(v.labelled, ["localAuthority"]).select(F.lit(middle).alias("medianPrice"), "localAuthority")


@query(
    "agg5_missing_fraction",
    " union all ".join(
        f"select '{c}' as `column`, round(avg(case when {c} is null then 1.0e0 else 0.0e0 end), 9) as missing from unit"
        for c in RAW_FEATURES
    ),
    ("unit",),
)
def agg5(v: Views):
    return rounded(stats.missing_fraction(v.unit.select(*RAW_FEATURES)), 9, "missing")


@query(
    "agg6_describe",
    " union all ".join(
        f"""select '{c}' as `column`, count({c}) as count, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
        min({c}) * 1.0e0 as min, max({c}) * 1.0e0 as max, quantile_cont({c}, 0.25) as q25, quantile_cont({c}, 0.5) as q50,
        quantile_cont({c}, 0.75) as q75 from unit"""
        for c in ["easting", *NUMBERS]
    ),
    ("unit",),
)
def agg6(v: Views):
    return rounded(stats.describe(v.unit, ["easting", *NUMBERS]), 6, "mean", "std")


@query(
    "agg7_count_per_area",
    f"""select regexp_extract({DISTRICT}, '^([A-Z]+)', 1) as postcodeArea, count(*) as count from unit group by 1""",
    ("unit",),
)
def agg7(v: Views):
    area = postcode_area(F.col("postcodeDistrict")).alias("postcodeArea")
    return stats.count_by(keyed(v.unit).select(area), "postcodeArea")


@query(
    "agg8_extent",
    f"""with {wgs84_sql("unit")} select round(min(latitude), 7) as min_lat, round(max(latitude), 7) as max_lat,
        round(avg(latitude), 7) as mean_lat, round(min(longitude), 7) as min_lon, round(max(longitude), 7) as max_lon,
        round(avg(longitude), 7) as mean_lon from {WGS84_SQL}""",
    ("unit",),
)
def agg8(v: Views):
    table = stats.extent(located_units(v))
    return rounded(table, 7, *table.columns)


PROBS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


@query(
    "agg9_percentiles",
    " union all ".join(
        f"select {p}e0 as prob, round(quantile_cont(medianPrice, {p}), 6) as value from unit" for p in PROBS
    ),
    ("unit",),
)
def agg9(v: Views):
    return rounded(stats.percentiles(v.unit, "medianPrice", PROBS), 6, "value")


@query(
    "agg9_percentiles_from_sketches",
    " union all ".join(f"select {p}e0 as prob, true as within" for p in PROBS),
    ("unit",),
)
def agg9_sketches(v: Views):
    """Sketches of parts, merged: whether the rank of each answer lies within the stated error."""
    parts = sketches.sketched(v.unit.withColumn("part", F.col("k") % 7), "medianPrice", ["part"])
    found = sketches.sketch_percentiles(sketches.merged(parts), PROBS)
    found = found.agg(F.array_sort(F.collect_list(F.struct("prob", "value"))).alias("found"))  # one entry for each of PROBS
    room, price = sketches.rank_error(), F.col("medianPrice").cast("double")
    rows = v.unit.where(price.isNotNull()).join(found)  # one row beside each
    value = lambda i: F.get("found", F.lit(i))["value"]
    ranks = [F.struct(F.lit(float(p)).alias("prob"), F.avg((price < value(i)).cast("int")).alias("low"), F.avg((price <= value(i)).cast("int")).alias("high")) for i, p in enumerate(PROBS)]
    ranks = rows.agg(F.array(*ranks).alias("ranks")).select(F.inline("ranks"))
    return ranks.select("prob", (F.col("prob").between(F.col("low") - room, F.col("high") + room)).alias("within"))


@query(
    "agg10_distinct_counts",
    " union all ".join(f"select '{c}' as `column`, count(distinct {c}) as n_distinct from unit" for c in TEXTS),
    ("unit",),
)
def agg10(v: Views):
    return stats.distinct_counts(v.unit, TEXTS)


@query(
    "agg10_distinct_values",
    "select distinct localAuthority from unit where localAuthority is not null",
    ("unit",),
)
def agg10_values(v: Views):
    return stats.distinct_values(v.unit, "localAuthority")


@query(
    "agg11_density_grid",
    """with b as (select min(easting) - 500.0e0 as x0, min(northing) - 500.0e0 as y0 from unit),
        c as (select cast(floor((easting - x0) / 1000) as bigint) as ix, cast(floor((northing - y0) / 1000) as bigint) as iy,
          x0, y0 from unit, b)
        select ix, iy, x0 + (ix + 0.5e0) * 1000 as x, y0 + (iy + 0.5e0) * 1000 as y, count(*) as n
        from c group by ix, iy, x0, y0""",
    ("unit",),
)
def agg11(v: Views):
    return stats.density_grid(v.unit)


@query(
    "agg12_mean_grid",
    """with b as (select min(easting) - 5000.0e0 as x0, min(northing) - 5000.0e0 as y0 from unit),
        c as (select cast(floor((easting - x0) / 10000) as bigint) as ix,
          cast(floor((northing - y0) / 10000) as bigint) as iy, x0, y0, riskLabel from unit, b)
        select ix, iy, x0 + (ix + 0.5e0) * 10000 as x, y0 + (iy + 0.5e0) * 10000 as y, round(avg(riskLabel), 9) as mean
        from c group by ix, iy, x0, y0 having sum(riskLabel) > 0""",
    ("unit",),
)
def agg12(v: Views):
    return rounded(stats.mean_grid(v.unit), 9, "mean")


@query(
    "agg13_histogram",
    """with e as (select min(medianPrice) as low, (max(medianPrice) - min(medianPrice)) / 30 as w from unit),
        h as (select cast(least(floor((medianPrice - low) / w), 29) as bigint) as bin, count(*) as c from unit, e
          where medianPrice is not null group by 1)
        select i as bin, round(low + i * w, 6) as `from`, round(low + (i + 1) * w, 6) as `to`, coalesce(c, 0) as count
        from range(30) r(i) cross join e left join h on h.bin = i""",
    ("unit",),
)
def agg13(v: Views):
    return rounded(stats.histogram(v.unit, "medianPrice"), 6, "from", "to")


@query(
    "agg13_risk_histogram",
    """select i as bin, i + 0.5e0 as `from`, i + 1.5e0 as `to`, (select count(*) from unit where riskLabel = i + 1) as count
        from range(7) r(i)""",
    ("unit",),
)
def agg13_risk(v: Views):
    return stats.histogram(v.unit, "riskLabel", 7, 0.5, 7.5)


CORR = ["elevation", "distanceToWatercourse", "riskLabel", "medianPrice"]


@query(
    "agg14_correlation",
    " union all ".join(
        f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 9) as r from unit" for a in CORR for b in CORR
    ),
    ("unit",),
)
def agg14(v: Views):
    return rounded(stats.correlation(v.unit, CORR), 9, "r")


_LEVEL = "lev as (select * from stations where stationName <> 'Rainfall station' and latitude is not null and longitude is not null)"


@query(
    "agg15_cumulative_distribution",
    f"""with {_LEVEL} select -1 + i * 0.25e0 as at,
        round((select count(*) from lev where maxOnRecord >= -1 and maxOnRecord <= -1 + i * 0.25e0)
          * 1.0e0 / (select count(*) from lev), 9) as density from range(29) r(i)""",
    ("stations",),
)
def agg15(v: Views):
    level = split_stations(v.stations)[1]
    return rounded(stats.cumulative_distribution(level, "maxOnRecord", -1.0, 6.0, 0.25), 9, "density")


@query(
    "agg16_probability_distribution",
    f"""with {_LEVEL} select -1 + i * 0.25e0 as at,
        round((select count(*) from lev where maxOnRecord >= -1 + i * 0.25e0 - 0.125e0
          and maxOnRecord < -1 + i * 0.25e0 + 0.125e0) * 1.0e0 / (select count(*) from lev), 9) as density
        from range(29) r(i)""",
    ("stations",),
)
def agg16(v: Views):
    level = split_stations(v.stations)[1]
    return rounded(stats.probability_distribution(level, "maxOnRecord", -1.0, 6.0, 0.25), 9, "density")


@query(
    "agg17_box_summary",
    " union all ".join(
        f"""select '{c}' as `column`, round(q1, 6) as q25, round(q2, 6) as q50, round(q3, 6) as q75,
        min(case when {c} >= q1 - 1.5 * (q3 - q1) and {c} <= q3 + 1.5 * (q3 - q1) then {c} end) as whisker_low,
        max(case when {c} >= q1 - 1.5 * (q3 - q1) and {c} <= q3 + 1.5 * (q3 - q1) then {c} end) as whisker_high,
        count(*) filter ({c} < q1 - 1.5 * (q3 - q1) or {c} > q3 + 1.5 * (q3 - q1)) as outliers
        from unit, (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.5) as q2, quantile_cont({c}, 0.75) as q3
          from unit) group by q1, q2, q3"""
        for c in NUMBERS
    ),
    ("unit",),
)
def agg17(v: Views):
    return rounded(stats.box_summary(v.unit, NUMBERS), 6, "q25", "q50", "q75")


_TOTAL = " + ".join(f"`{c}`" for c in AGE_SHARES)


@query(
    "agg18_row_shares",
    "select postcodeDistrict, "
    + ", ".join(f"round(`{c}` / ({_TOTAL}), 9) as `{c}`" for c in AGE_SHARES)
    + " from district_data",
    ("district_data",),
)
def agg18(v: Views):
    df = stats.shares_of_row(v.district_data, AGE_SHARES).select("postcodeDistrict", *AGE_SHARES)
    return rounded(df, 9, *AGE_SHARES)


@query(
    "agg19_scaled_medians",
    "with m as (select "
    + ", ".join(f"median(`{c}`) as `{c}`" for c in AGE_SHARES)
    + " from district_data) select "
    + ", ".join(f"round(`{c}` / ({_TOTAL}), 9) as `{c}`" for c in AGE_SHARES)
    + " from m",
    ("district_data",),
)
def agg19(v: Views):
    return rounded(stats.scaled_medians(v.district_data, AGE_SHARES), 9, *AGE_SHARES)


@query(
    "agg20_data_contract",
    """select count(*) as n_rows, cast(1 as bigint) as missing_columns,
        (select count(*) from (select postcode from unit group by 1 having count(*) > 1)) as repeated_keys from unit""",
    ("unit",),
)
def agg20(v: Views):
    return stats.data_contract(v.unit, [*RAW_FEATURES, "not_there"])



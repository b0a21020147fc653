"""Filling missing values (deterministic methods)."""

from __future__ import annotations

from tidemark.constants import AGE_SHARES, IMPUTATION_CONSTANTS, LEVEL_FIELDS
from tidemark.operators import impute
from tidemark.operators.scaling import apply_fill, fit_fill
from tidemark.operators.selection import split_stations
from tidemark.operators.stations import fill_levels
from tidemark.plans.catalog import query
from tidemark.plans.catalog.common import KEYED, mode_sql, near_sql, rounded
from tidemark.plans.catalog.geodesy import WGS84_SQL, wgs84_sql
from tidemark.sources.views import Views

NUMBERS = ["elevation", "distanceToWatercourse"]
TEXTS = ["soilType", "nearestWatercourse", "localAuthority"]
C = IMPUTATION_CONSTANTS


def _postcode_sql() -> str:
    ctes = [
        f"l as (select {KEYED} from labelled)",
        f"u as (select {KEYED} from unlabelled)",
        "cl as (select * from l where soilType is not null and nearestWatercourse is not null and localAuthority is not null)",
    ]
    joins, cols = "", ["u.k", "u.postcode", "u.postcodeSector", "u.postcodeDistrict"]
    for short, key in (("s", "postcodeSector"), ("d", "postcodeDistrict")):
        meds = ", ".join(f"median({c}) as {c}" for c in NUMBERS)
        ctes.append(f"num_{short} as (select {key}, {meds} from l group by {key})")
        joins += f" left join num_{short} on u.{key} = num_{short}.{key}"
        for c in TEXTS:
            ctes.append(mode_sql(f"{c}_{short}", "cl", c, key).strip())
            joins += f" left join {c}_{short} on u.{key} = {c}_{short}.{key}"
    cols += [f"coalesce(u.{c}, num_s.{c}, num_d.{c}, (select median({c}) from l)) as {c}" for c in NUMBERS]
    cols += [f"coalesce(u.{c}, {c}_s.{c}, {c}_d.{c}, '{C[c]}') as {c}" for c in TEXTS]
    return "with " + ",\n".join(ctes) + " select " + ", ".join(cols) + " from u" + joins


@query("imp1_by_postcode", _postcode_sql(), ("labelled", "unlabelled"))
def imp1(v: Views):
    return impute.by_postcode(v.unlabelled, v.labelled).drop("easting", "northing")


def _knn_sql() -> str:
    meds = ", ".join(f"median({c}) as {c}" for c in NUMBERS)
    ctes = [
        "q as (select postcode as qid, easting, northing from unlabelled)",
        "r as (select postcode, easting, northing, soilType, elevation, nearestWatercourse, distanceToWatercourse,"
        " localAuthority from labelled)",
        near_sql("near", "q", "r", 5).strip(),
        f"num as (select qid, {meds} from near group by qid)",
    ]
    joins = " left join num on u.postcode = num.qid"
    for c in TEXTS:
        ctes.append(mode_sql(f"m_{c}", "near", c, "qid").strip())
        joins += f" left join m_{c} on u.postcode = m_{c}.qid"
    cols = ["u.k", "u.postcode"]
    cols += [f"coalesce(u.{c}, num.{c}, (select median({c}) from labelled)) as {c}" for c in NUMBERS]
    cols += [f"coalesce(u.{c}, m_{c}.{c}, '{C[c]}') as {c}" for c in TEXTS]
    return "with " + ",\n".join(ctes) + " select " + ", ".join(cols) + " from unlabelled u" + joins


@query("imp2_by_neighbours", _knn_sql(), ("labelled", "unlabelled"))
def imp2(v: Views):
    return impute.by_neighbours(v.unlabelled, v.labelled).select("k", "postcode", *NUMBERS, *TEXTS)


@query(
    "imp3_by_constant",
    f"""select k, postcode, coalesce(soilType, '{C["soilType"]}') as soilType, coalesce(elevation, 60.0e0) as elevation,
        coalesce(nearestWatercourse, 'Unknown') as nearestWatercourse,
        coalesce(distanceToWatercourse, 80.0e0) as distanceToWatercourse,
        coalesce(localAuthority, 'Unknown') as localAuthority from unlabelled""",
    ("unlabelled",),
)
def imp3(v: Views):
    return impute.by_constant(v.unlabelled).drop("easting", "northing")


_LEVEL = """lev as (select * from stations where stationName <> 'Rainfall station' and latitude is not null and longitude is not null),
full_rows as (select * from lev where maxOnRecord is not null and minOnRecord is not null and typicalRangeHigh is not null
  and typicalRangeLow is not null and stationReference is not null),
fixed as (select case when maxOnRecord < typicalRangeHigh then typicalRangeHigh else maxOnRecord end as maxOnRecord,
  case when minOnRecord > typicalRangeLow then typicalRangeLow else minOnRecord end as minOnRecord,
  case when typicalRangeHigh < typicalRangeLow then typicalRangeLow else typicalRangeHigh end as typicalRangeHigh,
  typicalRangeLow from full_rows)"""


@query(
    "imp5_fill_levels",
    f"with {_LEVEL} select stationReference, "
    + ", ".join(f"coalesce({c}, (select median({c}) from fixed)) as {c}" for c in LEVEL_FIELDS)
    + " from lev",
    ("stations",),
)
def imp5(v: Views):
    return fill_levels(split_stations(v.stations)[1]).select("stationReference", *LEVEL_FIELDS)


_TOTAL = " + ".join(f"`{c}`" for c in AGE_SHARES)


@query(
    "imp6_district_shares",
    "with m as (select "
    + ", ".join(f"median(`{c}`) as `{c}`" for c in AGE_SHARES)
    + f" from district_data), t as (select {_TOTAL} as total from m) select postcodeDistrict, "
    + ", ".join(f"round(coalesce(d.`{c}`, m.`{c}` / total), 9) as `{c}`" for c in AGE_SHARES)
    + " from district_data d, m, t",
    ("district_data",),
)
def imp6(v: Views):
    return rounded(impute.district_shares(v.district_data).select("postcodeDistrict", *AGE_SHARES), 9, *AGE_SHARES)


@query(
    "imp7_self_neighbours",
    f"""with q as (select postcode as qid, easting, northing from unit where elevation is null),
        r as (select postcode, easting, northing, elevation from unit where elevation is not null),
        {near_sql("near", "q", "r", 5)},
        fill as (select qid, avg(elevation) as elevation from near group by qid),
        qt as (select postcode as qid, easting, northing from unit where soilType is null),
        rt as (select postcode, easting, northing, soilType from unit),
        {near_sql("neart", "qt", "rt", 5)}, {mode_sql("pick", "neart", "soilType", "qid")}, {mode_sql("top", "unit", "soilType")}
        select u.k, u.postcode, round(coalesce(u.elevation, f.elevation), 9) as elevation,
          coalesce(u.soilType, p.soilType, (select soilType from top)) as soilType
        from unit u left join fill f on u.postcode = f.qid left join pick p on u.postcode = p.qid""",
    ("unit",),
)
def imp7(v: Views):
    df = v.unit.select("k", "postcode", "easting", "northing", "elevation", "soilType")
    filled = impute.within_table_by_neighbours(df, ["elevation"], ["soilType"])
    return rounded(filled.select("k", "postcode", "elevation", "soilType"), 9, "elevation")


@query(
    "imp8_simple_imputer",
    f"""with {mode_sql("m", "labelled", "soilType")}
        select k, coalesce(elevation, (select median(elevation) from labelled)) as elevation,
          coalesce(soilType, (select soilType from m)) as soilType from unlabelled""",
    ("labelled", "unlabelled"),
)
def imp8(v: Views):
    values = fit_fill(v.labelled, ["elevation", "soilType"])
    return apply_fill(v.unlabelled.select("k", "elevation", "soilType"), values)


@query(
    "imp9_adapt_bare_units",
    f"""with {wgs84_sql("labelled")}
        select o.k, o.postcode, split_part(o.postcode, ' ', 1) as postcodeDistrict, d.catsPerHousehold,
          round(o.latitude, 8) as latitude, round(o.longitude, 8) as longitude,
          coalesce(o.medianPrice, (select median(medianPrice) from labelled)) as medianPrice,
          0 as historicallyFlooded, coalesce(o.distanceToWatercourse, 0) as distanceToWatercourse,
          coalesce(o.elevation, 0) as elevation
        from {WGS84_SQL} o left join district_data d on split_part(o.postcode, ' ', 1) = d.postcodeDistrict""",
    ("labelled", "district_data"),
)
def imp9(v: Views):
    df = impute.adapt_bare_units(v.labelled, v.district_data)
    df = rounded(df, 8, "latitude", "longitude")
    return df.select(
        "k",
        "postcode",
        "postcodeDistrict",
        "catsPerHousehold",
        "latitude",
        "longitude",
        "medianPrice",
        "historicallyFlooded",
        "distanceToWatercourse",
        "elevation",
    )



"""Feature scaling, encoding, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.quantiles import modes
from tidemark.operators.ranking import hash_split, stratified_folds
from tidemark.operators.scaling import label_codes, min_max, one_hot, robust, standardise
from tidemark.plans.catalog import query
from tidemark.plans.catalog.common import mode_sql, rounded
from tidemark.plans.dictionary import hot_places, one_hot_vectors
from tidemark.plans.features import feature_stages
from tidemark.sources.views import Views

HASH = "(('0x' || substr(md5(postcode || ':42'), 1, 12))::bigint % 1000003)"


@query(
    "pre1_standardise",
    """select k, round((elevation - (select avg(elevation) from unit)) / (select stddev_pop(elevation) from unit), 9) as elevation,
         (flat - 1) * 1.0e0 as flat from (select *, 1.0e0 as flat from unit)""",
    ("unit",),
)
def pre1(v: Views):
    df = v.unit.select("k", "elevation", F.lit(1.0).alias("flat"))
    return rounded(standardise(df, ["elevation", "flat"]), 9, "elevation")


@query(
    "pre2_min_max",
    """select k, round((distanceToWatercourse - lo) / (hi - lo), 9) as distanceToWatercourse, 0.0e0 as flat from unit,
         (select min(distanceToWatercourse) as lo, max(distanceToWatercourse) as hi from unit)""",
    ("unit",),
)
def pre2(v: Views):
    df = v.unit.select("k", "distanceToWatercourse", F.lit(5.0).alias("flat"))
    return rounded(min_max(df, ["distanceToWatercourse", "flat"]), 9, "distanceToWatercourse")


@query(
    "pre3_robust",
    """select k, round((medianPrice - q2) / (q3 - q1), 9) as medianPrice from unit, (select quantile_cont(medianPrice, 0.25) as q1,
         quantile_cont(medianPrice, 0.5) as q2, quantile_cont(medianPrice, 0.75) as q3 from unit)""",
    ("unit",),
)
def pre3(v: Views):
    return rounded(robust(v.unit.select("k", "medianPrice"), ["medianPrice"]), 9, "medianPrice")


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(
    "pre4_one_hot",
    "select k, "
    + ", ".join(f"case when soilType = '{s}' then 1 else 0 end as soil_{s}" for s in SEGMENTS)
    + " from unit",
    ("unit",),
)
def pre4(v: Views):
    table = v.unit.select("k", "soilType")
    return one_hot(table, "soilType", SEGMENTS, "soil_").drop("soilType")


@query(
    "pre4_one_hot_vectors",
    """select u.k, c.n as size, coalesce(c.code, -1) as place from unit u left join (
         select postcode, cast(row_number() over (order by postcode) - 1 as int) as code, cast(count(*) over () as int) as n
         from (select distinct postcode from unit where postcode is not null)) c on u.postcode = c.postcode""",
    ("unit",),
)
def pre4_vectors(v: Views):
    """As many categories as there are postcodes."""
    return hot_places(one_hot_vectors(v.unit.select("k", "postcode"), "postcode", "v"), "v").select("k", "size", "place")


@query(
    "pre5_label_codes",
    """select u.k, u.localAuthority, c.code from unit u left join (select localAuthority,
         cast(dense_rank() over (order by localAuthority) - 1 as int) as code
         from (select distinct localAuthority from unit where localAuthority is not null)) c
       on u.localAuthority = c.localAuthority""",
    ("unit",),
)
def pre5(v: Views):
    return label_codes(v.unit.select("k", "localAuthority"), "localAuthority", "code")


@query(
    "pre6_train_validation_test",
    f"select k, case when {HASH} % 100 < 81 then 'train' when {HASH} % 100 < 90 then 'validation' else 'test' end as split from unit",
    ("unit",),
)
def pre6(v: Views):
    return hash_split(v.unit.select("k", "postcode"), "postcode", {"train": 81, "validation": 9, "test": 10}).drop("postcode")


@query(
    "pre7_stratified_folds",
    f"""select k, riskLabel, cast((row_number() over (partition by riskLabel order by {HASH}, postcode) - 1) % 5 as int) as fold
        from unit""",
    ("unit",),
)
def pre7(v: Views):
    return stratified_folds(v.unit.select("k", "postcode", "riskLabel"), "riskLabel", "postcode").drop("postcode")


@query(
    "udx2_row_rule_in_pipeline",
    """select k, coalesce(nearestWatercourse, case when distanceToWatercourse < 2000 then 'UnknownNearbyWatercourse'
         else 'NoWatercourse' end) as f_nearestWatercourse from unit""",
    ("unit",),
)
def udx2(v: Views):
    """The watercourse rule as a saved pipeline stage."""
    stage = feature_stages(v.unit, categorical=["nearestWatercourse"], guess_watercourse=True)[0]
    return stage.transform(v.unit).select("k", "f_nearestWatercourse")


@query(
    "udx3_mode_aggregate",
    f"with {mode_sql('m', 'unit', 'soilType', 'riskLabel')} select * from m",
    ("unit",),
)
def udx3(v: Views):
    return modes(v.unit, ["soilType"], ["riskLabel"])


@query(
    "udx4_column_step_in_pipeline",
    """select k, round((elevation - (select avg(coalesce(elevation, m)) from unit, (select median(elevation) as m from unit)))
         / (select stddev_pop(coalesce(elevation, m)) from unit, (select median(elevation) as m from unit)), 9) as f_elevation
       from unit where elevation is not null""",
    ("unit",),
)
def udx4(v: Views):
    """Columns are dropped before, and features made inside, one SQL stage."""
    table = v.unit.drop("medianPrice", "riskLabel", "not_there")
    stage = feature_stages(table, standard=["elevation"])[0]
    made = stage.transform(table).where("elevation is not null").select("k", "f_elevation")
    return rounded(made, 9, "f_elevation")

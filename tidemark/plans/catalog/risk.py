"""Property value, expected loss and high-risk selections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.location import knn_risk, minimum_risk
from tidemark.operators.risk import economic_risk, high_risk_near, human_risk, total_value
from tidemark.plans.catalog import query
from tidemark.plans.catalog.common import REQUESTS, SECTOR, requests, rounded
from tidemark.plans.catalog.scalars import PROBABILITY
from tidemark.plans.catalog.spatial import risk_sql
from tidemark.sources.views import Views

VALUE = """coalesce(u.medianPrice, 0) * coalesce(s.households, 0)"""
JOINED = f"""from requests r left join unit u on r.postcode = u.postcode
  left join sector_data s on {SECTOR.replace("postcode", "r.postcode")} = s.postcodeSector"""


@query(
    "rsk1_total_value",
    f"with {REQUESTS} select r.ord, r.postcode, {VALUE} as total_property_value {JOINED}",
    ("unit", "sector_data"),
)
def rsk1(v: Views):
    return total_value(requests(v), v.unit, v.sector_data)


@query(
    "rsk2_human_risk",
    f"""with {REQUESTS} select r.ord, r.postcode,
        round(0.1e0 * coalesce(s.headcount, 0) * {PROBABILITY}, 9) as annual_human_flood_risk {JOINED}""",
    ("unit", "sector_data"),
)
def rsk2(v: Views):
    return rounded(human_risk(requests(v), v.unit, v.sector_data), 9, "annual_human_flood_risk")


@query(
    "rsk2_human_risk_default_class",
    f"""with {REQUESTS} select r.ord, r.postcode,
        round(0.1e0 * coalesce(s.headcount, 0) * 0.001e0, 9) as annual_human_flood_risk {JOINED}""",
    ("unit", "sector_data"),
)
def rsk2_default(v: Views):
    asked = requests(v)
    return rounded(
        human_risk(asked, minimum_risk(asked.select("postcode").distinct()), v.sector_data), 9, "annual_human_flood_risk"
    )


@query(
    "rsk3_economic_risk",
    f"""with {REQUESTS} select r.ord, r.postcode,
        round(0.05e0 * {VALUE} * {PROBABILITY}, 6) as annual_economic_flood_risk {JOINED}""",
    ("unit", "sector_data"),
)
def rsk3(v: Views):
    return rounded(
        economic_risk(requests(v), v.unit, v.unit, v.sector_data), 6, "annual_economic_flood_risk"
    )


@query(
    "flt8_high_risk_near_watercourses",
    f"""with q as (select postcode as qid, easting, northing from unlabelled), {risk_sql("q")}
        select u.*, risk.riskLabel from unlabelled u join risk on u.postcode = risk.qid
        where risk.riskLabel > 2 and u.nearestWatercourse in ('River 1', 'River 4', 'River 7') and u.k % 3 <> 0""",
    ("labelled", "unlabelled"),
)
def flt8(v: Views):
    near = v.unlabelled.select(F.col("postcode").alias("qid"), "easting", "northing")
    risks = knn_risk(near, v.labelled, "qid").withColumnRenamed("qid", "postcode")
    wanted = v.unlabelled.where("k % 3 <> 0").select("postcode")
    return high_risk_near(v.unlabelled, risks, ["River 1", "River 4", "River 7"], wanted, risk_above=2)


@query(
    "flt8_high_risk_by_label",
    """select k, postcode, nearestWatercourse, riskLabel from unit where riskLabel > 4
       and nearestWatercourse in ('River 1', 'River 4', 'River 7')""",
    ("unit",),
)
def flt8_label(v: Views):
    units = v.unit.select("k", "postcode", "nearestWatercourse")
    return high_risk_near(units, v.unit, ["River 1", "River 4", "River 7"])

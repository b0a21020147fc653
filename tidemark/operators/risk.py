"""Property value, expected annual loss, and high-risk selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import ECONOMIC_RISK_FACTOR, HUMAN_RISK_FACTOR
from tidemark.functions.numeric import flood_probability
from tidemark.functions.postcode import postcode_sector
from tidemark.operators.ranking import unique_per


def _or_zero(column: Column) -> Column:
    return F.coalesce(column.cast("double"), F.lit(0.0))


def total_value(requests: DataFrame, units: DataFrame, sectors: DataFrame) -> DataFrame:
    """Median price of the postcode times households of its sector; unknown counts as zero.

    ``requests`` needs a ``postcode`` column and keeps its other columns. One
    row comes out per row that goes in: of repeated units and sectors the smallest figure counts.
    """
    return _valued(requests.join(_per_postcode(units, "medianPrice", "_price"), "postcode", "left"), sectors)


def _per_postcode(df: DataFrame, col: str, name: str) -> DataFrame:
    return unique_per(df, "postcode", [col]).withColumnRenamed(col, name)


def _per_sector(sectors: DataFrame, col: str, name: str) -> DataFrame:
    return unique_per(sectors, "postcodeSector", [col]).withColumnsRenamed({"postcodeSector": "_sector", col: name})


def _valued(priced: DataFrame, sectors: DataFrame) -> DataFrame:
    return (
        priced.withColumn("_sector", postcode_sector(F.col("postcode")))
        .join(_per_sector(sectors, "households", "_homes"), "_sector", "left")
        .withColumn("total_property_value", _or_zero(F.col("_price")) * _or_zero(F.col("_homes")))
        .drop("_sector", "_price", "_homes")
    )


def human_risk(requests: DataFrame, risks: DataFrame, sectors: DataFrame) -> DataFrame:
    """Expected people affected per year: 0.1 x headcount x flood probability.

    One row per request, however often ``risks`` repeats a postcode: the smallest label counts.
    """
    people, labels = _per_sector(sectors, "headcount", "_people"), _per_postcode(risks, "riskLabel", "_risk")
    value = F.lit(HUMAN_RISK_FACTOR) * _or_zero(F.col("_people")) * flood_probability(F.col("_risk"))
    return (
        requests.withColumn("_sector", postcode_sector(F.col("postcode")))
        .join(people, "_sector", "left")
        .join(labels, "postcode", "left")
        .withColumn("annual_human_flood_risk", value)
        .drop("_sector", "_people", "_risk")
    )


def economic_risk(requests: DataFrame, risks: DataFrame, units: DataFrame, sectors: DataFrame) -> DataFrame:
    """Expected loss per year: 0.05 x property value x flood probability; one row per request, as the others."""
    labels, prices = _per_postcode(risks, "riskLabel", "_risk"), _per_postcode(units, "medianPrice", "_price")
    value = F.lit(ECONOMIC_RISK_FACTOR) * F.col("total_property_value") * flood_probability(F.col("_risk"))
    return (
        _valued(requests.join(prices, "postcode", "left").join(labels, "postcode", "left"), sectors)
        .withColumn("annual_economic_flood_risk", value)
        .drop("_risk", "total_property_value")
    )


def high_risk_near(
    units: DataFrame,
    risks: DataFrame,
    watercourses: Sequence[str],
    postcodes: DataFrame | None = None,
    risk_above: int = 4,
) -> DataFrame:
    """Units near the named watercourses whose predicted class exceeds a bound."""
    if postcodes is not None:
        units = units.join(postcodes.select("postcode"), "postcode", "left_semi")
    near = units.where(F.col("nearestWatercourse").isin(list(watercourses)))
    risky = risks.select("postcode", "riskLabel").where(F.col("riskLabel") > risk_above)
    return near.drop("riskLabel").join(risky, "postcode").select(
        *[c for c in units.columns if c != "riskLabel"], "riskLabel"
    )

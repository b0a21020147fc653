"""Predictions for places, by nearest neighbours or baseline values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import ENGLAND_MEDIAN_PRICE, MINIMUM_RISK_CLASS
from tidemark.functions.geodesy import add_osgb36
from tidemark.functions.numeric import nearest_class
from tidemark.operators.knn import distance_weighted, nearest, vote
from tidemark.operators.quantiles import modes, scalars
from tidemark.operators.ranking import keyed_hash

AUTHORITY_NEIGHBOURS = 5
RISK_NEIGHBOURS = 15


def minimum_risk(df: DataFrame) -> DataFrame:
    return df.withColumn("riskLabel", F.lit(MINIMUM_RISK_CLASS))


def england_median_price(df: DataFrame) -> DataFrame:
    return df.withColumn("medianPrice", F.lit(ENGLAND_MEDIAN_PRICE))


def never_flooded(df: DataFrame) -> DataFrame:
    return df.withColumn("historicallyFlooded", F.lit(False))


def coin_flip(key: Column, seed: int = 42) -> Column:
    """Fair, seeded, partition-independent coin per key."""
    return F.pmod(keyed_hash(key, seed), F.lit(2)) == 1


def modal_authority(df: DataFrame, units: DataFrame) -> DataFrame:
    """Every location gets the most frequent authority."""
    value = scalars(modes(units, ["localAuthority"]))["localAuthority"]
    return df.withColumn("localAuthority", F.lit(value))


def knn_authority(queries: DataFrame, units: DataFrame, query_id: str, k: int = AUTHORITY_NEIGHBOURS) -> DataFrame:
    """Majority authority of the nearest units that have one."""
    reference = units.where(F.col("localAuthority").isNotNull()).select(
        "postcode", "easting", "northing", "localAuthority"
    )
    return vote(nearest(queries, reference, k, query_id, "postcode"), query_id, "localAuthority", "localAuthority")


def knn_risk(queries: DataFrame, units: DataFrame, query_id: str, k: int = RISK_NEIGHBOURS) -> DataFrame:
    """Class of the inverse-distance mean risk of the nearest units that have one."""
    reference = units.where(F.col("riskLabel").isNotNull()).select("postcode", "easting", "northing", "riskLabel")
    near = nearest(queries, reference, k, query_id, "postcode")
    mean = distance_weighted(near, query_id, "riskLabel", "_mean")
    return mean.select(query_id, nearest_class(F.col("_mean")).alias("riskLabel"))


def place_facts(points: DataFrame, units: DataFrame, query_id: str) -> DataFrame:
    """Authority and risk class of WGS84 points."""
    located = add_osgb36(points).select(query_id, "easting", "northing")
    return knn_authority(located, units, query_id).join(knn_risk(located, units, query_id), query_id)


def risk_surface(units: DataFrame, step: float, k: int = RISK_NEIGHBOURS) -> DataFrame:
    """Predicted class on a regular lattice over the extent of the units."""
    box = units.agg(F.min("easting"), F.max("easting"), F.min("northing"), F.max("northing")).first()
    wide, tall = int((box[1] - box[0]) // step) + 1, int((box[3] - box[2]) // step) + 1
    lattice = units.sparkSession.range(wide * tall).select(
        F.col("id").alias("cell"),
        (F.lit(float(box[0])) + F.pmod("id", F.lit(wide)) * step).alias("easting"),
        (F.lit(float(box[2])) + F.floor(F.col("id") / wide) * step).alias("northing"),
    )
    return lattice.join(knn_risk(lattice, units, "cell", k), "cell").drop("cell")

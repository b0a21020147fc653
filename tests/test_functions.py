"""Column functions against published samples and anchors."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import geodesy as g
from tidemark.functions import numeric as n
from tidemark.functions import postcode as p
from tidemark.functions import readings as r

# Fixed samples: raw postcode, canonical, easting, northing, longitude, latitude.
SAMPLES = [
    ("po9 5ea", "PO9 5EA", 472101, 108419, -0.9767079270270949, 50.87078496260512),
    ("Ex15 3XE", "EX15 3XE", 313905, 113519, -3.226066331931104, 50.914689234812535),
    ("PO144RJ", "PO14 4RJ", 452325, 106646, -1.257977327630973, 50.856967458854015),
    ("SE24  9UX", "SE24 9UX", 532008, 174437, -0.1015174307625329, 51.45353334705452),
    ("PL2  2YZ", "PL2 2YZ", 250353, 53862, -4.105463426161191, 50.365583256976805),
    ("gu222ws", "GU22 2WS", 500739, 158609, -0.5558513608932856, 51.317680351954664),
    ("SN8_1EA", "SN8 1EA", 418847, 169121, -1.7303463407141855, 51.42079140377911),
    ("SE2-0XP", "SE2 0XP", 546019, 177982, 0.10145492034363958, 51.48195006405635),
    ("RG12+1NB", "RG12 1NB", 486242, 169497, -0.7611787652462114, 51.41793821727472),
    (" SO1 8BJ", "SO1 8BJ", 438705, 115550, -1.450527450147218, 50.93810139768308),
]


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame(
        SAMPLES, "raw string, canonical string, easting bigint, northing bigint, lon double, lat double"
    )


def test_postcodes(samples):
    raw = F.col("raw")
    rows = samples.select(
        "canonical",
        p.canonical_postcode(raw).alias("got"),
        p.postcode_sector(raw).alias("sector"),
        p.postcode_district(raw).alias("district"),
    ).collect()
    for row in rows:
        assert row["got"] == row["canonical"]
        assert row["sector"] == row["canonical"][:-2]
        assert row["district"] == row["canonical"].split()[0]


def test_odd_postcodes(spark):
    cases = {"SW1A1AA ": "SW1A 1AA", "sw7 2az": "SW7 2AZ", "SW7  2AZ": "SW7 2AZ", "ab": None, None: None, "": None}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "raw string, want string")
    for row in df.select("want", p.canonical_postcode(F.col("raw")).alias("got")).collect():
        assert row["got"] == row["want"]


def test_samples_convert_both_ways(samples):
    df = g.add_wgs84(samples)
    df = g.add_osgb36(df, easting="e", northing="n")
    for row in df.collect():
        assert abs(row["latitude"] - row["lat"]) < 1e-11
        assert abs(row["longitude"] - row["lon"]) < 1e-11
        assert abs(row["e"] - row["easting"]) < 0.01 and abs(row["n"] - row["northing"]) < 0.01


def test_arrow_form_agrees(samples):
    place = g.wgs84_of(F.col("easting"), F.col("northing"))
    for row in g.add_wgs84(samples).withColumn("w", place).collect():
        assert abs(row["w"]["latitude"] - row["latitude"]) < 1e-11
        assert abs(row["w"]["longitude"] - row["longitude"]) < 1e-11


def test_anchor_points(spark):
    df = spark.createDataFrame([(55.5, -1.54)], "latitude double, longitude double")
    row = g.add_osgb36(df, whole=True).first()
    assert (row["easting"], row["northing"]) == (429157, 623009)
    radians = df.select(F.radians("latitude").alias("latitude"), F.radians("longitude").alias("longitude"))
    row = g.add_osgb36(radians, radians=True).first()
    assert math.isclose(row["easting"], 429157.545, abs_tol=1e-3)
    df = spark.createDataFrame([(422297.8, 412878.7)], "easting double, northing double")
    row = g.add_wgs84(df).first()
    assert math.isclose(row["latitude"], 53.612, rel_tol=1e-3) and math.isclose(row["longitude"], -1.664, rel_tol=1e-3)


def test_missing_coordinates_stay_missing_and_alone(spark):
    df = spark.createDataFrame([(1, None, None), (2, 472101.0, 108419.0)], "id int, easting double, northing double")
    rows = {row["id"]: row for row in g.add_wgs84(df).collect()}
    assert rows[1]["latitude"] is None
    assert abs(rows[2]["latitude"] - 50.87078496260512) < 1e-11


def test_filter_on_coordinates_keeps_plan_small(samples):
    plan = g.add_wgs84(samples).where("latitude > 51 and longitude < 0")._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 60_000
    assert g.add_wgs84(samples).where("latitude > 51.4").count() == 4


def test_angles(spark):
    row = spark.range(1).select(
        n.dms_to_radians(F.lit(90), F.lit(0), F.lit(0)).alias("r"),
        n.radians_to_dms(F.radians(F.lit(-1.51))).alias("d"),
    ).first()
    assert math.isclose(row["r"], math.pi / 2)
    assert (row["d"]["degrees"], row["d"]["minutes"], row["d"]["seconds"]) == (-2, 29, 24.0)


def test_readings(spark):
    df = spark.createDataFrame([("1.5",), ("0.2|0.4",), ("bad",), (None,), ("nan",), ("x|1",)], "v string")
    assert [row[0] for row in df.select(r.clean_value(F.col("v"))).collect()] == [1.5, 0.2, None, None, None, None]
    url = "http://x/id/measures/0184TH-rainfall-tipping_bucket_raingauge-t-15_min-mm/2025-01-01T00-00-00Z"
    m = F.lit(url)
    row = spark.range(1).select(
        r.measure_station(m).alias("s"), r.tidy_qualifier(r.measure_qualifier(m)).alias("q"), r.measure_unit(m).alias("u")
    ).first()
    assert tuple(row) == ("0184TH", "Tipping Bucket Raingauge", "mm")


def test_numbers(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (None,)], "x double")
    assert [row[0] for row in df.select(n.nearest_class(F.col("x"))).collect()] == [0, 2, 2, None]
    low, high = F.lit(1.0), F.lit(2.0)
    assert [row[0] for row in df.select(n.clamp(F.col("x"), low, high)).collect()] == [1.0, 1.5, 2.0, None]
    probabilities = spark.createDataFrame([(7,), (1,), (9,), (None,)], "c int").select(n.flood_probability(F.col("c")))
    assert [row[0] for row in probabilities.collect()] == [0.05, 0.001, 0.0, 0.0]


def test_careless_postcodes(spark):
    from tidemark.functions.postcode import canonical_postcode, postcode_district, postcode_sector

    samples = {
        "po9 5ea": ("PO9 5EA", "PO9 5", "PO9"),
        "Ex15 3XE": ("EX15 3XE", "EX15 3", "EX15"),
        "PO144RJ": ("PO14 4RJ", "PO14 4", "PO14"),
        "SE24  9UX": ("SE24 9UX", "SE24 9", "SE24"),
        "gu222ws": ("GU22 2WS", "GU22 2", "GU22"),
        "SN8_1EA": ("SN8 1EA", "SN8 1", "SN8"),
        "SE2-0XP": ("SE2 0XP", "SE2 0", "SE2"),
        "RG12+1NB": ("RG12 1NB", "RG12 1", "RG12"),
        " SO1 8BJ": ("SO1 8BJ", "SO1 8", "SO1"),
        "SW1A1AA ": ("SW1A 1AA", "SW1A 1", "SW1A"),
    }
    raw = F.col("raw")
    df = spark.createDataFrame([(k,) for k in samples], "raw string")
    got = df.select("raw", canonical_postcode(raw), postcode_sector(raw), postcode_district(raw)).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == samples

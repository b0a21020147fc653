"""The engine's answers: shape, order, constants, model quality."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.functions.geodesy import add_osgb36, add_wgs84
from tidemark.operators.evaluate import accuracy, binary_metrics, class_score
from tidemark.operators.impute import by_postcode
from tidemark.operators.stations import prepare_stations
from tidemark.plans import models as m
from tidemark.plans.engine import NotFitted, RiskEngine
from tidemark.session import materialize


@pytest.fixture(scope="module")
def engine(views):
    prepared = materialize(add_wgs84(by_postcode(views.labelled, views.labelled)).drop("k"), "prepared")
    rainfall, level = prepare_stations(views.stations)
    return RiskEngine(
        views.labelled.drop("k"),
        views.sector_data,
        views.district_data,
        unlabelled=views.unlabelled.drop("k"),
        prepared_units=prepared,
        rainfall_stations=rainfall,
        level_stations=level,
        forest=m.ForestSize(trees=8, depth=8),
        boosting={"rounds": 5, "depth": 3},
    )


@pytest.fixture(scope="module")
def some(views):
    return [row["postcode"] for row in views.unit.orderBy("k").limit(4).collect()]


def test_lookup_keeps_order_and_copies(engine, some, views):
    asked = [some[2], "ZZ99 9ZZ", some[0], some[2]]
    rows = engine.lookup_easting_northing(asked).collect()
    assert [row["postcode"] for row in rows] == asked
    assert rows[1]["easting"] is None and rows[0]["easting"] == rows[3]["easting"]
    places = engine.lookup_lat_long(asked).collect()
    assert [row["postcode"] for row in places] == asked
    assert places[1]["latitude"] is None and 49 < places[0]["latitude"] < 61


def test_postcode_parts(engine):
    row = engine.get_postcode_district_sector(["m347ql"]).first()
    assert (row["postcode"], row["postcodeSector"], row["postcodeDistrict"]) == ("M34 7QL", "M34 7", "M34")


def test_baselines(engine, some):
    asked = some[:3]
    assert [r["riskLabel"] for r in engine.predict_flood_class_from_postcode(asked).collect()] == [1, 1, 1]
    assert [r["medianPrice"] for r in engine.predict_median_house_price(asked).collect()] == [245000.0] * 3
    assert [r["historicallyFlooded"] for r in engine.predict_historic_flooding(asked).collect()] == [False] * 3
    places = [(374999, 165441), (535295, 123643)]
    assert [r["riskLabel"] for r in engine.predict_flood_class_from_OSGB36_location(places).collect()] == [1, 1]
    assert [r["riskLabel"] for r in engine.predict_flood_class_from_WGS84_locations([(-1.5, 51.0)]).collect()] == [1]


def test_modal_authority(spark):
    schema = "postcode string, easting int, northing int, soilType string, elevation double, nearestWatercourse string, distanceToWatercourse double, localAuthority string"
    rows = [(f"A{i} 1AA", i, i, None, None, None, None, f"Authority{a}") for i, a in enumerate("ABAA")]
    e = RiskEngine(spark.createDataFrame(rows, schema)).fit_to_data("modal_local_authority")
    assert [r["localAuthority"] for r in e.predict_local_authority([(1, 2), (3, 4)]).collect()] == ["AuthorityA"] * 2


def test_unfitted_and_unknown_models(engine, some):
    with pytest.raises(ValueError):
        engine.fit_to_data("nonsense")
    fresh = RiskEngine(engine.units)
    with pytest.raises(NotFitted):
        fresh.predict_flood_class_from_postcode(some, "seven_class_tool")
    with pytest.raises(NotImplementedError):
        fresh.predict_flood_class_from_postcode(some, "nonsense")


def test_added_model(engine, some):
    m.register_model("house_price", "flat", "Flat price", lambda e: lambda asked: asked.withColumn("medianPrice", F.lit(1.0)))
    rows = engine.fit_to_data("flat").predict_median_house_price(some, "flat").collect()
    assert {row["medianPrice"] for row in rows} == {1.0}


def test_added_models_of_one_key_stay_with_their_tasks(engine, some):
    m.register_model("house_price", "same", "Price", lambda e: lambda asked: asked.withColumn("medianPrice", F.lit(2.0)))
    m.register_model("flood_class_from_postcode", "same", "Class", lambda e: lambda asked: asked.withColumn("riskLabel", F.lit(3)))
    try:
        engine.fit_to_data("same")
        assert {r["medianPrice"] for r in engine.predict_median_house_price(some, "same").collect()} == {2.0}
        assert {r["riskLabel"] for r in engine.predict_flood_class_from_postcode(some, "same").collect()} == {3}
    finally:
        m.unregister_model("house_price", "same")
        m.unregister_model("flood_class_from_postcode", "same")


def test_neighbour_models(engine):
    engine.fit_to_data("knn")
    places = [(r["easting"], r["northing"]) for r in engine.units.orderBy("postcode").limit(3).collect()]
    truth = [r["riskLabel"] for r in engine.units.orderBy("postcode").limit(3).collect()]
    # Exactly on a known unit only that unit counts.
    got = engine.predict_flood_class_from_OSGB36_location(places, "knn").orderBy("ord").collect()
    assert [r["riskLabel"] for r in got] == truth
    assert engine.predict_local_authority(places, "knn").where("localAuthority is null").count() == 0


def test_seven_class_forest_beats_the_constant(engine, views):
    engine.fit_to_data("seven_class_tool")
    asked = engine.units.select(F.monotonically_increasing_id().alias("ord"), "postcode", F.col("riskLabel").alias("truth"))
    asked = materialize(asked, "asked")
    got = engine.predict_flood_class_from_postcode(asked, "seven_class_tool")
    assert got.count() == asked.count()
    constant = engine.predict_flood_class_from_postcode(asked)
    best = class_score(got, "truth", "riskLabel").first()["mean_score"]
    assert best > class_score(constant, "truth", "riskLabel").first()["mean_score"]
    again = engine.predict_flood_class_from_postcode(asked, "seven_class_tool")
    assert got.exceptAll(again).isEmpty()
    places = engine.predict_flood_class_from_OSGB36_location([(110000, 60000)], "seven_class_tool").collect()
    assert len(places) == 1 and places[0]["riskLabel"] in range(1, 8)
    assert accuracy(got, "truth", "riskLabel").first()["n"] == asked.count()


def test_historic_forest(engine):
    engine.fit_to_data("historic_rf")
    asked = engine.units.select(F.monotonically_increasing_id().alias("ord"), "postcode", "historicallyFlooded")
    got = engine.predict_historic_flooding(asked, "historic_rf").cache()
    facts = binary_metrics(got, "historicallyFlooded", "predictedHistoricFlooded").first()
    floods = got.where("historicallyFlooded = 1").count()
    assert facts["accuracy"] >= 1 - floods / got.count() - 0.1
    stranger = engine.predict_historic_flooding(["ZZ1 1ZZ"], "historic_rf").collect()
    assert len(stranger) == 1 and stranger[0]["predictedHistoricFlooded"] in (0, 1)
    report = engine.flood_report([asked.first()["postcode"]]).collect()
    assert len(report) == 1 and 0 <= report[0]["predictedFloodProb"] <= 1


def test_prices(engine, some):
    engine.fit_to_data("house_prices_xgb")
    known = engine.units.select("postcode").first()[0]
    rows = engine.predict_median_house_price(["ZZ9 9ZZ", known], "house_prices_xgb").collect()
    assert rows[0]["medianPrice"] == 245000.0
    assert rows[1]["medianPrice"] > 0


def test_values_and_risks(engine, views):
    asked = [r["postcode"] for r in views.labelled.orderBy("k").limit(5).collect()] + ["ZZ1 1ZZ"]
    value = {r["postcode"]: r["total_property_value"] for r in engine.estimate_total_value(asked).collect()}
    labels = engine.units.select("postcode", "riskLabel")
    risk = {r["postcode"]: r for r in engine.estimate_annual_economic_flood_risk(asked, labels).collect()}
    assert value["ZZ1 1ZZ"] == 0 and risk["ZZ1 1ZZ"]["annual_economic_flood_risk"] == 0
    probability = {7: 0.05, 6: 0.03, 5: 0.02, 4: 0.01, 3: 0.005, 2: 0.002, 1: 0.001}
    for row in labels.where(F.col("postcode").isin(asked)).collect():
        want = 0.05 * value[row["postcode"]] * probability[row["riskLabel"]]
        assert abs(risk[row["postcode"]]["annual_economic_flood_risk"] - want) < 1e-6
    assert engine.estimate_annual_human_flood_risk(asked).count() == 6


def test_imputation_leaves_no_gap(engine, views):
    for method in ("postcode", "knn", "constant"):
        filled = engine.impute_missing_values(views.unlabelled, method)
        assert filled.count() == views.unlabelled.count()
        assert filled.na.drop("any").count() == filled.count()
    with pytest.raises(ValueError):
        engine.impute_missing_values(views.unlabelled, "nonsense")


def test_property_age(spark):
    shares = [0.1, 0.2, 0.1, 0.1, 0.2, 0.1, 0.1, 0.1]
    rows = [(f"D{i}", 0.1 * i, 0.2 * i, *(shares if i % 3 else [None] * 8)) for i in range(9)]
    names = ", ".join(f"`{c}` double" for c in m.AGE_SHARES)
    df = spark.createDataFrame(rows, f"postcodeDistrict string, catsPerHousehold double, dogsPerHousehold double, {names}")
    filled = m.fill_age_shares(df, trees=3, depth=3)
    total = sum((F.col(f"`{c}`") for c in m.AGE_SHARES), F.lit(0.0))
    assert filled.count() == 9 and filled.where(F.abs(total - 1) > 1e-9).count() == 0
    with pytest.raises(ValueError):
        m.fill_age_shares(df.drop("unknown"))


def test_station_coordinates(engine, views):
    got = engine.get_station_coordinates(views.readings)
    assert got.where("parameter not in ('rainfall', 'level')").count() == 0
    assert got.where("latitude is null").count() == 0 and got.count() > 0
    assert set(add_osgb36(views.stations).columns) > {"easting", "northing"}


def test_high_risk(engine):
    engine.fit_to_data("knn")
    got = engine.predict_high_risk_near_watercourses(["River 1", "River 2"], risk_above=0)
    assert got.columns[-1] == "riskLabel" and got.where("nearestWatercourse not in ('River 1', 'River 2')").count() == 0
    assert got.count() == got.select("postcode").distinct().count() > 0

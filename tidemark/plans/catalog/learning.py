"""Trained models, at their published sizes.

What a model answers has no SQL form. So the queries tell of every answer whether
it is one that can be, and the twins ask for the same rows with ``true``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.geodesy import add_wgs84
from tidemark.operators.evaluate import class_score
from tidemark.operators.impute import by_postcode
from tidemark.operators.ranking import stratified_folds
from tidemark.operators.location import coin_flip, england_median_price, minimum_risk, never_flooded
from tidemark.plans import models as m
from tidemark.plans import store
from tidemark.plans.catalog import query
from tidemark.plans.catalog.common import REQUESTS, keyed, requests
from tidemark.plans.engine import RiskEngine
from tidemark.plans.prices import with_price_fallback
from tidemark.plans.validation import compare_models, out_of_fold
from tidemark.session import fresh_path, materialize
from tidemark.sources.views import Views

#: Trees of the cross-validated forest (published value).
CROSS = m.ForestSize(trees=300)
#: Twin of a query with an answer per request that is in range; only strangers may go without.
ASKED = f"with {REQUESTS} select ord, postcode, true as in_range from requests"


def in_range(answers, column: str, low: float, high: float):
    """Per request: whether its answer lies in a range. A stranger may have none."""
    value = F.col(column)
    good = value.between(low, high) | (value.isNull() & F.col("postcode").startswith("ZZ"))
    return answers.select("ord", "postcode", F.coalesce(good, F.lit(False)).alias("in_range"))


def prepared_units(v: Views):
    """The prepared unit table is a stored table: written once, then read."""
    return materialize(add_wgs84(by_postcode(v.labelled, v.labelled)), "prepared")


def engine(v: Views, prepare: bool = False) -> RiskEngine:
    """Engine over the views, with gap-free prepared units where a model needs them."""
    return RiskEngine(
        v.labelled,
        v.sector_data,
        v.district_data,
        unlabelled=v.unlabelled,
        prepared_units=prepared_units(v).drop("k") if prepare else None,
    )


def wgs84_places(v: Views):
    df = v.stations.na.drop(subset=["latitude", "longitude"])
    number = F.substring("stationReference", 3, 20).cast("bigint")
    return df.select(number.alias("ord"), "longitude", "latitude")


def grid_places(v: Views):
    return v.unlabelled.select(F.col("k").alias("ord"), "easting", "northing")


@query(
    "cls1_minimum_risk",
    f"with {REQUESTS} select ord, postcode, 1 as riskLabel from requests",
    ("unit",),
)
def cls1(v: Views):
    return minimum_risk(requests(v))


@query(
    "cls1_minimum_risk_at_places",
    "select k as ord, easting, northing, 1 as riskLabel from unlabelled",
    ("unlabelled",),
)
def cls1_places(v: Views):
    return minimum_risk(grid_places(v))


@query(
    "reg2_england_median",
    f"with {REQUESTS} select ord, postcode, 245000.0e0 as medianPrice from requests",
    ("unit",),
)
def reg2(v: Views):
    return england_median_price(requests(v))


@query(
    "cls4_never_flooded",
    f"with {REQUESTS} select ord, postcode, false as historicallyFlooded from requests",
    ("unit",),
)
def cls4(v: Views):
    return never_flooded(requests(v))


@query(
    "cls4_coin_flip",
    f"""with {REQUESTS} select ord, postcode,
        ('0x' || substr(md5(postcode || ':42'), 1, 12))::bigint % 1000003 % 2 = 1 as historicallyFlooded from requests""",
    ("unit",),
)
def cls4_coin(v: Views):
    return requests(v).withColumn("historicallyFlooded", coin_flip(F.col("postcode")))


@query("fit1_fit_dispatcher", ASKED, ("unit",))
def fit1(v: Views):
    e = engine(v)
    e.fit_to_data(["knn", "modal_local_authority", "seven_class_tool"], unit_data=v.labelled.where("k % 4 = 1").withColumn("riskLabel", F.lit(7)))
    return in_range(e.predict_flood_class_from_postcode(requests(v), "seven_class_tool"), "riskLabel", 1, 7)


@query("cls2_seven_class_by_postcode", ASKED, ("unit",))
def cls2(v: Views):
    e = engine(v).fit_to_data("seven_class_tool")
    return in_range(e.predict_flood_class_from_postcode(requests(v), "seven_class_tool"), "riskLabel", 1, 7)


@query("cls2b_seven_class_by_grid_place", "select k as ord, true as in_range from unlabelled", ("unlabelled",))
def cls2b(v: Views):
    e = engine(v).fit_to_data("seven_class_tool")
    found = e.predict_flood_class_from_OSGB36_location(grid_places(v), "seven_class_tool")
    return found.select("ord", F.col("riskLabel").between(1, 7).alias("in_range"))


@query(
    "cls2c_seven_class_by_wgs84_place",
    """select cast(substr(stationReference, 3, 20) as bigint) as ord, true as in_range from stations
       where latitude is not null and longitude is not null""",
    ("stations",),
)
def cls2c(v: Views):
    e = engine(v).fit_to_data("seven_class_tool")
    found = e.predict_flood_class_from_WGS84_locations(wgs84_places(v), "seven_class_tool")
    return found.select("ord", F.col("riskLabel").between(1, 7).alias("in_range"))


@query(
    "cls2d_class_probabilities",
    "select postcode, riskLabel, true as in_range, true as sums_to_one, true as of_likeliest from labelled",
    ("labelled",),
)
def cls2d(v: Views):
    units = keyed(add_wgs84(v.labelled))
    found = m.SevenClassProbability.fit(units, v.district_data).predict(units, v.district_data)
    shares = [F.col(f"prob_risk_{i}") for i in range(1, 8)]
    return found.select(
        "postcode",
        "riskLabel",
        (F.col("predictedRisk").between(1, 7) & F.forall(F.array(*shares), lambda p: p.between(0, 1))).alias("in_range"),
        (F.abs(sum(shares[1:], shares[0]) - 1) < 1e-9).alias("sums_to_one"),
        (F.get(F.array(*shares), F.col("predictedRisk") - 1) == F.greatest(*shares)).alias("of_likeliest"),
    )


@query("cls3_historic_forest")
def cls3(v: Views):
    return engine(v, True).fit_to_data("historic_rf").predict_historic_flooding(requests(v), "historic_rf")


#: More than any price of the tables.
DEAREST = 1e9


@query("reg1_boosted_prices", ASKED, ("unit",))
def reg1(v: Views):
    e = engine(v, True).fit_to_data("house_prices_xgb")
    return in_range(e.predict_median_house_price(requests(v), "house_prices_xgb"), "medianPrice", 1, DEAREST)


@query("reg1b_boosted_prices_by_district", ASKED, ("unit",))
def reg1b(v: Views):
    units, districts = prepared_units(v), v.district_data
    model = m.BoostedPrices.fit(units, districts, "district")
    return in_range(with_price_fallback(requests(v), model.predict(units, districts)), "medianPrice", 1, DEAREST)


@query("imp4_property_age")
def imp4(v: Views):
    return m.fill_age_shares(v.district_data)


@query("lyr8_postcode_report")
def lyr8(v: Views):
    report = engine(v, True).fit_to_data("historic_rf").flood_report(requests(v))
    return report.select("postcode", "historicallyFlooded", "predictedHistoricFlooded", "predictedFloodProb")


@query("snk2_saved_pipeline", "select postcode, true as in_range, true as alike from unlabelled", ("unlabelled",))
def snk2(v: Views):
    """Answers of a forest before and after it was saved and loaded."""
    path = fresh_path(v.spark, "model")
    model = m.SevenClassForest.fit(v.labelled)
    store.save(model.pipeline, path, v.labelled, ["easting", "northing", "elevation", "distanceToWatercourse", *m.CATEGORIES])
    again = m.SevenClassForest(store.load(v.spark, path, v.unlabelled)).predict(v.unlabelled).select("k", "postcode", F.col("riskLabel").alias("loaded"))
    both = model.predict(v.unlabelled).select("k", "riskLabel").join(again, "k")
    return both.select("postcode", F.col("riskLabel").between(1, 7).alias("in_range"), (F.col("riskLabel") == F.col("loaded")).alias("alike"))


FOLDS = 5


@query(
    "evl1_out_of_fold",
    f"""select u.postcode, u.k, u.riskLabel as truth, true as in_classes, {FOLDS} as folds, true as better_than_constant
        from labelled u where u.riskLabel is not null""",
    ("labelled",),
)
def evl1(v: Views):
    """Every labelled row once, by a model of the other folds; the score is compared with that of the constant answer."""
    found = out_of_fold(
        v.labelled,
        "riskLabel",
        "k",
        lambda train: m.SevenClassForest.fit(train, CROSS),
        lambda model, part: model.predict(part.withColumn("truth", F.col("riskLabel"))),
        folds=FOLDS,
    )
    found = materialize(found.select("postcode", "k", "fold", "truth", F.col("riskLabel").alias("prediction")), "out-of-fold")
    score = lambda column: class_score(found.withColumn("_p", column), "truth", "_p").select("score")
    facts = score(F.col("prediction")).join(score(F.lit(1)).withColumnRenamed("score", "constant")).join(found.agg(F.count_distinct("fold").cast("int").alias("folds")))
    return found.join(facts).select(
        "postcode", "k", "truth", F.col("prediction").between(1, 7).alias("in_classes"), "folds", (F.col("score") > F.col("constant")).alias("better_than_constant")
    )


@query(
    "evl9_model_comparison",
    """select * from (values ('all_minimum_risk', 'All minimum risk', true, true), ('seven_class_tool', 'Seven Class Probability Model', true, true))
       as t(model, name, scored, worked)""",
)
def evl9(v: Views):
    """Models fitted on four fifths of the units and scored on the rest."""
    folded = materialize(stratified_folds(v.labelled.where("riskLabel is not null"), "riskLabel", "k", FOLDS), "comparison")
    train, test = folded.where("fold <> 0").drop("fold"), folded.where("fold = 0").drop("fold")
    e = RiskEngine(train, v.sector_data, v.district_data, unlabelled=test.drop("riskLabel"))
    truth = test.select(F.col("k").alias("ord"), "postcode", F.col("riskLabel").alias("truth"))

    def score(key: str):
        return class_score(e.predict_flood_class_from_postcode(truth, key), "truth", "riskLabel")

    table = compare_models(v.spark, m.flood_class_from_postcode_models, e.fit_to_data, score)
    return table.select("model", "name", F.map_contains_key("scores", "score").alias("scored"), F.col("failure").isNull().alias("worked"))


@query(
    "udx1_added_model",
    f"with {REQUESTS} select ord, postcode, 7 as riskLabel from requests",
    ("unit",),
)
def udx1(v: Views):
    """A model of the caller's own, added to a registry under a new key."""
    m.register_model(
        "flood_class_from_postcode",
        "always_seven",
        "Always seven",
        lambda e: lambda wanted: wanted.withColumn("riskLabel", F.lit(7)),
    )
    try:
        e = engine(v).fit_to_data("always_seven")
        return e.predict_flood_class_from_postcode(requests(v), "always_seven")
    finally:
        m.unregister_model("flood_class_from_postcode", "always_seven")


@query(
    "udx5_own_constants",
    """select k, coalesce(soilType, 'Peat') as soilType, coalesce(elevation, 12.5e0) as elevation from unlabelled""",
    ("unlabelled",),
)
def udx5(v: Views):
    own = {"soilType": "Peat", "elevation": 12.5}
    return engine(v).impute_missing_values(v.unlabelled, "constant", own).select("k", "soilType", "elevation")

"""Repeated and missing keys: no row is lost and none multiplied, whichever way a size switch goes."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tidemark.functions.readings import clean_value, measure_unit, tidy_qualifier
from tidemark.operators import distance, impute, knn, lookups, quantiles, ranking, risk
from tidemark.plans.models import AGE_PREDICTORS, AGE_SHARES, fill_age_shares
from tidemark.session import materialize, work_scope
from tidemark.streaming.readings import latest_state


def test_one_answer_per_request(spark):
    requests = lookups.requests_table(spark, ["AB1 1AA", "AB1 1AA", "ZZ9 9ZZ", None])
    units = spark.createDataFrame([("AB1 1AA", 1.0, 2.0, 100.0)] * 2 + [("AB1 1AA", 5.0, 6.0, 300.0)], "postcode string, easting double, northing double, medianPrice double")
    sectors = spark.createDataFrame([("AB1 1", 10, 20), ("AB1 1", 10, 20)], "postcodeSector string, households int, headcount int")
    labels = requests.select("postcode").withColumn("riskLabel", F.lit(7))
    assert risk.total_value(requests, units, sectors).count() == 4
    assert sorted(r[0] for r in risk.human_risk(requests, labels, sectors).select("annual_human_flood_risk").collect())[2:] == [0.1 * 20 * 0.05] * 2
    assert sorted(r[0] for r in risk.economic_risk(requests, labels, units, sectors).select("annual_economic_flood_risk").collect())[2:] == [0.05 * 1000 * 0.05] * 2
    assert [r["easting"] for r in lookups.lookup_grid(requests, units).collect()] == [1.0, 1.0, None, None]
    assert lookups.lookup_wgs84(requests, units).count() == 4


def test_smoothed_keeps_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), ("b", None), ("b", None)], "g string, v double")
    assert sorted(map(tuple, lookups.smoothed(df, "g").collect()), key=str) == sorted([("a", 2.0), ("a", 2.0), (None, None), ("b", None), ("b", None)], key=str)


def test_all_null_group_on_both_ways(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(9)] + [("b", None)] * 9, "g string, v double")
    both = [sorted(map(tuple, quantiles.medians(df, ["v"], ["g"], hot_rows=n).collect())) for n in (5, 1000)]
    assert both[0] == both[1] == [("a", 4.0), ("b", None)]


def test_undefined_places_ask_nothing(spark):
    queries = spark.createDataFrame([(1, float("nan"), 0.0), (2, 0.0, 0.0)], "q int, easting double, northing double")
    points = spark.range(200).select(F.col("id").alias("p"), F.col("id").cast("double").alias("easting"), F.lit(0.0).alias("northing"))
    for leaf in (8, 1000):
        assert {r["q"] for r in knn.nearest(queries, points, 2, "q", "p", leaf_rows=leaf).collect()} == {2}


def test_fill_by_neighbours_goes_by_place(spark):
    schema = "postcode string, easting double, northing double, elevation double"
    rows = [("DUP", 0.0, 0.0, None), ("DUP", 1000.0, 1000.0, None), (None, 1000.0, 1000.0, None), (None, None, None, None)]
    labelled = spark.createDataFrame([("A", 0.0, 1.0, 1.0), ("B", 1000.0, 1001.0, 10.0)], schema)
    filled = impute.by_neighbours(spark.createDataFrame(rows, schema), labelled, ["elevation"], k=1)
    assert sorted(r["elevation"] for r in filled.collect()) == [1.0, 5.5, 10.0, 10.0]
    whole = spark.createDataFrame([*rows[:3], ("A", 0.0, 1.0, 1.0), ("B", 1000.0, 1001.0, 10.0)], schema)
    assert sorted(r["elevation"] for r in impute.within_table_by_neighbours(whole, ["elevation"], [], 1).collect()) == [1.0, 1.0, 10.0, 10.0, 10.0]


def test_age_shares_lose_no_district(spark):
    names = ["postcodeDistrict", *AGE_PREDICTORS, *AGE_SHARES]
    rows = [(f"D{i}", 0.1 * i, 0.2 if i % 3 else None, *([None] * len(AGE_SHARES) if i % 2 else [0.125] * len(AGE_SHARES))) for i in range(12)]
    df = spark.createDataFrame(rows, ", ".join(["postcodeDistrict string", *(f"`{n}` double" for n in names[1:])]))
    filled = fill_age_shares(df, trees=2, depth=2).collect()
    assert len(filled) == 12 and all(abs(sum(r[c] for c in AGE_SHARES) - 1) < 1e-6 for r in filled)


def test_splits_take_any_key(spark):
    df = spark.createDataFrame([(f"AB{i} 1AA", i % 3) for i in range(100)] + [(None, 1)], "postcode string, label int")
    assert ranking.stratified_folds(df, "label", "postcode").where("fold is null").count() == 0
    assert ranking.hash_split(df, "postcode", {"a": 1, "b": 1}).where("split is null").count() == 0
    big = spark.createDataFrame([(2**62,), (-(2**62),)], "k bigint")
    assert big.select(ranking.keyed_hash(F.col("k")).alias("h")).where("h between 0 and 1000002").count() == 2


def test_texts(spark):
    df = spark.createDataFrame([("12f",), ("5d|7",), (" 1.5e2 ",), ("7|x",), (".5",), ("nan",), ("0x10",)], "v string")
    assert [r[0] for r in df.select(clean_value(F.col("v"))).collect()] == [None, None, 150.0, 7.0, 0.5, None, None]
    one = spark.createDataFrame([("http://x/measures/1-rainfall-a-t-15_min-mm/readings/2025", "tipping_bucket-raingauge 2nd")], "m string, q string")
    assert one.select(measure_unit(F.col("m")), tidy_qualifier(F.col("q"))).first()[:] == ("mm/readings", "Tipping Bucket-Raingauge 2Nd")


def test_tidy_qualifier_reads_its_text_once(spark):
    texts = ["tipping_bucket-raingauge 2nd", "", None, "a", "ÉCOLE_été", "ßa", "x__y1z", "\U0001d4b3a_b", "_a"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, q string")
    found = [r[0] for r in rows.orderBy("i").select(tidy_qualifier(F.col("q"))).collect()]
    assert found == ["Tipping Bucket-Raingauge 2Nd", "", None, "A", "École Été", "SSa", "X  Y1Z", "\U0001d4b3A B", " A"]
    # A text that is costly to find must not be found anew for each of its letters.
    costly = rows.select(tidy_qualifier(F.regexp_extract("q", "^(.*)$", 1)).alias("q"))
    plan = costly._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") == 1, plan


def test_one_file_is_dealt_to_all_cores(spark, tmp_path):
    from tidemark.sources.tables import spread

    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/one")
    one = spark.read.parquet(f"{tmp_path}/one")
    dealt = spread(one)
    assert one.rdd.getNumPartitions() == 1 and dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r.id for r in dealt.collect()) == list(range(1000))
    assert spread(dealt) is dealt


def test_missing_time_counts_as_last(spark):
    df = spark.createDataFrame([("s", "rainfall", "2025-01-01 00:00:00", 1.0, "mm"), ("s", "rainfall", None, 2.0, "mm")], "stationReference string, parameter string, t string, value double, unitName string")
    df = df.withColumn("dateTime", F.col("t").cast("timestamp"))
    last = latest_state(df).first()
    assert (last["dateTime"], last["value"]) == (None, 2.0)
    assert ranking.latest_per_key(df, ["stationReference"], "dateTime", "value").first()["value"] == 2.0


def test_crowded_cells_keep_every_pair(spark, monkeypatch):
    left = spark.range(300).select(F.col("id").alias("l"), (F.col("id") % 7 * 40.0).alias("easting"), (F.col("id") % 3 * 500.0).alias("northing"))
    right = left.select(F.col("l").alias("r"), "easting", "northing")
    plain = sorted(map(tuple, distance.pairs_within(left, right, 100.0, "l", "r").collect()))
    monkeypatch.setattr(distance, "ROWS_PER_SALT", 20)
    assert sorted(map(tuple, distance.pairs_within(left, right, 100.0, "l", "r").collect())) == plain and len(plain) > 3000


def test_category_codes_are_the_sorted_places(spark):
    df = spark.createDataFrame([(w,) for w in ["b", "a", None, "c", "a", "É", ""]], "w string")
    assert sorted(map(tuple, ranking.category_codes(df, "w", "code").collect())) == [("", 0), ("a", 1), ("b", 2), ("c", 3), ("É", 4)]


def test_scope_leaves_nothing(spark):
    with work_scope(spark):
        path = materialize(spark.range(3), "scoped").inputFiles()[0].removeprefix("file://")
        folder = os.path.dirname(path)
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)

"""Operators against brute force, with hot groups, copies and odd shapes."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import distance, ranking, scaling, stats
from tidemark.operators.knn import nearest
from tidemark.operators.quantiles import exact_quantiles, medians, modes

RNG = np.random.default_rng(7)


def frame(spark, points, name):
    return spark.createDataFrame(
        pd.DataFrame({name: range(len(points)), "easting": points[:, 0], "northing": points[:, 1]})
    )


def brute(queries, reference, k):
    rows = []
    for i, q in enumerate(queries):
        d2 = ((reference - q) ** 2).sum(axis=1)
        order = np.lexsort((np.arange(len(reference)), d2))[:k]
        rows += [(i, rank + 1, int(j), d2[j]) for rank, j in enumerate(order)]
    return rows


CASES = {
    # A third of the rows in one spot, a third in one small cluster.
    "skewed": (
        np.concatenate(
            [
                RNG.integers(0, 400_000, (300, 2)),
                np.full((300, 2), 1234),
                RNG.integers(200_000, 200_030, (300, 2)),
            ]
        ),
        np.concatenate([RNG.integers(-9_000, 420_000, (60, 2)), np.full((20, 2), 1234), np.full((5, 2), 200_010)]),
        5,
    ),
    "empty district beside a city": (
        np.concatenate([RNG.integers(0, 1_000, (400, 2)), RNG.integers(90_000, 99_000, (10, 2))]),
        RNG.integers(5_000, 80_000, (50, 2)),
        15,
    ),
    "fewer than k": (RNG.integers(0, 100, (3, 2)), RNG.integers(0, 100, (20, 2)), 5),
    "negative and fractional": (RNG.normal(0, 1, (250, 2)), RNG.normal(0, 2, (40, 2)), 7),
    "one line": (np.stack([np.arange(200), np.zeros(200)], axis=1), RNG.integers(-5, 205, (30, 2)), 4),
}


@pytest.mark.parametrize("case", list(CASES))
def test_nearest_equals_brute_force(spark, case):
    reference, queries, k = (np.asarray(x, dtype=float) if not isinstance(x, int) else x for x in CASES[case])
    got = (
        nearest(frame(spark, queries, "qid"), frame(spark, reference, "id"), k, "qid", "id")
        .select("qid", "rank", "id", "d2")
        .orderBy("qid", "rank")
        .collect()
    )
    assert [tuple(row) for row in got] == brute(queries, reference, k)


def test_nearest_without_coordinates(spark):
    reference = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 5.0)], "id int, easting double, northing double")
    queries = spark.createDataFrame([(1, 1.0, 1.0), (2, None, None)], "qid int, easting double, northing double")
    rows = nearest(queries, reference, 3, "qid", "id").collect()
    assert [(row["qid"], row["id"]) for row in rows] == [(1, 1)]
    none = reference.where("id > 9")
    assert nearest(queries, none, 3, "qid", "id").count() == 0


PROBS = [0.0, 0.05, 0.25, 0.5, 0.9, 0.99, 1.0]


def test_quantiles_of_hot_groups(spark):
    values = {
        "hot": np.concatenate([RNG.integers(0, 50, 900), RNG.random(1100) * 40]),
        "same": np.full(400, 3.0),
        "small": np.array([4.0, 1.0]),
    }
    rows = [(key, float(v)) for key, vs in values.items() for v in vs] + [("hot", None), ("none", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "key string, v double").repartition(4)
    for hot_rows in (100, 1_000_000):
        got = {row["key"]: row["v"] for row in exact_quantiles(df, ["v"], PROBS, ["key"], hot_rows).collect()}
        for key, vs in values.items():
            np.testing.assert_allclose(got[key], np.quantile(vs, PROBS), rtol=1e-12)
    whole = np.concatenate(list(values.values()) + [[1.0]])
    for hot_rows in (10, 1_000_000):
        row = exact_quantiles(df, ["v"], PROBS, (), hot_rows).first()
        np.testing.assert_allclose(row["v"], np.quantile(whole, PROBS), rtol=1e-12)


def test_bad_sketch_still_gives_exact_quantiles(spark, monkeypatch):
    """Even brackets that miss the rank only cost time."""
    real = F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda col, probs, acc: real(col, [0.2] * len(probs), acc))
    values = RNG.random(500)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    row = exact_quantiles(df, ["v"], [0.05, 0.5, 0.95], (), hot_rows=10).first()
    np.testing.assert_allclose(row["v"], np.quantile(values, [0.05, 0.5, 0.95]), rtol=1e-12)


def test_mode_ties_and_medians(spark):
    df = spark.createDataFrame(
        [("a", "y", 1), ("a", "x", 2), ("a", "y", 3), ("a", "x", 4), ("b", None, None)], "g string, t string, v int"
    )
    assert {row["g"]: row["t"] for row in modes(df, ["t"], ["g"]).collect()} == {"a": "x"}
    assert {row["g"]: row["v"] for row in medians(df, ["v"], ["g"]).collect()} == {"a": 2.5, "b": None}


def test_rank_within_equals_one_window(spark):
    df = spark.range(3000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 7 == 0, "rare").otherwise("common").alias("label")
    )
    order = ranking.keyed_hash(F.col("k"))
    got = ranking.rank_within(df, "label", order, "k", "rank")
    want = F.row_number().over(Window.partitionBy("label").orderBy(order, "k"))
    assert got.withColumn("want", want).where("rank <> want").count() == 0
    assert got.count() == 3000


def test_stratified_folds_are_even(spark):
    df = spark.range(1003).select(F.col("id").alias("k"), (F.col("id") % 3).alias("label"))
    sizes = ranking.stratified_folds(df, "label", "k").groupBy("label", "fold").count().collect()
    assert len(sizes) == 15
    for label in range(3):
        counts = [row["count"] for row in sizes if row["label"] == label]
        assert max(counts) - min(counts) <= 1


def test_pairs_within_radius_with_salts(spark, monkeypatch):
    monkeypatch.setattr(distance, "ROWS_PER_SALT", 20)
    left = np.concatenate([RNG.integers(0, 5_000, (100, 2)), np.full((100, 2), 700)]).astype(float)
    right = RNG.integers(0, 5_000, (80, 2)).astype(float)
    got = distance.pairs_within(
        frame(spark, left, "a"), frame(spark, right, "b"), 600.0, "a", "b"
    ).collect()
    dist = np.hypot(left[:, None, 0] - right[None, :, 0], left[:, None, 1] - right[None, :, 1])
    want = {(int(i), int(j)) for i, j in np.argwhere(dist <= 600)}
    assert {(row["a"], row["b"]) for row in got} == want and len(got) == len(want)


def test_great_circle_pairs_across_the_date_line(spark):
    points = [(0, 0.0, 179.9), (1, 0.0, -179.9), (2, 89.95, 10.0), (3, 89.95, -170.0), (4, 45.0, 0.0)]
    df = spark.createDataFrame(points, "id int, latitude double, longitude double")
    got = distance.pairs_within_wgs84(
        df.withColumnRenamed("id", "a"), df.withColumnRenamed("id", "b"), 30_000.0, "a", "b"
    )
    assert {(row["a"], row["b"]) for row in got.where("a < b").collect()} == {(0, 1), (2, 3)}


def test_outlier_caps(spark):
    df = spark.createDataFrame([(1, 5), (2, 6), (3, 7), (100, 200), (-50, -100)], "a int, b int")
    rows = [tuple(row) for row in scaling.cap_outliers(df, ["a", "b"]).collect()]
    assert rows == [(1, 5), (2, 6), (3, 7), (6, 10), (-2, 2)]
    assert [row["b"] for row in scaling.cap_outliers(df, "a").collect()] == [5, 6, 7, 200, -100]


def test_distributions_on_a_lattice(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (1.0,), (2.6,), (None,)], "v double")
    cumulative = [row["density"] for row in stats.cumulative_distribution(df, "v", 0.0, 3.0, 1.0).orderBy("at").collect()]
    assert cumulative == [0.2, 0.6, 0.6, 0.8]
    shares = [row["density"] for row in stats.probability_distribution(df, "v", 0.0, 3.0, 1.0).orderBy("at").collect()]
    assert shares == [0.4, 0.2, 0.0, 0.2]


def test_nearest_in_a_crowded_smallest_cell(spark):
    """A third of the points within a millionth of the extent."""
    reference = np.concatenate([RNG.integers(0, 10_000_000, (700, 2)), RNG.integers(5_000, 5_040, (700, 2))]).astype(float)
    queries = np.concatenate([RNG.integers(0, 10_000_000, (20, 2)), RNG.integers(4_990, 5_050, (20, 2))]).astype(float)
    got = nearest(frame(spark, queries, "qid"), frame(spark, reference, "id"), 3, "qid", "id")
    rows = got.select("qid", "rank", "id", "d2").orderBy("qid", "rank").collect()
    assert [tuple(row) for row in rows] == brute(queries, reference, 3)

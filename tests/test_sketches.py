"""Approximate percentiles against exact ones."""

from __future__ import annotations

import numpy as np

from tidemark.operators.sketches import merged, rank_error, sketch_percentiles, sketched
from tidemark.operators.stats import percentiles
from pyspark.sql import functions as F

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]


def within(values, got, size):
    """Whether each answer lies within the stated error of its rank."""
    ranked, room = np.sort(values), rank_error(size)
    for p, value in got.items():
        low, high = np.searchsorted(ranked, value, "left") / len(ranked), np.searchsorted(ranked, value, "right") / len(ranked)
        assert low - room <= p <= high + room


def test_within_the_stated_error(spark):
    values = np.random.default_rng(1).lognormal(size=50_000)
    df = spark.createDataFrame([(i % 9, float(x)) for i, x in enumerate(values)], "day int, v double").unionByName(spark.createDataFrame([(1, None), (2, float("nan"))], "day int, v double"))
    within(values, {r["prob"]: r["value"] for r in percentiles(df, "v", PROBS, approximate=True).collect()}, 4000)
    daily = sketched(df, "v", ["day"], 400)
    within(values, {r["prob"]: r["value"] for r in sketch_percentiles(merged(daily, size=400), PROBS).collect()}, 400)
    within(values[4::9], {r["prob"]: r["value"] for r in sketch_percentiles(daily.where("day = 4"), PROBS).drop("day").collect()}, 400)
    assert daily.agg(F.max(F.length("sketch"))).first()[0] < 20_000


def test_small_tables_are_exact_and_merge_alike(spark):
    """Below the size of a sketch nothing is lost, so merged parts equal one pass."""
    df = spark.createDataFrame([(i % 3, float(i * i % 101)) for i in range(200)], "part int, v double")
    whole = {r["prob"]: r["value"] for r in percentiles(df, "v", PROBS, approximate=True).collect()}
    parts = {r["prob"]: r["value"] for r in sketch_percentiles(merged(sketched(df, "v", ["part"])), PROBS).collect()}
    assert whole == parts and whole[0.0] == 0.0
    ranked = np.sort([i * i % 101 for i in range(200)])
    within(ranked, whole, 10**9)
    empty = percentiles(df.where("false"), "v", [0.5], approximate=True).collect()
    assert [(r["prob"], r["value"]) for r in empty] == [(0.5, None)]

"""Cross-fitting at the same time, on rows that a fold's model has not seen."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from tidemark.plans.validation import in_pools, out_of_fold


def test_jobs_run_at_the_same_time(spark):
    gate = threading.Barrier(3, timeout=60)

    def job():
        gate.wait()  # passes only if all three are there
        return spark.range(5).count(), spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    assert in_pools(spark, [job] * 3, "t") == [(5, f"t-{i}") for i in range(3)]
    assert in_pools(spark, [], "t") == []

    def fails():
        raise ValueError("no")

    with pytest.raises(ValueError):
        in_pools(spark, [fails], "t")


def test_no_row_is_predicted_by_a_model_that_saw_it(spark):
    rows = spark.createDataFrame([(i, i % 3) for i in range(60)], "k int, label int")

    def fit(train):
        return {r["k"] for r in train.select("k").collect()}

    def predict(seen, part):
        return part.withColumn("was_seen", F.col("k").isin(*seen)).withColumn("size", F.lit(len(seen)))

    got = out_of_fold(rows, "label", "k", fit, predict).collect()
    assert sorted(r["k"] for r in got) == list(range(60)) and {r["fold"] for r in got} == set(range(5))
    assert not any(r["was_seen"] for r in got) and all(r["size"] + sum(x["fold"] == r["fold"] for x in got) == 60 for r in got)
    assert all(r["fit_seconds"] > 0 and r["predict_seconds"] > 0 for r in got)

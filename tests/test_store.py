"""Saved pipelines: versions, half-written ones, wrong schemas."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tidemark.plans import store
from tidemark.plans.features import feature_stages


def test_store(spark, tmp_path):
    root = str(tmp_path / "models")
    train = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (4.0, None)], "x double, kind string")
    first = Pipeline(stages=feature_stages(train, standard=["x"], categorical=["kind"])).fit(train)
    with pytest.raises(FileNotFoundError):
        store.load(spark, root)
    assert store.save(first, root, train, ["x", "kind"], {"score": 1.5}) == 1
    assert store.save(first, root, train.limit(2), ["x"]) == 2
    assert store.versions(spark, root) == [1, 2]
    assert store.manifest(spark, root, 1) == {"columns": {"x": "double", "kind": "string"}, "rows": 3, "metrics": {"score": 1.5}}
    # What a cut-off save leaves behind is passed over.
    spark.range(1).write.parquet(f"{root}/_writing-1/pipeline")
    spark.range(1).write.parquet(f"{root}/v000009/pipeline")
    assert store.versions(spark, root) == [1, 2]
    again = store.load(spark, root, train, 1)
    assert again.transform(train).select("features").collect() == first.transform(train).select("features").collect()
    with pytest.raises(ValueError, match="'kind' is missing"):
        store.load(spark, root, train.drop("kind"), 1)
    with pytest.raises(ValueError, match="'x' is int"):
        store.load(spark, root, train.withColumn("x", F.lit(1)), 1)
    with pytest.raises(FileNotFoundError):
        store.load(spark, root, version=7)

"""Stopping by patience, category codes from a table, leaves of the nearest join."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import knn
from tidemark.plans.dictionary import hot_places, one_hot_stages, one_hot_vectors
from tidemark.plans.models import best_rounds, first_trees


def plain_rounds(errors, patience):
    """Stop at the first round that has seen ``patience`` rounds since the best; keep up to the best."""
    best, since, kept = float("inf"), 0, 1
    for at, error in enumerate(errors):
        if error < best:
            best, since, kept = error, 0, at + 1
        else:
            since += 1
            if since >= patience:
                break
    return kept


def test_patience():
    assert best_rounds([3.0, 2.0, 1.0, 1.5, 1.2, 0.5], 2) == 3
    assert best_rounds([3.0, 2.0, 1.0, 1.5, 0.5], 2) == 5
    assert best_rounds([1.0, 1.0, 1.0], 5) == 1
    generator = random.Random(1)
    for _ in range(300):
        errors = [generator.randint(0, 30) / 10 for _ in range(generator.randint(1, 60))]
        for patience in (1, 3, 15):
            assert best_rounds(errors, patience) == plain_rounds(errors, patience)


def test_ensemble_is_cut_where_the_loss_rises(spark, tmp_path):
    """Noise is learned by heart, so the held-out loss rises again; the cut model is the first trees."""
    generator = np.random.default_rng(2)
    rows = [([float(x) for x in generator.normal(size=3)], i % 4 == 0) for i in range(240)]
    rows = [(x, x[0] + float(generator.normal()), held) for x, held in rows]
    frame = spark.createDataFrame(rows, "x array<double>, y double, held boolean").withColumn("features", array_to_vector("x"))
    model = GBTRegressor(labelCol="y", maxIter=20, maxDepth=5, stepSize=0.5, seed=1).fit(frame.where("not held"))
    test = frame.where("held")
    errors = list(model.evaluateEachIteration(test, "squared"))
    kept = best_rounds(errors, 4)
    assert kept == plain_rounds(errors, 4) < 20 and min(errors) < errors[-1]
    cut = first_trees(model, kept)
    assert cut.getNumTrees == kept and cut.treeWeights == model.treeWeights[:kept]
    again = [r[0] for r in cut.transform(test).select(F.avg((F.col("prediction") - F.col("y")) ** 2)).collect()][0]
    assert again == pytest.approx(errors[kept - 1])
    PipelineModel(stages=[cut]).write().save(str(tmp_path / "cut"))
    loaded = PipelineModel.load(str(tmp_path / "cut"))
    assert loaded.transform(test).select("prediction").collect() == cut.transform(test).select("prediction").collect()


def test_many_categories(spark, monkeypatch):
    """200,000 values are coded without a list of them on the driver."""
    rows = spark.range(200_000).select("id", F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("name"))
    rows = rows.unionByName(spark.createDataFrame([(-1, None)], "id bigint, name string"))
    collect, seen = DataFrame.collect, []

    def counted(self):
        out = collect(self)
        seen.append(len(out))
        return out

    monkeypatch.setattr(DataFrame, "collect", counted)
    out = hot_places(one_hot_vectors(rows, "name", "v"), "v")
    assert max(seen, default=0) <= 1
    facts = out.agg(F.min("size"), F.max("size"), F.count_if(F.col("place") == F.col("id")), F.count("*")).first()
    assert tuple(facts) == (200_000, 200_000, 200_001, 200_001)


def test_codes_survive_saving(spark, tmp_path):
    train = spark.createDataFrame([("b", "x"), ("a", "y"), (None, "x"), ("c'\"", "x")], "p string, q string")
    model = Pipeline(stages=one_hot_stages(train, ["p", "q"], ["ip", "iq"], ["hp", "hq"])).fit(train)
    new = spark.createDataFrame([(1, "a", "x"), (2, "unseen", "y"), (3, None, None), (4, "c'\"", "zz")], "k int, p string, q string")
    model.write().save(str(tmp_path / "codes"))
    for use in (model, PipelineModel.load(str(tmp_path / "codes"))):
        got = {r["k"]: (r["a"], r["b"]) for r in use.transform(new).select("k", vector_to_array("hp").alias("a"), vector_to_array("hq").alias("b")).collect()}
        assert got == {1: ([1, 0, 0], [1, 0]), 2: ([0, 0, 0], [0, 1]), 3: ([0, 0, 0], [0, 0]), 4: ([0, 0, 1], [0, 0])}


@pytest.mark.parametrize("stretch", [8192, 40])
def test_every_point_has_its_leaf(spark, monkeypatch, stretch):
    """The leaf is the largest cell with few enough points around each point."""
    monkeypatch.setattr(knn, "STRETCH", stretch)
    generator = np.random.default_rng(3)
    xy = np.concatenate([generator.uniform(0, 1e6, (300, 2)), generator.uniform(4e5, 4e5 + 50, (300, 2)), generator.uniform(7e5, 7e5 + 1e-4, (60, 2))])
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "id int, _x double, _y double")
    box = points.agg(*[f(c).alias(n + c) for c in ("_x", "_y") for n, f in (("low", F.min), ("high", F.max))]).first()
    placed = knn._with_leaves(knn._coded(points, box), 10)
    rows = placed.select("id", "_code", "_level", "_node").collect()
    codes = np.array([r["_code"] for r in rows])
    assert sorted(r["id"] for r in rows) == list(range(len(xy)))
    for r in rows:
        held = [int((codes >> 4 * level == r["_code"] >> 4 * level).sum()) for level in range(knn.LEVELS + 1)]
        want = max((level for level, n in enumerate(held) if n <= 10), default=0)
        assert r["_level"] == want and r["_node"] == want << 56 | r["_code"] >> 4 * want
    assert "Generate" not in placed._jdf.queryExecution().toString()

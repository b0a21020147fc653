"""Forests whose trees are rows of a table: splits, the two ways of growing, answers, saving."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.plans import forest, models
from tidemark.plans.forest import ForestClassifier, ForestModel, number_cuts
from tidemark.plans.trees import WHOLE_SHARE, Shape, grown
from tidemark.session import fresh_path, materialize


def gini(weights):
    return 1 - ((weights / weights.sum()) ** 2).sum()


def test_root_split_is_the_best_of_all():
    for seed in range(20):
        rng = np.random.default_rng(seed)
        shape = Shape((6, 4), (3, 5), 3)
        m = np.stack([rng.integers(0, x, 60) for x in (6, 4, 4, 6)], axis=1).astype(np.int32)  # the last code: unseen
        y, w, count = rng.integers(0, 3, 60), rng.random(60) + 0.1, rng.integers(1, 4, 60)
        tree = grown(shape, m, y, w, count, shape.features, 5, 1, rng)

        def weights(rows, y=y, w=w, count=count):
            return np.bincount(y[rows], w[rows] * count[rows], 3)

        whole, best = weights(np.ones(60, bool)), 0.0
        falls = {}
        for column, cuts in enumerate((range(6), range(4), range(3), range(5))):
            for cut in cuts:
                right = m[:, column] > cut if column < 2 else m[:, column] == cut
                if count[right].sum() < 5 or count[~right].sum() < 5:
                    continue
                a, b = weights(~right), weights(right)
                falls[column, cut] = gini(whole) - (a.sum() * gini(a) + b.sum() * gini(b)) / whole.sum()
                best = max(best, falls[column, cut])
        if tree.column[0] < 0:  # no gain, or both sides say the same
            a = weights(np.ones(60, bool))
            assert len(tree.column) == 1 and abs(tree.leaves[tree.left[0]] / WHOLE_SHARE - a / a.sum()).max() < 1e-8
            continue
        assert abs(falls[tree.column[0], tree.cut[0]] - best) < 1e-12
        right = m[:, tree.column[0]] > tree.cut[0] if tree.column[0] < 2 else m[:, tree.column[0]] == tree.cut[0]
        got = tree.answers(m, 2)
        assert (got.sum(axis=1) == WHOLE_SHARE).all()
        for side in (right, ~right):
            a = weights(side)
            assert abs(got[side] / WHOLE_SHARE - a / a.sum()).max() < 1e-8


def test_leaves_hold_their_least_rows_and_depth_ends():
    rng = np.random.default_rng(1)
    shape = Shape((30,), (), 2)
    m, y = rng.integers(0, 30, (500, 1)).astype(np.int32), rng.integers(0, 2, 500)
    ones = np.ones(500)
    tree = grown(shape, m, y, ones, ones.astype(int), 1, 40, 30, rng)
    answer, sizes = np.unique(tree.answers(m, 1), axis=0, return_counts=True)
    assert len(answer) > 1 and sizes.min() >= 40
    assert len(grown(shape, m, y, ones, ones.astype(int), 1, 1, 0, rng).column) == 1
    assert len(grown(shape, m, y, ones, ones.astype(int), 1, 1, 2, rng).column) <= 7


def bands(spark, n=600):
    """One number whose bands tell the class, and a category."""
    return materialize(spark.range(n).select((F.col("id") * 37 % n / 10).alias("x"), (F.col("id") % 4).cast("double").alias("c"), F.lit(1.0).alias("weight")).withColumn("y", F.floor(F.col("x") / 7) % 3 + 2), "bands")


def answers(model, df):
    found = model.transform(df).select("x", "c", vector_to_array("probability").alias("p"), "prediction")
    return sorted((r["x"], r["c"], tuple(r["p"]), r["prediction"]) for r in found.collect())


def test_rows_of_many_tasks_grow_the_same_trees(spark):
    """With one feature there is nothing to draw, so both ways have to give the same answers."""
    df = bands(spark)
    fit = lambda whole: ForestClassifier(["x"], [], [], "y", "weight", 5, whole_rows=whole).fit(df)
    near, far = fit(10_000), fit(60)
    assert near.table.count() == 5 < far.table.count()
    a, b = answers(near, df), answers(far, df)
    assert a == b and {len(p) for _, _, p, _ in a} == {5} and all(p[0] == p[1] == 0 and abs(sum(p) - 1) < 1e-12 for _, _, p, _ in a)
    truth = {r["x"]: r["y"] for r in df.collect()}
    assert np.mean([truth[x] == got for x, _, _, got in a]) > 0.9


def test_many_tasks_with_categories(spark, monkeypatch):
    monkeypatch.setattr(forest, "WAVE_TREES", 2)
    monkeypatch.setattr(forest, "WAVE_NODES", 3)
    monkeypatch.setattr(forest, "CHUNK_ROWS", 50)
    df = bands(spark).withColumn("y", F.when(F.col("c") == 2, 9).otherwise(F.col("y")))
    model = ForestClassifier(["x"], ["c"], [4], "y", "weight", 7, min_leaf=2, whole_rows=100).fit(df)
    got = answers(model, df)
    truth = {r["x"]: r["y"] for r in df.collect()}
    assert len(got) == 600 and {len(p) for _, _, p, _ in got} == {10}
    assert np.mean([truth[x] == y for x, _, _, y in got]) > 0.9
    again = ForestClassifier(["x"], ["c"], [4], "y", "weight", 7, min_leaf=2, whole_rows=100).fit(df)
    assert answers(again, df) == got
    # A value that nothing can split.
    flat = ForestClassifier(["x"], [], [], "y", "weight", 3, whole_rows=100).fit(df.withColumn("x", F.lit(1.0)))
    assert {p for _, _, p, _ in answers(flat, df)} and flat.table.count() == 3


def test_groups_of_trees_add_up(spark, monkeypatch):
    df = bands(spark)
    model = ForestClassifier(["x"], ["c"], [4], "y", "weight", 9).fit(df)
    few = answers(model, df)
    monkeypatch.setattr(forest, "GROUP_BYTES", 1)
    assert answers(model, df) == few and max(model._groups(1)) >= 5
    path = fresh_path(spark, "forest")
    model.write().save(path)
    assert answers(ForestModel.load(path), df) == few
    # Repeated rows are asked once and answered each time.
    assert len(answers(model, df.union(df))) == 1200


def test_cuts(spark):
    df = spark.createDataFrame([(float(i), float(i % 3 == 0 or 5), None, 7.0) for i in range(1000)], "a double, b double, c double, d double")
    (a, b, c, d), facts = number_cuts(df, ["a", "b", "c", "d"], F.count("*").alias("rows"))
    assert len(a) == 32 and a[0] == 0 and all(abs(x - 31.25 * i) < 3 for i, x in enumerate(a[1:], 1))
    assert b == [3.0] and c == [] and d == [] and facts["rows"] == 1000


def test_as_good_as_mllib(spark):
    rng = np.random.default_rng(7)
    x = rng.random((3000, 4))
    y = (np.floor(x[:, 0] * 3) + (x[:, 1] > 0.5) * 2 + (rng.random(3000) < 0.1)) % 5
    rows = [(*map(float, row), float(label), 1.0, i) for i, (row, label) in enumerate(zip(x, y, strict=True))]
    df = materialize(spark.createDataFrame(rows, "a double, b double, c double, d double, y double, weight double, k int"), "compare")
    train, test = df.where("k % 3 > 0"), df.where("k % 3 = 0")
    names = ["a", "b", "c", "d"]
    ours = ForestClassifier(names, [], [], "y", "weight", 30, min_leaf=2).fit(train).transform(test)
    vectors = VectorAssembler(inputCols=names, outputCol="features")
    theirs = RandomForestClassifier(labelCol="y", weightCol="weight", numTrees=30, maxDepth=30, minInstancesPerNode=2, seed=42).fit(vectors.transform(train)).transform(vectors.transform(test))
    right = lambda found: found.agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    assert right(ours) > right(theirs) - 0.02


def test_jobs_do_not_grow_with_the_depth(spark, views):
    """A job for every level of the trees is what made deep forests slow."""

    def jobs(depth):
        spark.sparkContext.setJobGroup(f"forest-{depth}", "fit")
        models.SevenClassForest.fit(views.labelled, models.ForestSize(trees=4, depth=depth))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"forest-{depth}"))

    assert jobs(30) <= jobs(2) + 2

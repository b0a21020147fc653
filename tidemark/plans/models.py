"""Model builders and the registries that name them.

Each builder takes training tables and gives a fitted object with a small
``predict``; the sizes of the published models are the defaults, and can be
lowered. Learners are MLlib's, so trees grow on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.constants import (
    AGE_PREDICTORS,
    AGE_SHARES,
    HISTORIC_THRESHOLD,
    RISK_CLASSES,
    flood_class_from_location_models,
    flood_class_from_postcode_models,
    historic_flooding_models,
    house_price_models,
    local_authority_models,
)
from tidemark.operators.knn import nearest_one
from tidemark.operators.lookups import unit_district_merge, unit_sector_merge
from tidemark.operators.quantiles import medians, scalars
from tidemark.operators.ranking import keyed_hash
from tidemark.operators.scaling import fixed_weights
from tidemark.operators.selection import numeric_and_other
from tidemark.operators.stats import shares_of_row
from tidemark.plans.dictionary import CategoryCodes
from tidemark.plans.features import feature_stages
from tidemark.plans.forest import ForestClassifier
from tidemark.session import materialize

ID_COLUMNS = ("k", "postcode", "postcodeDistrict", "postcodeSector")
CATEGORIES = ("soilType", "nearestWatercourse", "localAuthority")

REGISTRIES = {
    "flood_class_from_postcode": flood_class_from_postcode_models,
    "flood_class_from_location": flood_class_from_location_models,
    "historic_flooding": historic_flooding_models,
    "house_price": house_price_models,
    "local_authority": local_authority_models,
}
# Builders added by the caller: (task, key) -> function of the engine that
# gives a function of a request table.
EXTRA_BUILDERS: dict[tuple[str, str], Callable] = {}


def register_model(task: str, key: str, name: str, builder: Callable) -> None:
    """Add a model to a task; ``builder(engine)`` returns ``predict(requests)``."""
    REGISTRIES[task][key] = name
    EXTRA_BUILDERS[(task, key)] = builder


def unregister_model(task: str, key: str) -> None:
    """Take an added model out again."""
    REGISTRIES[task].pop(key, None)
    EXTRA_BUILDERS.pop((task, key), None)


@dataclass
class ForestSize:
    """Size of a forest; ``None`` takes the default of the builder."""

    trees: int | None = None
    depth: int = 30
    seed: int = 42
    #: Memory of a task for the statistics of the nodes that one pass splits; more of it, fewer passes.
    memory_mb: int = 1024


def _forest(size: ForestSize, trees: int, label: str, min_leaf: int = 1) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol="features",
        labelCol=label,
        weightCol="weight",
        numTrees=size.trees or trees,
        maxDepth=size.depth,
        minInstancesPerNode=min_leaf,
        seed=size.seed,
        cacheNodeIds=True,
        maxMemoryInMB=size.memory_mb,
    )


def _wide_forest(size: ForestSize, trees: int, label: str, stages: list, min_leaf: int = 1) -> ForestClassifier:
    """The forest of many deep trees, on the columns that the feature stages made."""
    codes = next(stage for stage in stages if isinstance(stage, CategoryCodes))
    numbers = [c for c in stages[-1].getInputCols() if c.startswith("f_")]
    return ForestClassifier(
        numbers, codes.out, codes.sizes, label, "weight", size.trees or trees, size.depth, min_leaf, size.seed
    )


def _train_table(df: DataFrame) -> DataFrame:
    """Training rows, written once: fitting passes over them many times."""
    return materialize(df, "train")


def _weighted_table(df: DataFrame, label: str) -> DataFrame:
    """Written training rows with balanced weights as literals, so that no later pass counts the classes again."""
    train = _train_table(df)
    counts = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}  # one row a class
    if not counts:
        raise ValueError("no rows to learn from")
    share = sum(counts.values()) / len(counts)
    weights = F.create_map(*[F.lit(x) for value, count in counts.items() for x in (float(value), share / count)])
    return train.withColumn("_label", F.col(label).cast("double")).withColumn("weight", weights[F.col("_label")])


def _fit(df: DataFrame, stages: list) -> PipelineModel:
    return Pipeline(stages=stages).fit(df)


@dataclass
class SevenClassForest:
    """Risk class of a unit from its own features."""

    pipeline: PipelineModel
    label: str = "riskLabel"
    reference: DataFrame | None = field(default=None, repr=False)

    @classmethod
    def fit(cls, units: DataFrame, size: ForestSize | None = None, label: str = "riskLabel") -> SevenClassForest:
        train = _weighted_table(units.na.drop(subset=[label]).drop("weight"), label)
        stages = feature_stages(
            train,
            standard=["easting", "northing", "elevation"],
            spread=["distanceToWatercourse"],
            categorical=CATEGORIES,
            guess_watercourse=True,
        )
        return cls(_fit(train, [*stages, _wide_forest(size or ForestSize(), 400, "_label", stages, 2)]), label)

    def predict(self, df: DataFrame) -> DataFrame:
        """Add the predicted class, replacing a true label if there is one."""
        keep = [c for c in df.columns if c != self.label]
        scored = self.pipeline.transform(df.select(*keep))
        return scored.select(*keep, F.col("prediction").cast("int").alias(self.label))

    def predict_at(self, points: DataFrame, query_id: str) -> DataFrame:
        """Class of the nearest known unit's features."""
        if self.reference is None:
            raise RuntimeError("reference units are missing")
        near = nearest_one(points, self.reference, query_id).drop("d2")
        return self.predict(near).select(query_id, self.label)


def add_class_probabilities(scored: DataFrame) -> DataFrame:
    """Spread a class probability vector over ``prob_risk_1..7``."""
    df = scored.withColumn("_p", vector_to_array("probability"))
    return df.withColumns(
        {f"prob_risk_{i}": F.coalesce(F.get("_p", F.lit(i)), F.lit(0.0)) for i in RISK_CLASSES}
    ).drop("_p")


@dataclass
class SevenClassProbability:
    """Risk class with probabilities, from unit and district features."""

    pipeline: PipelineModel

    @classmethod
    def fit(cls, units: DataFrame, districts: DataFrame, size: ForestSize | None = None) -> SevenClassProbability:
        train = _weighted_table(probability_features(units, districts).na.drop(subset=["riskLabel"]), "riskLabel")
        base = ["longitude", "latitude", "elevation", "distanceToWatercourse", "medianPrice", "historicallyFlooded"]
        skip = {*ID_COLUMNS, "riskLabel", "weight", "_label", "easting", "northing"}
        numeric, _ = numeric_and_other(train)
        extra = [c for c in numeric if c not in skip and c not in base]
        stages = feature_stages(
            train, standard=[c for c in base if c in train.columns] + extra, categorical=CATEGORIES
        )
        return cls(_fit(train, [*stages, _wide_forest(size or ForestSize(), 300, "_label", stages)]))

    def predict(self, units: DataFrame, districts: DataFrame) -> DataFrame:
        df = probability_features(units, districts)
        scored = add_class_probabilities(self.pipeline.transform(df))
        names = [f"prob_risk_{i}" for i in RISK_CLASSES]
        return scored.select(*units.columns, F.col("prediction").cast("int").alias("predictedRisk"), *names)


def probability_features(units: DataFrame, districts: DataFrame) -> DataFrame:
    return units.join(districts, "postcodeDistrict", "left")


@dataclass
class HistoricForest:
    """Flag of past flooding from every other column of a prepared unit."""

    pipeline: PipelineModel
    features: list[str]
    threshold: float = HISTORIC_THRESHOLD

    @classmethod
    def fit(
        cls, units: DataFrame, size: ForestSize | None = None, target: str = "historicallyFlooded"
    ) -> HistoricForest:
        features = [c for c in units.columns if c not in (*ID_COLUMNS, target, "weight", "fold")]
        numeric, other = numeric_and_other(units, features)
        train = _train_table(units.na.drop(subset=[target]))
        train = fixed_weights(train, target, {0: 1.0, 1: 3.0}).withColumn("_label", F.col(target).cast("double"))
        stages = feature_stages(train, standard=numeric, categorical=other)
        return cls(_fit(train, [*stages, _forest(size or ForestSize(), 5, "_label")]), features)

    def predict(self, df: DataFrame) -> DataFrame:
        """Add the probability and the flag at the decision threshold."""
        scored = self.pipeline.transform(df)
        share = F.coalesce(F.get(vector_to_array("probability"), F.lit(1)), F.lit(0.0))
        return scored.select(
            *df.columns,
            share.alias("predictedFloodProb"),
            (share >= self.threshold).cast("int").alias("predictedHistoricFlooded"),
        )


PRICE_NUMBERS = {
    "sector": ["easting", "northing", "elevation", "distanceToWatercourse", "households", "numberOfPostcodeUnits"],
    "district": ["easting", "northing", "elevation", "distanceToWatercourse", *AGE_PREDICTORS, *AGE_SHARES],
}


#: Rounds without a better one after which boosting has passed its best (published value).
PATIENCE = 15


def best_rounds(errors: Sequence[float], patience: int = PATIENCE) -> int:
    """How many rounds to keep: up to the best one that ``patience`` rounds after it do not beat."""
    best = 0
    for at, error in enumerate(errors):
        if error < errors[best]:
            best = at
        elif at - best >= patience:
            break
    return best + 1


def first_trees(model: GBTRegressionModel, count: int) -> GBTRegressionModel:
    """The ensemble of the first ``count`` trees and weights."""
    if count >= model.getNumTrees:
        return model
    java = model._java_obj
    context = SparkContext._active_spark_context
    trees = context._gateway.new_array(context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, count)
    weights = context._gateway.new_array(context._jvm.double, count)
    for i, (tree, weight) in enumerate(zip(java.trees()[:count], java.treeWeights()[:count], strict=True)):
        trees[i], weights[i] = tree, weight
    cut = context._jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"{java.uid()}_{count}", trees, weights, java.numFeatures())
    for name in ("featuresCol", "labelCol", "predictionCol"):
        cut.set(cut.getParam(name), model.getOrDefault(name))
    return GBTRegressionModel(cut)


@dataclass
class BoostedPrices:
    """Median price from unit and sector (or district) features.

    Trees are boosted on the logarithm of the price. A tenth of the rows, by
    key hash, decides where to stop: the error of every prefix of the ensemble
    is taken on them (``errors``), and the trees after the best round go.
    """

    pipeline: PipelineModel
    merge_with: str = "sector"
    rounds: int = 0
    errors: list[float] = field(default_factory=list)

    @staticmethod
    def merge(units: DataFrame, groups: DataFrame, merge_with: str) -> DataFrame:
        return (unit_sector_merge if merge_with == "sector" else unit_district_merge)(units, groups)

    @classmethod
    def fit(
        cls,
        units: DataFrame,
        groups: DataFrame,
        merge_with: str = "sector",
        rounds: int = 100,
        depth: int = 6,
        seed: int = 42,
        patience: int = PATIENCE,
    ) -> BoostedPrices:
        if merge_with not in PRICE_NUMBERS:
            raise ValueError("merge_with must be 'sector' or 'district'")
        train = _train_table(cls.merge(units, groups, merge_with).na.drop(subset=["medianPrice"]))
        held_out = F.pmod(keyed_hash(F.col("postcode"), seed), F.lit(10)) == 0
        train = train.withColumns({"_label": F.log1p("medianPrice"), "_held_out": held_out})
        # Medians, scales and categories come from the rows that train.
        learned = train.where("not _held_out")
        prepared = _fit(learned, feature_stages(learned, robust=PRICE_NUMBERS[merge_with], categorical=["soilType"]))
        rows = materialize(prepared.transform(train).select("features", "_label", "_held_out"), "price-features")
        learner = GBTRegressor(featuresCol="features", labelCol="_label", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed)
        model, test = learner.fit(rows.where("not _held_out")), rows.where("_held_out")
        errors = [] if test.isEmpty() else list(model.evaluateEachIteration(test, "squared"))
        kept = best_rounds(errors, patience) if errors else model.getNumTrees
        return cls(PipelineModel(stages=[*prepared.stages, first_trees(model, kept)]), merge_with, kept, errors)

    def predict(self, units: DataFrame, groups: DataFrame) -> DataFrame:
        """Predicted price per unit that has group data."""
        merged = self.merge(units, groups, self.merge_with)
        return self.pipeline.transform(merged).select(
            "postcode", F.expm1("prediction").alias("medianPrice")
        )


def fill_age_shares(districts: DataFrame, trees: int = 100, depth: int = 30, seed: int = 42) -> DataFrame:
    """Fill the housing-age shares of districts where all of them are missing.

    One forest per share on cats and dogs per household; the predicted shares
    of a district are scaled to sum to one.
    """
    needed = [*AGE_PREDICTORS, *AGE_SHARES]
    absent = [c for c in needed if c not in districts.columns]
    if absent:
        raise ValueError(f"missing required columns: {absent}")
    blank = F.lit(True)
    for c in AGE_SHARES:
        blank = blank & F.col(f"`{c}`").isNull()
    empty = districts.where(blank)
    if empty.isEmpty():
        return districts
    # A district without a predictor takes its median, so none is lost.
    middle = scalars(medians(districts, list(AGE_PREDICTORS)))
    guessed = [f"_p_{c}" for c in AGE_PREDICTORS]
    assemble = VectorAssembler(inputCols=guessed, outputCol="_features")

    def featured(df: DataFrame) -> DataFrame:
        known = {f"_p_{c}": F.coalesce(F.col(c).cast("double"), F.lit(middle[c]), F.lit(0.0)) for c in AGE_PREDICTORS}
        return assemble.transform(df.withColumns(known))

    train = _train_table(featured(districts.where(~blank)))
    filled = featured(empty)
    for c in AGE_SHARES:
        forest = RandomForestRegressor(
            featuresCol="_features", labelCol=c, predictionCol="_share", numTrees=trees, maxDepth=depth, seed=seed
        )
        model = forest.fit(train.na.drop(subset=[c]))
        filled = model.transform(filled).drop(c).withColumnRenamed("_share", c)
    filled = shares_of_row(filled.drop("_features"), AGE_SHARES)
    return districts.where(~blank).unionByName(filled.select(*districts.columns))

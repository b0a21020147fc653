"""Scores of predictions against the truth.

Every score is an aggregate over (truth, prediction) counts or sums, so the
data is read once and only counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import CLASS_SCORES, RISK_CLASSES


def confusion_matrix(df: DataFrame, truth: str, prediction: str, labels: Sequence = RISK_CLASSES) -> DataFrame:
    """Counts for every pair of labels, zeros included."""
    spark = df.sparkSession
    kind = df.schema[truth].dataType
    counts = df.groupBy(F.col(truth).alias("truth"), F.col(prediction).cast(kind).alias("prediction")).count()
    lattice = spark.createDataFrame([(t, p) for t in labels for p in labels], ["truth", "prediction"]).select(
        F.col("truth").cast(kind), F.col("prediction").cast(kind)
    )
    return lattice.join(counts, ["truth", "prediction"], "left").na.fill(0, ["count"])


def _safe_ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def classification_report(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, averages, and accuracy.

    Undefined ratios are 0. The accuracy row holds the accuracy in ``f1``.
    """
    kind = df.schema[truth].dataType
    counts = df.groupBy(F.col(truth).alias("t"), F.col(prediction).cast(kind).alias("p")).count()
    sides = F.array(
        F.struct(F.col("t").alias("label"), F.col("count").alias("support"), F.lit(0).cast("bigint").alias("called")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("count").alias("called")),
    )
    hit = F.when(F.col("t") == F.col("p"), F.col("count")).otherwise(0)
    per_class = (
        counts.select("t", hit.alias("hit"), F.inline(sides))
        .groupBy("label")
        .agg(
            F.sum("support").alias("support"),
            F.sum("called").alias("called"),
            F.sum(F.when(F.col("support") > 0, F.col("hit")).otherwise(0)).alias("hit"),
        )
        .select(
            F.col("label").cast("string").alias("label"),
            _safe_ratio(F.col("hit"), F.col("called")).alias("precision"),
            _safe_ratio(F.col("hit"), F.col("support")).alias("recall"),
            _safe_ratio(2 * F.col("hit"), F.col("called") + F.col("support")).alias("f1"),
            "support",
            "hit",
        )
    )
    scores = ["precision", "recall", "f1"]
    total = F.sum("support")
    overall = per_class.agg(
        F.inline(
            F.array(
                F.struct(
                    F.lit("macro avg").alias("label"), *[F.avg(s).alias(s) for s in scores], total.alias("support")
                ),
                F.struct(
                    F.lit("weighted avg").alias("label"),
                    *[(F.sum(F.col(s) * F.col("support")) / total).alias(s) for s in scores],
                    total.alias("support"),
                ),
                F.struct(
                    F.lit("accuracy").alias("label"),
                    F.lit(None).cast("double").alias("precision"),
                    F.lit(None).cast("double").alias("recall"),
                    (F.sum("hit") / total).alias("f1"),
                    total.alias("support"),
                ),
            )
        )
    )
    return per_class.drop("hit").unionByName(overall)


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom)


def binary_metrics(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """True/false positives/negatives and the ratios made of them; NULL if undefined."""
    t, p = F.col(truth).cast("boolean"), F.col(prediction).cast("boolean")
    counts = df.agg(
        F.count_if(p & t).alias("tp"),
        F.count_if(p & ~t).alias("fp"),
        F.count_if(~p & ~t).alias("tn"),
        F.count_if(~p & t).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.select(
        "*",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_score(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Total and mean of the class score matrix."""
    matrix = F.array(*[F.array(*[F.lit(v) for v in row]) for row in CLASS_SCORES])
    row = F.get(matrix, F.col(prediction).cast("int") - 1)
    score = F.get(row, F.col(truth).cast("int") - 1).cast("bigint")
    counts = df.groupBy(truth, prediction).count()
    return counts.agg(
        F.sum(score * F.col("count")).alias("score"),
        (F.sum(score * F.col("count")) / F.sum("count")).alias("mean_score"),
    )


def price_errors(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Root mean square error where both are known, and counts of the gaps."""
    t, p = F.col(truth).cast("double"), F.col(prediction).cast("double")
    return df.agg(
        F.sqrt(F.avg((p - t) * (p - t))).alias("rmse"),
        F.count_if(p.isNull() & t.isNotNull()).alias("missing_prediction"),
        F.count_if(p.isNull() & t.isNull()).alias("missing_both"),
    )


def regression_metrics(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """RMSE, mean absolute error and coefficient of determination."""
    df = df.select(F.col(truth).cast("double").alias("t"), F.col(prediction).cast("double").alias("p")).na.drop("any")
    gap = F.col("p") - F.col("t")
    return df.agg(
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(F.abs(gap)).alias("mae"),
        (1 - F.sum(gap * gap) / (F.var_pop("t") * F.count("t"))).alias("r2"),
    )


def accuracy(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    same = F.coalesce((F.col(truth) == F.col(prediction)).cast("int"), F.lit(0))
    return df.agg(F.avg(same).alias("accuracy"), F.count("*").alias("n"))

"""Cross-validation and comparison of registered models."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tidemark.operators.ranking import stratified_folds
from tidemark.session import materialize


#: Folds that are fitted at the same time: more of them only hold more plans, broadcasts and threads on the driver.
FOLDS_AT_ONCE = 2


def in_pools(spark: SparkSession, jobs: Sequence[Callable[[], object]], name: str, at_once: int | None = None) -> list:
    """Results of jobs that run at the same time, all or ``at_once`` of them, each in a scheduler pool of its own so that they share the executors evenly."""

    def run(numbered: tuple[int, Callable[[], object]]) -> object:
        number, job = numbered
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{name}-{number}")
        try:
            return job()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    if not jobs:
        return []
    with ThreadPoolExecutor(min(len(jobs), at_once or len(jobs))) as pool:
        return [future.result() for future in [pool.submit(inheritable_thread_target(spark)(run), job) for job in enumerate(jobs)]]


def out_of_fold(
    df: DataFrame,
    label: str,
    key: str,
    fit: Callable[[DataFrame], object],
    predict: Callable[[object, DataFrame], DataFrame],
    folds: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Predictions for every row from a model that did not see it, with the seconds that its fold took.

    Folds are a column of one written table. FOLDS_AT_ONCE models are fitted at the
    same time; ``fit_seconds`` and ``predict_seconds`` are wall-clock figures of a
    fold that shares the executors with the others.
    """
    folded = materialize(stratified_folds(df, label, key, folds, seed), "folds")

    def one(i: int) -> DataFrame:
        start = time.perf_counter()
        model = fit(folded.where(f"fold <> {i}").drop("fold"))
        fitted = time.perf_counter()
        found = materialize(predict(model, folded.where(f"fold = {i}")), "fold-predictions")
        done = time.perf_counter()
        return found.withColumns({"fit_seconds": F.lit(fitted - start), "predict_seconds": F.lit(done - fitted)})

    return reduce(DataFrame.unionByName, in_pools(df.sparkSession, [partial(one, i) for i in range(folds)], "fold", FOLDS_AT_ONCE))


def compare_models(
    spark: SparkSession,
    models: dict[str, str],
    fit: Callable[[str], object],
    score: Callable[[str], DataFrame],
) -> DataFrame:
    """One row per model: seconds to fit and to predict, scores, or the failure.

    ``score(key)`` gives the one-row metric table of a model's predictions; the
    caller sees to it that they are of rows that ``fit`` did not learn from.
    """
    rows = []
    for key, name in models.items():
        row = {"model": key, "name": name, "fit_seconds": None, "predict_seconds": None, "scores": None, "failure": None}
        try:
            start = time.perf_counter()
            fit(key)
            row["fit_seconds"] = time.perf_counter() - start
            start = time.perf_counter()
            facts = score(key).first().asDict()
            row["predict_seconds"] = time.perf_counter() - start
            row["scores"] = {k: float(v) for k, v in facts.items() if v is not None}
        except Exception as error:  # noqa: BLE001 - a failing model is a result here
            row["failure"] = f"{type(error).__name__}: {error}"
        rows.append(row)
    return spark.createDataFrame(
        rows,
        "model string, name string, fit_seconds double, predict_seconds double, scores map<string, double>, failure string",
    )

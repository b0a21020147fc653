"""A store of fitted pipelines: numbered versions, each with a manifest, visible only when whole."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import folders_in

MANIFEST = "manifest"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions that are there, ascending."""
    return [int(name[1:]) for name in folders_in(spark, root, MANIFEST) if name.startswith("v")]


def save(model: PipelineModel, root: str, train: DataFrame, inputs: Sequence[str], metrics: dict[str, float] | None = None) -> int:
    """Write a fitted pipeline as the next version and give its number.

    The manifest holds the input columns with their types, the number of training
    rows and the metrics. Everything is written under a name that readers pass
    over; the last step renames it, so a save that was cut off is never seen.
    """
    spark = train.sparkSession
    types = dict(train.dtypes)
    facts = {"columns": {c: types[c] for c in inputs}, "rows": train.count(), "metrics": metrics or {}}
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    hidden = f"{root}/_writing-{uuid.uuid4().hex}"
    model.write().save(f"{hidden}/pipeline")
    spark.createDataFrame([(json.dumps(facts),)], "facts string").coalesce(1).write.text(f"{hidden}/{MANIFEST}")
    number = max(versions(spark, root), default=0) + 1
    while system.exists(path(f"{root}/v{number:06d}")) or not system.rename(path(hidden), path(f"{root}/v{number:06d}")):
        if not system.exists(path(hidden)):
            raise RuntimeError(f"{hidden} could not be made visible")
        number += 1
    return number


def manifest(spark: SparkSession, root: str, version: int) -> dict:
    return json.loads(spark.read.text(f"{root}/v{version:06d}/{MANIFEST}").first()[0])


def load(spark: SparkSession, root: str, rows: DataFrame | None = None, version: int | None = None) -> PipelineModel:
    """The newest version, or the one asked for; ``rows`` that it is meant for have to have its input columns and types."""
    known = versions(spark, root)
    if version is None:
        if not known:
            raise FileNotFoundError(f"no model in {root}")
        version = known[-1]
    elif version not in known:
        raise FileNotFoundError(f"no version {version} in {root}")
    if rows is not None:
        types = dict(rows.dtypes)
        for column, wanted in manifest(spark, root, version)["columns"].items():
            if column not in types:
                raise ValueError(f"column {column!r} is missing")
            if types[column] != wanted:
                raise ValueError(f"column {column!r} is {types[column]}, the model takes {wanted}")
    return PipelineModel.load(f"{root}/v{version:06d}/pipeline")

"""Readers and writers of entity tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.readings import event_time, number_or_null
from tidemark.schemas import ENTITIES


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers as NULL: Spark would sort NaN above every value."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({n: F.when(~F.isnan(F.col(f"`{n}`")), F.col(f"`{n}`")) for n in floats})


def spread(df: DataFrame) -> DataFrame:
    """The same rows, dealt to all cores if fewer tasks read them: a file of one row group is read by one."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


class Library:
    """Entity tables under one base folder: ``raw``, ``example``, ``preprocessed``.

    Nothing is read until used.
    """

    FOLDERS = {"raw": "", "example": "example_data", "preprocessed": "preprocessed_data"}

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def path(self, name: str, kind: str = "raw") -> str:
        return "/".join(part for part in (self.base, self.FOLDERS[kind], name) if part)

    def csv(self, name: str, entity: str, kind: str = "raw") -> DataFrame:
        return read_csv(self.spark, self.path(name, kind), entity)

    def parquet(self, name: str, kind: str = "raw") -> DataFrame:
        return self.spark.read.parquet(self.path(name, kind))


def read_csv(spark: SparkSession, path: str, entity: str | T.StructType) -> DataFrame:
    schema = ENTITIES[entity] if isinstance(entity, str) else entity
    return nan_to_null(spark.read.schema(schema).option("header", True).csv(path))


def stations(source: str | DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Station table from a path, or the given table as it is."""
    return source if isinstance(source, DataFrame) else read_csv(spark, source, "stations")


def station_readings(df: DataFrame, station: str | None = None) -> DataFrame:
    """Readings with parsed time and numeric value, in time order.

    With a station, only its rows and without the station column.
    """
    df = df.withColumns({"dateTime": event_time(F.col("dateTime")), "value": number_or_null(F.col("value"))})
    if station is not None:
        return df.where(F.col("stationReference") == station).drop("stationReference").orderBy("dateTime")
    return df.orderBy("stationReference", "dateTime")


def write_table(df: DataFrame, path: str, form: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Replace the table at ``path``; CSV gets a header row."""
    writer = df.write.mode("overwrite").format(form)
    if form == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path

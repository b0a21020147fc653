"""Station readings as Structured Streaming jobs.

Sources are folders of landed files. Every job keeps its state and its result
in the shared folder, runs until the landed files are used up, and can be
started again on the same checkpoint. Each has a batch form with the same
answer: the functions that build the frames take either kind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numeric import rain_class
from tidemark.functions.readings import clean_value
from tidemark.operators.ranking import keep_priority
from tidemark.session import delete_folder, folders_in, fresh_path

LATENESS = "1 hour"
WINDOW = "1 hour"


def landed_files(spark: SparkSession, folder: str, schema: T.StructType, glob: str, form: str = "parquet") -> DataFrame:
    """Stream of the files of a folder whose names match a pattern."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).format(form).load(folder)


def clean_readings(readings: DataFrame) -> DataFrame:
    """Readings with a real timestamp and a single number as value."""
    return readings.withColumns(
        {"dateTime": F.col("dateTime").cast("timestamp"), "value": clean_value(F.col("value"))}
    )


def run_to_table(df: DataFrame, name: str) -> DataFrame:
    """Run a stream in append mode over all landed files and read the result."""
    spark = df.sparkSession
    out = fresh_path(spark, name)
    query = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", fresh_path(spark, f"{name}-state"))
        .option("path", out)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def latest_state(readings: DataFrame) -> DataFrame:
    """Latest reading per station and parameter; a missing time counts as last, as in the batch form.

    The value travels in a struct with its time, so that partial results merge
    on every executor before they meet.
    """
    latest = F.max(F.struct(F.col("dateTime").isNull().alias("timeless"), "dateTime", "value", "unitName"))
    return readings.groupBy("stationReference", "parameter").agg(latest.alias("_last")).select(
        "stationReference", "parameter", "_last.dateTime", "_last.value", "_last.unitName"
    )


STATION = ["stationReference", "parameter"]


class LatestTable:
    """A written table with one row per station, folded anew with what each trigger changed.

    A version is a folder that was written to the end. The newest one and the
    changes make the next, and then the older ones are deleted; so the store
    never holds more than a row per station and version. A trigger that is
    repeated after a failure folds the same rows in again, which changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def versions(self) -> list[str]:
        return folders_in(self.spark, self.path)

    def read(self) -> DataFrame:
        known = self.versions()
        if not known:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{known[-1]}")

    def fold(self, changed: DataFrame) -> None:
        known = self.versions()
        number = int(known[-1][1:]) + 1 if known else 0
        newest = changed if not known else upsert_rows(self.read(), changed, STATION)
        newest.write.mode("overwrite").parquet(f"{self.path}/v{number:09d}")
        for old in known:
            delete_folder(self.spark, f"{self.path}/{old}")


def upsert_rows(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` and those of ``base`` whose keys ``new`` does not have; each table is read once."""
    both = base.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return keep_priority(both, keys, [F.col("_new").desc()]).drop("_new")


def run_latest(readings: DataFrame, name: str = "latest", out: str | None = None, state_path: str | None = None) -> DataFrame:
    """Keep the latest reading per station from a stream, in one table of a row per station.

    With ``out`` and ``state_path`` of an earlier run it goes on from there.
    """
    spark = readings.sparkSession
    state = latest_state(readings)
    table = LatestTable(spark, out or fresh_path(spark, name), state.schema)
    query = (
        state.writeStream.outputMode("update")
        .option("checkpointLocation", state_path or fresh_path(spark, f"{name}-state"))
        .foreachBatch(lambda changed, epoch: table.fold(changed))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return table.read()


def hourly_rain(readings: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Rain per station and hour with its class; later data than ``lateness`` is cut off."""
    rain = readings.where("parameter = 'rainfall' and value is not null")
    hours = rain.withWatermark("dateTime", lateness).groupBy("stationReference", F.window("dateTime", WINDOW))
    total = F.sum("value")
    return hours.agg(total.alias("rain")).select(
        "stationReference",
        F.col("window.start").alias("hour"),
        "rain",
        rain_class(F.col("rain")).alias("class"),
    )


def station_limits(stations: DataFrame) -> DataFrame:
    """One typical high per station; of several the lowest, which alerts first."""
    return stations.groupBy("stationReference").agg(F.min("typicalRangeHigh").alias("typicalRangeHigh")).where("typicalRangeHigh is not null")


def level_alerts(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Level readings above the typical high of their station; a station that is listed twice alerts once."""
    level = readings.where("parameter = 'level' and value is not null")
    return level.join(station_limits(stations), "stationReference").where(F.col("value") > F.col("typicalRangeHigh")).select(
        "stationReference", "dateTime", "value", "typicalRangeHigh"
    )


def run_alerts(
    readings: DataFrame,
    stations: Callable[[], DataFrame],
    name: str = "alerts",
    lateness: str = LATENESS,
) -> DataFrame:
    """Alerts of a stream against limits that may change: ``stations()`` is read anew at every trigger.

    A reading that lands again within ``lateness`` alerts once; readings later
    than that, and those without a time, are cut off. Every trigger replaces
    its own output, so a repeated one doubles nothing.
    """
    spark = readings.sparkSession
    out = fresh_path(spark, name)
    level = readings.where("parameter = 'level' and value is not null and dateTime is not null")
    once = level.withWatermark("dateTime", lateness).dropDuplicatesWithinWatermark(["stationReference", "dateTime", "value"])

    def store(batch: DataFrame, epoch: int) -> None:
        level_alerts(batch, stations()).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    query = (
        once.writeStream.outputMode("append")
        .option("checkpointLocation", fresh_path(spark, f"{name}-state"))
        .foreachBatch(store)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = level_alerts(readings, stations()).schema
    if not folders_in(spark, out):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out).drop("epoch")

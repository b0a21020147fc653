"""Streams against their batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.catalog.streams import reading_stream
from tidemark.streaming.readings import LatestTable, clean_readings, hourly_rain, landed_files, latest_state, run_alerts, run_latest, run_to_table
from tidemark.schemas import READING
from tidemark.session import folders_in, fresh_path


def same(left, right):
    names = sorted(left.columns)
    assert left.select(names).exceptAll(right.select(names)).isEmpty()
    assert right.select(names).exceptAll(left.select(names)).isEmpty()


def test_clean_stream(views):
    same(run_to_table(reading_stream(views), "readings"), clean_readings(views.readings))


def test_latest_over_several_files(spark, views):
    """A null latest value stays the latest; late files do not win over newer times."""
    folder = fresh_path(spark, "landed")
    rows = [
        ("2024-01-01 00:00:00", "A", "rainfall", "q", "mm", "1"),
        ("2024-01-01 02:00:00", "A", "rainfall", "q", "mm", "bad"),
        ("2024-01-01 01:00:00", "A", "rainfall", "q", "mm", "3"),
        ("2024-01-01 01:00:00", "B", "level", "q", "mASD", "0.5|0.6"),
    ]
    table = spark.createDataFrame(rows, "t string, stationReference string, parameter string, qualifier string, unitName string, value string")
    table = table.select(F.to_timestamp("t").alias("dateTime"), *[c for c in table.columns if c != "t"])
    for i in range(4):
        table.limit(i + 1).subtract(table.limit(i)).coalesce(1).write.mode("append").parquet(folder)
    stream = landed_files(spark, folder, READING, "*.parquet")
    got = run_latest(clean_readings(stream))
    same(got, latest_state(clean_readings(table)))
    assert {r["stationReference"]: r["value"] for r in got.collect()} == {"A": None, "B": 0.5}


def test_hourly_rain_is_the_closed_part_of_the_batch(views):
    closed = run_to_table(hourly_rain(reading_stream(views)), "rain")
    batch = hourly_rain(clean_readings(views.readings))
    names = ["stationReference", "hour", "class"]
    assert closed.select(names).exceptAll(batch.select(names)).isEmpty()
    newest = batch.agg(F.max("hour")).first()[0]
    open_hours = batch.join(closed, ["stationReference", "hour"], "left_anti")
    assert open_hours.where(F.col("hour") < F.lit(newest) - F.expr("interval 3 hours")).isEmpty()


READINGS = "t string, stationReference string, parameter string, qualifier string, unitName string, value string"


def landed(spark, folder, rows):
    """Each row in a file of its own, so that every one can be a trigger."""
    for row in rows:
        table = spark.createDataFrame([row], READINGS)
        table.select(F.to_timestamp("t").alias("dateTime"), *[c for c in table.columns if c != "t"]).coalesce(1).write.mode("append").parquet(folder)


def stream_of(spark, folder):
    return clean_readings(spark.readStream.schema(READING).option("maxFilesPerTrigger", 1).parquet(folder))


def test_latest_store_is_folded(spark):
    """After many triggers the store has a row per station, and a second run goes on from it."""
    folder, out, state = (fresh_path(spark, name) for name in ("landed", "latest", "latest-state"))
    rows = [(f"2024-01-01 {i:02d}:00:00", f"S{i % 3}", "rainfall", "q", "mm", str(i)) for i in range(17)]
    landed(spark, folder, rows[:12])
    run_latest(stream_of(spark, folder), out=out, state_path=state)
    landed(spark, folder, rows[12:])
    got = run_latest(stream_of(spark, folder), out=out, state_path=state)
    assert {r["stationReference"]: r["value"] for r in got.collect()} == {"S0": 15.0, "S1": 16.0, "S2": 14.0}
    assert len(folders_in(spark, out)) == 1 and spark.read.parquet(out + "/*").count() == 3


def test_folding_again_changes_nothing(spark):
    schema = "stationReference string, parameter string, value double"
    table = LatestTable(spark, fresh_path(spark, "latest"), spark.createDataFrame([], schema).schema)
    assert table.read().count() == 0
    table.fold(spark.createDataFrame([("A", "level", 1.0), ("B", None, 2.0)], schema))
    changed = spark.createDataFrame([("B", None, 3.0), ("C", "level", None)], schema)
    table.fold(changed)
    once = sorted(table.read().collect(), key=str)
    table.fold(changed)
    assert sorted(table.read().collect(), key=str) == once and len(once) == 3


def test_alerts_are_single_and_follow_the_limits(spark):
    """A station listed twice and a reading that lands twice alert once; limits are read at every trigger."""
    folder = fresh_path(spark, "landed")
    rows = [
        ("2024-01-01 00:00:00", "A", "level", "q", "m", "5"),
        ("2024-01-01 00:00:00", "A", "level", "q", "m", "5"),
        ("2024-01-01 00:10:00", "B", "level", "q", "m", "5"),
        ("2024-01-01 00:20:00", "A", "rainfall", "q", "mm", "50"),
    ]
    landed(spark, folder, rows)
    stations = spark.createDataFrame([("A", 1.0), ("A", 2.0), ("A", None), ("B", 9.0), ("C", None)], "stationReference string, typicalRangeHigh double")
    got = run_alerts(stream_of(spark, folder), lambda: stations)
    assert [(r["stationReference"], r["value"], r["typicalRangeHigh"]) for r in got.collect()] == [("A", 5.0, 1.0)]
    calls = []

    def changing():
        calls.append(1)
        return stations if len(calls) < 3 else stations.withColumn("typicalRangeHigh", F.col("typicalRangeHigh") / 10)

    got = run_alerts(stream_of(spark, folder), changing)
    assert len(calls) >= 4 and {r["stationReference"] for r in got.collect()} >= {"A"} and got.count() <= 2

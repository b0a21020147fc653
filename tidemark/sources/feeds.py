"""Landed JSON payloads of the public readings and weather services."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.readings import (
    event_time,
    measure_qualifier,
    measure_station,
    measure_unit,
    number_or_null,
    tidy_qualifier,
)
from tidemark.schemas import READINGS_PAYLOAD, weather_payload

CURRENT = ("temperature_2m", "rain")
HOURLY = ("temperature_2m", "relative_humidity_2m", "rain")


def payload_items(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per entry of the ``items`` list of a readings payload."""
    return df.select(F.inline(F.from_json(payload, READINGS_PAYLOAD)["items"]))


def latest_rainfall(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Clean table of the latest rainfall readings; incomplete rows are dropped."""
    items = payload_items(df, payload)
    measure = F.col("`@id`")
    return (
        items.select(
            measure_station(measure).alias("stationReference"),
            event_time(F.col("dateTime")).alias("dateTime"),
            number_or_null(F.col("value")).alias("value"),
            measure_qualifier(measure).alias("qualifier"),
            measure_unit(measure).alias("unitName"),
            F.lit("rainfall").alias("parameter"),
        )
        .na.drop("any")
        .orderBy("stationReference", "dateTime")
        # After the sort, which reads its input twice to choose ranges.
        .withColumn("qualifier", tidy_qualifier(F.col("qualifier")))
    )


def weather_now(df: DataFrame, payload: str = "payload", current: Sequence[str] = CURRENT, keep: Sequence[str] = ()) -> DataFrame:
    """One row per weather payload with its current values."""
    parsed = F.from_json(payload, weather_payload(list(current), list(HOURLY)))
    df = df.select(*keep, parsed.alias("_w"))
    return df.select(
        *keep,
        event_time(F.col("_w.current.time")).alias("time"),
        *[F.col(f"_w.current.{name}").alias(name) for name in current],
    )


def weather_hours(df: DataFrame, payload: str = "payload", hourly: Sequence[str] = HOURLY, keep: Sequence[str] = ()) -> DataFrame:
    """One row per hour of a weather payload's parallel arrays."""
    parsed = F.from_json(payload, weather_payload(list(CURRENT), list(hourly)))
    df = df.select(*keep, parsed.alias("_w"))
    series = F.arrays_zip("_w.hourly.time", *[f"_w.hourly.{name}" for name in hourly])
    df = df.select(*keep, F.inline(series))
    return df.select(*keep, event_time(F.col("time")).alias("time"), *hourly)

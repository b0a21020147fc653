"""Schemas of the entity tables, declared so that no read has to infer one."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _D, _L, _I, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.TimestampType()

UNIT = _schema(
    ("postcode", _S),
    ("easting", _L),
    ("northing", _L),
    ("soilType", _S),
    ("elevation", _D),
    ("nearestWatercourse", _S),
    ("distanceToWatercourse", _D),
    ("localAuthority", _S),
)
LABELLED_UNIT = T.StructType(
    UNIT.fields
    + _schema(("riskLabel", _I), ("medianPrice", _D), ("historicallyFlooded", _I)).fields
)
SECTOR = _schema(("postcodeSector", _S), ("households", _L), ("numberOfPostcodeUnits", _L), ("headcount", _L))
DISTRICT = _schema(
    ("postcodeDistrict", _S),
    ("catsPerHousehold", _D),
    ("dogsPerHousehold", _D),
    ("pre_1900", _D),
    ("1900_1929", _D),
    ("1930_1945", _D),
    ("1945_1964", _D),
    ("1965_1982", _D),
    ("1983_1999", _D),
    ("2000_present", _D),
    ("unknown", _D),
)
STATION = _schema(
    ("stationReference", _S),
    ("stationName", _S),
    ("latitude", _D),
    ("longitude", _D),
    ("maxOnRecord", _D),
    ("minOnRecord", _D),
    ("typicalRangeHigh", _D),
    ("typicalRangeLow", _D),
)
READING = _schema(
    ("dateTime", _TS),
    ("stationReference", _S),
    ("parameter", _S),
    ("qualifier", _S),
    ("unitName", _S),
    ("value", _S),
)
# The driver's event table, as a stream source must have it spelled out.
EVENT = T.StructType(
    [
        T.StructField("event_id", _L),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", _L),
        T.StructField("event_type", _S),
        T.StructField("value", _D),
        T.StructField("props", _S),
    ]
)
# Landed payloads of the readings service and of the weather service.
READINGS_PAYLOAD = "struct<items: array<struct<`@id`: string, dateTime: string, measure: string, value: string>>>"

ENTITIES = {
    "unit": UNIT,
    "labelled": LABELLED_UNIT,
    "sector_data": SECTOR,
    "district_data": DISTRICT,
    "stations": STATION,
    "readings": READING,
}


def weather_payload(current: list[str], hourly: list[str]) -> str:
    now = ", ".join(f"`{name}`: double" for name in current)
    series = ", ".join(f"`{name}`: array<double>" for name in hourly)
    return f"struct<current: struct<time: string, {now}>, hourly: struct<time: array<string>, {series}>>"

"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.evaluate import classification_report
from tidemark.operators.ranking import keyed_hash
from tidemark.plans.catalog import query
from tidemark.plans.catalog.common import plain_time, rounded
from tidemark.schemas import LABELLED_UNIT, STATION
from tidemark.session import fresh_path
from tidemark.sources.feeds import latest_rainfall, payload_items, weather_hours, weather_now
from tidemark.sources.tables import Library, spread, station_readings, stations, write_table
from tidemark.sources.views import Views


@query(
    "src1_read_entity_csv",
    "select postcode, easting, northing, soilType, elevation, nearestWatercourse, distanceToWatercourse,"
    " localAuthority, riskLabel, medianPrice, historicallyFlooded from unit",
    ("unit",),
)
def src1(v: Views):
    base = fresh_path(v.spark, "library")
    table = v.unit.select(*[F.col(f.name).cast(f.dataType) for f in LABELLED_UNIT.fields])
    library = Library(v.spark, base)
    write_table(table, library.path("postcodes_labelled.csv", "example"), "csv")
    return library.csv("postcodes_labelled.csv", "labelled", "example")


@query("src2_read_stations", "select * from stations", ("stations",))
def src2(v: Views):
    path = fresh_path(v.spark, "stations")
    write_table(v.stations.select(*STATION.names), path, "csv")
    return stations(stations(path, v.spark))


@query(
    "src3_read_readings",
    "select dateTime, stationReference, parameter, unitName, try_cast(value as double) as value from readings",
    ("readings",),
)
def src3(v: Views):
    return plain_time(station_readings(v.readings))


@query(
    "src3_read_one_station",
    "select dateTime, parameter, unitName, try_cast(value as double) as value from readings"
    " where stationReference = 'ST7'",
    ("readings",),
)
def src3_station(v: Views):
    return plain_time(station_readings(v.readings, "ST7"))


def readings_payloads(v: Views):
    """One landed readings payload per event: a good item, a broken id, a bad value."""
    when = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
    station = "cast(user_id as string)"
    number = "cast(cast(floor(value * 100 + 0.5) as bigint) as string)"
    item = (
        "concat('{{\"@id\":\"{id}\",\"dateTime\":\"', {when}, '\",\"measure\":\"m\",\"value\":', {value}, '}}')"
    )
    good_id = (
        "http://x/id/measures/', {s}, 'TH-rainfall-tipping_bucket_raingauge-t-15_min-mm/readings/2025"
    ).format(s=station)
    items = [
        item.format(id=good_id, when=when, value=number),
        item.format(id="http://x/none", when=when, value=number),
        item.format(id=good_id, when=when, value="'null'"),
    ]
    text = "concat('{\"items\":[', " + ", ',', ".join(items) + ", ']}')"
    events = spread(v.table("events").select("event_id", "ts", "user_id", "value"))
    return events.selectExpr("event_id", f"{text} as payload")


@query(
    "src4_latest_rainfall_payload",
    """select concat(cast(user_id as varchar), 'TH') as stationReference, date_trunc('second', ts) as dateTime,
         floor(value * 100 + 0.5) * 1.0e0 as value, 'Tipping Bucket Raingauge' as qualifier, 'mm/readings' as unitName,
         'rainfall' as parameter from events""",
)
def src4(v: Views):
    return plain_time(latest_rainfall(readings_payloads(v)))


@query(
    "src5_station_payload",
    """with e as (select strftime(ts, '%Y-%m-%dT%H:%M:%S') as t, cast(user_id as varchar) as s,
          cast(cast(floor(value * 100 + 0.5) as bigint) as varchar) as n from events)
       select concat('http://x/id/measures/', s, 'TH-rainfall-tipping_bucket_raingauge-t-15_min-mm/readings/2025') as id,
         t as dateTime, 'm' as measure, n as value from e
       union all select 'http://x/none', t, 'm', n from e
       union all select concat('http://x/id/measures/', s, 'TH-rainfall-tipping_bucket_raingauge-t-15_min-mm/readings/2025'),
         t, 'm', null from e""",
)
def src5(v: Views):
    return payload_items(readings_payloads(v)).withColumnRenamed("@id", "id")


def weather_payloads(v: Views):
    """One landed weather payload per event, with two hours of forecast."""
    day = "date_format(ts, 'yyyy-MM-dd')"
    number = "cast(event_id % 40 as string)"
    text = f"""concat('{{"current":{{"time":"', {day}, 'T06:00","temperature_2m":', {number}, ',"rain":0.5}},',
      '"hourly":{{"time":["', {day}, 'T00:00","', {day}, 'T01:00"],"temperature_2m":[', {number}, ',7],',
      '"relative_humidity_2m":[80,null],"rain":[0.25,', {number}, ']}}}}')"""
    return v.table("events").selectExpr("event_id", f"{text} as payload")


@query(
    "src6_weather_now",
    """select event_id, date_trunc('day', ts) + interval 6 hour as time, (event_id % 40) * 1.0e0 as temperature_2m,
         0.5e0 as rain from events""",
)
def src6_now(v: Views):
    return plain_time(weather_now(weather_payloads(v), keep=["event_id"]), "time")


@query(
    "src6_weather_hours",
    """select event_id, date_trunc('day', ts) as time, (event_id % 40) * 1.0e0 as temperature_2m,
         80.0e0 as relative_humidity_2m, 0.25e0 as rain from events
       union all select event_id, date_trunc('day', ts) + interval 1 hour, 7.0e0, null, (event_id % 40) * 1.0e0
         from events""",
)
def src6_hours(v: Views):
    return plain_time(weather_hours(weather_payloads(v), keep=["event_id"]), "time")


@query("snk1_write_preprocessed", "select * from unit", ("unit",))
def snk1(v: Views):
    return v.spark.read.parquet(write_table(v.unit, fresh_path(v.spark, "preprocessed")))


REPORT_SQL = """with p as (select riskLabel as t, cast(1 + (('0x' || substr(md5(cast(k as varchar) || ':42'), 1, 12))::bigint % 1000003) % 7 as int) as p from unit),
cls as (select label, sum(s) as support, sum(c) as called, sum(h) as hit from (
  select t as label, 1 as s, 0 as c, case when t = p then 1 else 0 end as h from p
  union all select p, 0, 1, 0 from p) group by label),
r as (select label, case when called > 0 then hit * 1.0e0 / called else 0.0e0 end as precision,
  case when support > 0 then hit * 1.0e0 / support else 0.0e0 end as recall,
  case when called + support > 0 then 2.0e0 * hit / (called + support) else 0.0e0 end as f1, support, hit from cls),
a as (select cast(label as varchar) as label, precision, recall, f1, support from r
  union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from r
  union all select 'weighted avg', sum(precision*support)/sum(support), sum(recall*support)/sum(support),
    sum(f1*support)/sum(support), sum(support) from r
  union all select 'accuracy', null, null, sum(hit)*1.0e0/sum(support), sum(support) from r)
select label, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1,
  cast(support as bigint) as support from a"""


def guessed_classes(v: Views):
    """Truth next to a fixed pseudo-random guess."""
    guess = 1 + F.pmod(keyed_hash(F.col("k")), F.lit(7))
    return v.unit.select("k", "postcode", "riskLabel", guess.cast("int").alias("guess"))


@query("snk3_write_report", REPORT_SQL, ("unit",))
def snk3(v: Views):
    report = rounded(classification_report(guessed_classes(v), "riskLabel", "guess"), 9, "precision", "recall", "f1")
    return v.spark.read.parquet(write_table(report, fresh_path(v.spark, "report")))

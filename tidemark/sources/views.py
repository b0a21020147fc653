"""Domain views over the driver tables.

The driver's tables carry no postcodes, so units, sectors, districts, stations
and readings are derived from them by fixed arithmetic. One SQL text per view
serves Spark and DuckDB alike; identifiers that start with a digit are quoted
with backticks here and with double quotes there.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# View name -> (views or tables it reads, text).
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "unit": (
        ("customer", "nation",),
        """
with c as (select c_custkey as k, cast(floor(c_custkey/20) as bigint) as s, cast(floor(c_custkey/200) as bigint) as d,
                  c_acctbal, c_mktsegment, n_name
           from customer join nation on c_nationkey = n_nationkey)
select k,
  concat(substr('BABNPORHSW', cast(1+2*(d%5) as int), 2), cast(cast(floor(d/5) as bigint)+1 as varchar(10)), ' ',
         cast(s%10 as varchar(10)), substr('ABDEFGHJLNPQRSTUWXYZ', cast(1+k%20 as int), 1), 'A') as postcode,
  100000 + (d%25)*20000 + (k*7919)%20000 as easting,
  50000 + cast(floor(d/25) as bigint)*20000 + (k*104729)%20000 as northing,
  case when k%11<>0 then c_mktsegment end as soilType,
  case when k%13<>0 then floor(abs(c_acctbal)/40)*1.0e0 end as elevation,
  case when k%7<>0 then concat('River ', cast(k%9 as varchar(10))) end as nearestWatercourse,
  case when k%17<>0 then ((k*37)%3000)*1.0e0 end as distanceToWatercourse,
  case when k%19<>0 then n_name end as localAuthority,
  case when k%16<9 then 1 when k%16<12 then 2 when k%16=12 then 3 when k%16=13 then 4 when k%16=14 then 5
       else 6+cast(cast(floor(k/16) as bigint)%2 as int) end as riskLabel,
  case when k%23<>0 then (100000+(k*31337)%900000)*1.0e0 end as medianPrice,
  case when k%41=0 then 1 else 0 end as historicallyFlooded
from c
""",
    ),
    "labelled": (
        ("unit",),
        """
select * from unit where k%5<>0 and cast(floor(k/20) as bigint)%13<>6 and cast(floor(k/200) as bigint)%7<>4
""",
    ),
    "unlabelled": (
        ("unit",),
        """
select k, postcode, easting, northing, soilType, elevation, nearestWatercourse, distanceToWatercourse, localAuthority
from unit where not (k%5<>0 and cast(floor(k/20) as bigint)%13<>6 and cast(floor(k/200) as bigint)%7<>4)
""",
    ),
    "sector_data": (
        ("customer",),
        """
with s as (select distinct cast(floor(c_custkey/20) as bigint) as s from customer where c_custkey % 400 < 380)
select concat(substr('BABNPORHSW', cast(1+2*(cast(floor(s/10) as bigint)%5) as int), 2),
              cast(cast(floor(s/50) as bigint)+1 as varchar(10)), ' ', cast(s%10 as varchar(10))) as postcodeSector,
  case when s%9<>4 then 20+(s*53)%400 end as households, cast(20 as int) as numberOfPostcodeUnits, 40+(s*97)%900 as headcount
from s
""",
    ),
    "district_data": (
        ("customer",),
        """
with d as (select distinct cast(floor(c_custkey/200) as bigint) as d from customer)
select concat(substr('BABNPORHSW', cast(1+2*(d%5) as int), 2), cast(cast(floor(d/5) as bigint)+1 as varchar(10))) as postcodeDistrict,
  ((d*7)%50+10)/100.0e0 as catsPerHousehold, ((d*11)%60+5)/100.0e0 as dogsPerHousehold,
  case when d%6<>5 then ((d*3)%20+5)/100.0e0 end as `pre_1900`, case when d%6<>5 then ((d*7)%20+1)/100.0e0 end as `1900_1929`,
  case when d%6<>5 then ((d*11)%20+2)/100.0e0 end as `1930_1945`, case when d%6<>5 then ((d*13)%20+3)/100.0e0 end as `1945_1964`,
  case when d%6<>5 then ((d*17)%20+4)/100.0e0 end as `1965_1982`, case when d%6<>5 then ((d*19)%20+5)/100.0e0 end as `1983_1999`,
  case when d%6<>5 then ((d*9)%20+6)/100.0e0 end as `2000_present`, case when d%6<>5 then (d%20)/100.0e0 end as `unknown`
from d
""",
    ),
    "stations": (
        ("supplier",),
        """
select concat('ST', cast(s_suppkey as varchar(10))) as stationReference,
  case when s_suppkey%2=0 then 'Rainfall station' else concat('Level ', cast(s_suppkey as varchar(10))) end as stationName,
  case when s_suppkey%31<>7 then 50.0e0 + ((s_suppkey*13)%500)/100.0e0 end as latitude,
  case when s_suppkey%31<>7 then -5.0e0 + ((s_suppkey*29)%600)/100.0e0 end as longitude,
  case when s_suppkey%2=1 and s_suppkey%10<>3 then ((s_suppkey*17)%500)/100.0e0 end as maxOnRecord,
  case when s_suppkey%2=1 then ((s_suppkey*7)%100)/100.0e0 end as minOnRecord,
  case when s_suppkey%2=1 then ((s_suppkey*23)%300)/100.0e0 end as typicalRangeHigh,
  case when s_suppkey%2=1 and s_suppkey%14<>5 then ((s_suppkey*5)%150)/100.0e0 end as typicalRangeLow
from supplier
""",
    ),
    "readings": (
        ("events",),
        """
select ts as dateTime,
  concat('ST', cast((user_id*2 + case when event_type in ('click','purchase') then 0 else 1 end)%120 as varchar(10))) as stationReference,
  case when event_type in ('click','purchase') then 'rainfall' when event_type in ('view','error') then 'level' else 'wind' end as parameter,
  case when event_type in ('click','purchase') then 'mm' else 'mASD' end as unitName,
  case when event_id%101=0 then 'bad' when event_id%89=0 then '12f'
       when event_id%97=0 then concat(cast(cast(floor(value*100+0.5) as bigint) as varchar(12)), '|7')
       else cast(cast(floor(value*100+0.5) as bigint) as varchar(12)) end as value
from events
""",
    ),
}


def oracle(body: str, *views: str) -> str:
    """SQL for DuckDB: ``body`` with the named views (and theirs) put in front."""
    wanted: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in wanted:
            for need in VIEWS[name][0]:
                visit(need)
            wanted.append(name)

    for view in views:
        visit(view)
    parts = [f"{name} as ({VIEWS[name][1].strip()})" for name in wanted]
    body = body.strip()
    if body[:5].lower() == "with ":
        parts, body = [*parts, body[5:].strip()], ""
        text = "with " + ",\n".join(parts)
    else:
        text = ("with " + ",\n".join(parts) + "\n" if parts else "") + body
    return text.replace("`", '"')


class Views:
    """The views as DataFrames over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A table of the folder; its footer is read once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def view(self, name: str) -> DataFrame:
        if name not in VIEWS:
            return self.table(name)
        needs, text = VIEWS[name]
        for need in needs:
            text = re.sub(rf"\b(from|join) {need}\b", rf"\1 {{{need}}}", text)
        return self.spark.sql(text, **{need: self.view(need) for need in needs})

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.view(name)
        raise AttributeError(name)

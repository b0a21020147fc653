"""Registered queries against their SQL twins on the smallest data folder."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tests.conftest import DATA
from tools.check import table

# One or two of every kind; tools/check.py runs them all.
SAMPLE = [
    "src4_latest_rainfall_payload",
    "src6_weather_hours",
    "snk1_write_preprocessed",
    "prj4_split_by_type",
    "flt2_requests_without_features",
    "flt9_invalid_values",
    "set4_upsert_labelled",
    "jon1_lookup_easting_northing",
    "jon3_reading_coordinates_clean",
    "jon4_unit_sector_merge",
    "jon7_fallback_chain",
    "jon9_nearest_fifteen",
    "jon10_pairs_within_radius",
    "jon11_great_circle_pairs",
    "agg1_group_replace",
    "agg3_group_modes",
    "agg6_describe",
    "agg11_density_grid",
    "agg14_correlation",
    "agg17_box_summary",
    "win1_latest_rainfall",
    "win2_first_table_wins",
    "win6_in_table_statistics",
    "str1_canonical_postcode",
    "num5_colour_position",
    "geo1_wgs84_to_osgb36",
    "geo2_osgb36_to_wgs84",
    "imp1_by_postcode",
    "imp2_by_neighbours",
    "imp5_fill_levels",
    "rsk2_human_risk",
    "rsk3_economic_risk",
    "flt8_high_risk_near_watercourses",
    "lyr5_rainfall_and_level",
    "lyr7_flood_and_weather",
    "pre7_stratified_folds",
    "evl3_classification_report",
    "evl5_class_score",
    "loc3_knn_risk",
    "stm2_latest_per_station",
    "stm4_level_alerts",
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("key", SAMPLE)
def test_query_equals_sql(spark, db, key):
    df = driver.queries()[key](spark, DATA)
    cursor = db.execute(driver.oracle_sql()[key])
    want = table([c[0] for c in cursor.description], cursor.fetchall())
    assert table(df.columns, df.collect()) == want


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["postcode", "ord", "annual_economic_flood_risk"] and df.count() > 0


def test_every_sql_twin_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert len(driver.queries()) > 130

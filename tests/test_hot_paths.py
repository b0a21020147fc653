"""Jobs built on quantiles give the same answer when every group counts as hot."""

from __future__ import annotations

import pytest

from tidemark.operators import quantiles
from tidemark.plans.catalog import QUERIES, load
from tests.conftest import DATA
from tools.check import table

load()


@pytest.mark.parametrize(
    "key", ["imp1_by_postcode", "agg6_describe", "num1_cap_outliers", "lyr5_rainfall_and_level", "win6_in_table_statistics"]
)
def test_same_answer_through_the_hot_path(spark, monkeypatch, key):
    plain = QUERIES[key](spark, DATA)
    want = table(plain.columns, plain.collect())
    monkeypatch.setattr(quantiles, "HOT_ROWS", 3)
    hot = QUERIES[key](spark, DATA)
    assert table(hot.columns, hot.collect()) == want

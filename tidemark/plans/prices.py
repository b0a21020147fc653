"""House price helpers shared by the engine and the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.constants import ENGLAND_MEDIAN_PRICE


def with_price_fallback(requests: DataFrame, predictions: DataFrame) -> DataFrame:
    """One price per request, in request order; no prediction gives the national median."""
    price = F.coalesce(F.col("medianPrice"), F.lit(ENGLAND_MEDIAN_PRICE))
    return (
        requests.join(predictions.select("postcode", "medianPrice"), "postcode", "left")
        .withColumn("medianPrice", price)
        .orderBy("ord")
    )

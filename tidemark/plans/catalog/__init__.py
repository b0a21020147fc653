"""Registered queries and the SQL they are checked against."""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.views import Views, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SECTIONS = (
    "scans",
    "projections",
    "joins",
    "aggregates",
    "windows",
    "scalars",
    "geodesy",
    "spatial",
    "imputation",
    "risk",
    "layers",
    "preparation",
    "evaluation",
    "learning",
    "streams",
)


def query(key: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn(v: Views)`` under ``key``, with its SQL twin if there is one."""

    def register(fn: Callable[[Views], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = lambda spark, folder: fn(Views(spark, folder))
        if sql is not None:
            ORACLES[key] = oracle(sql, *views)
        return fn

    return register


def load() -> None:
    for section in SECTIONS:
        if importlib.util.find_spec(f"{__name__}.{section}"):
            importlib.import_module(f"{__name__}.{section}")

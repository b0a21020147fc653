"""Pieces that the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from contextlib import suppress
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key written as text, modulo ``divisor``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % divisor


def held_out(key: str, divisor: int, rest: int) -> Column:
    """True for rows that no label may be learned from; false for a null key, which is not learned from either."""
    return F.coalesce(remainder(key, divisor) == rest, F.lit(False))


def hashed_share(rows: DataFrame, key: str, share: float) -> DataFrame:
    """About ``share`` of the rows, chosen by a hash of ``key``: the same rows in every run."""
    if share >= 1:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("share"), F.col(key)), F.lit(1 << 30)) < int(share * (1 << 30)))


#: What a Python worker keeps from task to task: one thing at a time.
_held: dict[str, Any] = {}


def held(name: str, build: Callable[[], Any]) -> Any:
    """The worker's thing of this name; anything else that it kept goes first."""
    if name not in _held:
        release()
        _held[name] = build()
    return _held[name]


def release() -> None:
    """Drop what this worker keeps, such as the words that an earlier stage has met."""
    if _held:
        _held.clear()
        gc.collect()
        trim()


def trim() -> None:
    """Give memory that is free inside this worker back to the machine: between batches, as the worker lives on through all stages."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # only the GNU library has this call
        ctypes.CDLL(None).malloc_trim(0)

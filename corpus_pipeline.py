"""The training-data pipeline: five stages over the documents, each one operator of the library.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.llm import bpe, language, mixing, near_copies, quality  # noqa: E402
from tidemark.llm.common import table  # noqa: E402
from tidemark.session import materialize  # noqa: E402


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for good. Learned from the labels of ``sf_dir``; without any, all stay."""
    return quality.accepted(docs, quality.trained(docs, table(spark, sf_dir, "labels")))


def spoken(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told. Learned from ``docs`` themselves; without any language tag, all stay but texts without letters."""
    return language.accepted(docs, language.trained(docs))


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8 or more): that with the smallest id."""
    return near_copies.deduplicated(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: none, one or two times."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row (doc_id, source, n_tokens, packed ids), with a proof that they decode to the text."""
    return bpe.checked(docs)


STAGES = [("quality", good), ("language", spoken), ("near_duplicates", single), ("mix", mixed), ("encode", encoded)]

#: Fitted models and near copies have no SQL form; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

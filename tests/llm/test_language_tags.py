"""The language stage where no document has a language tag to learn from."""

from __future__ import annotations

import corpus_pipeline
from tests.conftest import DATA
from tidemark.llm import language

DOC = "doc_id bigint, text string, lang string"


def test_no_language_known(spark):
    rows = [(1, "some plain words", None), (2, "12 34 !!", None), (3, None, None), (4, "über 漢字", None), (5, " _ ", None)]
    docs = spark.createDataFrame(rows, DOC)
    kept = corpus_pipeline.spoken(spark, docs, DATA)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4]


def test_a_known_language_still_decides(spark):
    docs = spark.createDataFrame([(i, "the river runs by the stone", "en") for i in range(20)] + [(20, "77", None)], DOC)
    assert language.trained(docs).languages == ["en"]
    assert sorted(r["doc_id"] for r in corpus_pipeline.spoken(spark, docs, DATA).collect()) == list(range(20))

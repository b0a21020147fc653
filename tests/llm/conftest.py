from __future__ import annotations

import random

import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and long texts, ties and repeated rows, under extra columns with clashing names."""
    generator = random.Random(3)
    pool = "the of river quick stone morning window letter silver garden table seven running idiot".split()
    prose = lambda n: " ".join(generator.choice(pool) for _ in range(n))
    rows = [
        (1, prose(60), "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, "b"),
        (4, " \n\t ", "en", None),
        (5, prose(40_000), "en", "b"),
        (6, "same words here again and again", "en", "b"),
        (7, "same words here again and again", "en", "c"),
        (7, "same words here again and again", "en", "c"),
        (8, "x" * 200_000, None, "c"),
        (9, " " * 100_000 + "a", "en", "c"),
        (None, prose(30), "en", "a"),
        (None, None, None, None),
        (10, "über straße 漢字 😀 İstanbul", "de", "d"),
        (11, "12 34 !! ??", "de", "d"),
        (-5, prose(25), "en", "d"),
    ]
    rows = [(*r, len(r[1]) if r[1] else None, 0.5, 1, "h", -1, "x", 9, "k", 3, 4) for r in rows]
    extra = ", score double, size int, _text string, shard int, ids string, copies int, key string, _mix_doc_id int, _mix_id int"
    return spark.createDataFrame(rows, DOC + extra)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC)

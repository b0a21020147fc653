"""Hard negatives against brute force and SQL; how much the zones spare."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from tests.conftest import DATA
from tidemark.llm import negatives
from tidemark.llm.common import table

NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, every=50, positive=5, negative=3):
    rows = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in dict.fromkeys((i, label, tuple(v)) for i, label, v in rows)]
    out = []
    for anchor, label, x in rows:
        if anchor % every:
            continue
        scored = [(-sum(a * b for a, b in zip(x, y, strict=True)), i, other) for i, other, y in rows if len(y) == len(x)]
        for score, pid in sorted((s, i) for s, i, other in scored if other == label and i != anchor)[:positive]:
            fit = sorted((s, i) for s, i, other in scored if other != label and 50 * -score <= 100 * -s <= 95 * -score)
            out += [(anchor, pid, rank + 1, i, -score, -s) for rank, (s, i) in enumerate(fit[:negative])]
    return sorted(out)


def found(frame):
    return sorted(tuple(r[c] for c in NAMES) for r in frame.collect())


def spread(count, size, clusters, seed, noise=0.2):
    """Clusters of unlike length of vector, each with several labels; whole numbers often tie."""
    generator = np.random.default_rng(seed)
    centres = generator.normal(size=(clusters, size)) * generator.uniform(0.2, 3, size=(clusters, 1))
    return [(i, int(generator.integers(0, 4)), [round(float(x), 2) for x in centres[generator.integers(clusters)] + noise * generator.normal(size=size)]) for i in range(count)]


SCHEMA = "vec_id bigint, label int, embedding array<double>"


@pytest.mark.parametrize(("block", "top"), [(2048, 1024), (64, 1024), (40, 4)])
def test_equals_brute_force(spark, block, top):
    rows = spread(900, 5, 12, 1)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(negatives.mine(frame, block=block, top=top)) == plain(rows)


def test_zones_spare_blocks(spark):
    """On clustered vectors most pairs of blocks are ruled out, and nothing is lost."""
    rows = spread(4000, 4, 40, 2, 0.03)
    usable = negatives.usable(spark.createDataFrame(rows, SCHEMA), "vec_id", "label", "embedding")
    blocks = negatives.blocks(usable, 100)
    chunks = negatives.anchors(blocks, 50, 5)
    every = blocks.count() * chunks.count()
    pairs = negatives.chosen(chunks, blocks, True, 8)
    assert every >= 1000 and pairs.count() < every / 2
    known = negatives.positives(negatives.read(pairs, chunks, blocks), 5)
    asking = negatives.windows(chunks, blocks, known, 3)
    later = negatives.chosen(asking, blocks, False, 8)
    assert later.count() < every * 2 / 3
    assert found(negatives.negatives(negatives.read(later, asking, blocks), 3)) == plain(rows)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    assert found(negatives.mined(table(spark, DATA, "embeddings"))) == sorted(con.execute(f"SELECT {', '.join(NAMES)} FROM ({negatives.ORACLE})").fetchall())


def test_bounds_hold():
    generator = np.random.default_rng(5)
    for _ in range(50):
        a, b = generator.integers(-900, 900, size=(6, 7)), generator.integers(-900, 900, size=(9, 7))
        low, high = negatives.reach(a.min(axis=0), a.max(axis=0), b.min(axis=0), b.max(axis=0))
        scores = negatives.products(a, b)
        assert low <= scores.min() and scores.max() <= high


def test_large_numbers():
    big = np.array([[1 << 40, -(1 << 40)], [3, 1 << 31]])
    assert negatives.products(big, big).tolist() == [[negatives.MOST, negatives.LEAST], [negatives.LEAST, 9 + (1 << 62)]]


def test_awkward_vectors(spark):
    good = spread(260, 3, 3, 7)
    short = [(1000 + i, i % 2, v[:2]) for i, _, v in good[:60]]
    copies = [(50 * (60 + i), 1, good[0][2]) for i in range(30)] + [(3000 + i, i % 3, good[0][2]) for i in range(60)]
    ties = [(i, label, v) for i, label, v in good[:40]]
    own = [(50, 1, good[1][2]), (50, 2, good[2][2]), (100, 3, good[3][2])]
    bad = [(None, 1, good[1][2]), (5000, None, good[1][2]), (5050, 1, None), (5100, 1, [1.0, None, 0.0]), (5150, 1, [float("nan")] * 3), (5200, 1, [float("inf"), 0.0, 0.0])]
    whole = good + short + copies + ties + own
    frame = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in whole + bad], SCHEMA + ", id int, block int, dim string, rank int")
    assert found(negatives.mine(frame, block=32)) == plain(whole)
    assert negatives.mine(frame.where("false")).count() == 0 and negatives.mine(frame.where("vec_id = 51")).count() == 0
    zeros = [(i, i % 2, [0.0, 0.0]) for i in range(0, 120)] + [(200, 0, []), (201, 0, []), (203, 1, [])]
    assert found(negatives.mine(spark.createDataFrame(zeros, SCHEMA))) == plain(zeros)
    assert negatives.mined(frame).columns == NAMES

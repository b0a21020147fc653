"""b-bit MinHash: estimate, packed bits and groups against brute force over two-word shingles."""

from __future__ import annotations

import random
import re

import numpy as np
import pandas as pd
import pytest

from tests.conftest import DATA
from tests.llm.test_near_copies import crowd
from tidemark.llm import minhash
from tidemark.llm.common import table


def plain_set(text, width=2):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def plain_rows(rows):
    """(key, n_shingles, component_id, kept) by comparing all pairs."""
    sets, least = [(key, plain_set(text)) for key, text in rows], {key: key for key, _ in rows}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                least[high] = low
    return sorted((key, len(s), find(key), find(key) == key) for key, s in sets)


def rows_of(frame):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in frame.collect())


@pytest.mark.parametrize(("short", "cell"), [(64, 1024), (2, 8)])
def test_groups_equal_brute_force(spark, monkeypatch, short, cell):
    """Originals, edits, a crowd, a shared passage; long bands too, in small cells."""
    monkeypatch.setattr(minhash, "SHORT", short)
    monkeypatch.setattr(minhash, "CELL", cell)
    rows = crowd()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert rows_of(minhash.grouped(docs)) == plain_rows(rows)


def test_documents(spark):
    docs = table(spark, DATA, "documents")
    assert rows_of(minhash.grouped(docs)) == plain_rows([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_chains_and_copies(spark):
    """Each text is near the next only; thousands of copies of one text are one entry."""
    words = [f"w{i}" for i in range(400)]
    chain = [(i, " ".join(words[4 * i : 4 * i + 60])) for i in range(40)]
    copies = [(1000 + i, "one text that is there thousands of times " * 3) for i in range(3000)]
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in minhash.grouped(spark.createDataFrame(chain + copies, "doc_id bigint, text string")).collect()}
    assert {got[i][0] for i in range(40)} == {0} and {got[i][0] for i in range(1000, 4000)} == {1000}
    assert sum(kept for _, kept in got.values()) == 2


def test_few_pairs_are_compared(spark):
    """A passage that many unlike documents share makes no pairs of all of them."""
    generator = random.Random(2)
    prose = lambda n: " ".join(f"v{generator.randrange(5000)}" for _ in range(n))
    passage = prose(25)
    docs = spark.createDataFrame([(i, f"{passage} {prose(40)}") for i in range(2000)], "doc_id bigint, text string")
    sets = minhash.marked(docs, "doc_id", "text", 2)
    links = minhash.Links(docs, sets, "doc_id", "text", 2, 80)
    links.leaders()
    links.rest()
    assert links.tested.count() < 2000 and links.found.count() == 0


def test_estimate():
    """Packed bits give the similarity back, within five deviations."""
    generator = np.random.default_rng(3)
    for share in (0.0, 0.3, 0.6, 0.8, 0.95, 1.0):
        for size in (5, 40, 3000):
            both = round(2 * size * share / (1 + share))
            pool = generator.integers(-(2**63), 2**63, 2 * size, dtype=np.int64)
            a, b = pool[:size], np.concatenate([pool[size - both : size], pool[size : 2 * size - both]])
            true = both / (2 * size - both)
            x, y = (minhash.packed(minhash.minima(np.unique(s))).view(np.uint64).reshape(minhash.KEPT, -1) for s in (a, b))
            apart = int(np.bitwise_count(np.bitwise_or.reduce(x ^ y, axis=0)).sum())
            assert abs(minhash.similarity(apart) - true) < 5 * (0.25 / minhash.MINIMA) ** 0.5 / 0.75
            if true >= 0.8:
                assert apart <= minhash.most_differing()
    assert 0.55 < minhash.similarity(minhash.most_differing()) < 0.7


def test_bands_meet():
    """Sets at the threshold share a band; their chance to miss is one in ten million."""
    assert (1 - 0.8**minhash.ROWS) ** minhash.BANDS < 2e-7
    generator = np.random.default_rng(4)
    for _ in range(200):
        pool = np.unique(generator.integers(-(2**63), 2**63, 100, dtype=np.int64))
        a, b = np.delete(pool, generator.integers(0, len(pool), 10)), np.delete(pool, generator.integers(0, len(pool), 10))
        assert (minhash.bands(minhash.minima(a)) == minhash.bands(minhash.minima(b))).any()


def test_awkward_rows(awkward, empty):
    out = minhash.grouped(awkward)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out.collect()]
    assert len(got) == awkward.count() and out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert (2, 0, 2, True) in got and (3, 0, 3, True) in got and (4, 0, 4, True) in got
    assert got.count((7, 5, 6, False)) == 2 and (6, 5, 6, True) in got
    assert (8, 1, 8, True) in got and (None, 0, None, True) in got
    assert minhash.grouped(empty).count() == 0


def test_null_and_repeated_keys(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (None, "p q r"), (None, "P Q  R"), (9, "x y z"), (9, "other words of a row with the same key")]
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.grouped(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    assert sorted(got, key=str) == sorted([(None, 5, False), (5, 5, True), (None, None, True), (None, None, True), (9, 9, True), (9, 9, True)], key=str)


def test_cells_count_all_bits():
    """Packed bits are compared as unsigned words."""
    generator = np.random.default_rng(6)
    words = generator.integers(-(2**63), 2**63, (40, len(minhash.PLANES)), dtype=np.int64)
    words[20:] = words[:20]
    words[20:, 0] ^= np.int64(-(2**63)) | np.int64(5)
    frame = pd.DataFrame(words, columns=minhash.PLANES).assign(fp=range(40), n=10, side=[0] * 20 + [1] * 20)
    found = {at: dict(zip(able.tolist(), apart.tolist(), strict=True)) for at, able, apart in minhash.Cell(frame, 80, 90).likely(np.zeros(40, np.int64), True)}
    assert all(found[at][at + 20] == 3 for at in range(20))


def test_few_queries(spark):
    """Every query leaves plans, threads and code on the driver, so steps without rows run none."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(20)]
    docs = spark.createDataFrame([*rows, (99, rows[0][1] + " end")], "doc_id bigint, text string")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    groups = {r["doc_id"]: r["component_id"] for r in minhash.near_groups(docs).collect()}
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert groups[99] == 0 and len(set(groups.values())) == 20
    assert store.executionsCount() - before < 24

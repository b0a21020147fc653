"""Near-duplicate groups and nearest neighbours against brute force; the pipeline's stages."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tests.conftest import DATA
from tidemark.llm import neighbours, simhash
from tidemark.llm.common import table
from tidemark.llm.components import roots


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(values):
    """Class of each place by union of all pairs within two bits."""
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def test_fingerprints_and_groups(spark):
    docs = table(spark, DATA, "documents")
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.grouped(docs).collect()}
    known = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    classes = plain_groups([v for _, v in known])
    least = {}
    for (key, _), c in zip(known, classes, strict=True):
        least[c] = min(key, least.get(c, key))
    assert got == {key: (f"{v:016x}", least[c]) for (key, v), c in zip(known, classes, strict=True)}


@pytest.mark.parametrize("short", [2, 128])
def test_links_lose_none(spark, monkeypatch, short):
    """A crowd of values around one centre, long lists and short ones, and chains over two bits each."""
    monkeypatch.setattr(simhash, "SHORT", short)
    generator = random.Random(short)
    values = set()
    for centre in (0, 2**63 + 12345, generator.getrandbits(64)):
        for _ in range(150):
            value = centre
            for _ in range(generator.randint(0, 4)):
                value ^= 1 << generator.randrange(64)
            values.add(value)
    values |= {generator.getrandbits(64) for _ in range(100)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    # The monkeypatched limit lives in this process, so the lists are searched here.
    frame = np.array(signed, dtype=np.int64).view(np.uint64)
    own, got = simhash.Lists(2), set()
    for which, mask in enumerate(own.masks):
        order = np.argsort(frame & mask, kind="stable")
        for a, b in own.links(np.full(len(frame), which), (frame & mask)[order], frame[order]):
            pairs = [tuple(sorted(p)) for p in zip(a.tolist(), b.tolist(), strict=True)]
            assert not got & set(pairs) and len(pairs) == len(set(pairs))
            got |= set(pairs)
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 2}
    assert got == want
    if short == 128:
        table_ = spark.createDataFrame([(v,) for v in signed], "fp bigint")
        assert {tuple(sorted((r["a"] % 2**64, r["b"] % 2**64))) for r in simhash.links(table_).collect()} == want


def test_roots(spark):
    generator = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(generator.randrange(80), generator.randrange(80)) for _ in range(50)]
    links = [p for p in links if p[0] != p[1]]
    got = {r["a"]: r["b"] for r in roots(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    reach = {n: n for p in links for n in p}
    for _ in reach:
        for a, b in links:
            reach[a] = reach[b] = min(reach[a], reach[b])
    assert got == {n: r for n, r in reach.items() if n != r}
    assert roots(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_awkward_groups(awkward, empty):
    got = [(r["doc_id"], r["component_id"]) for r in simhash.grouped(awkward).collect()]
    assert len(got) == awkward.count() and dict(got)[7] == 6 and dict(got)[3] == 2
    kept = simhash.deduplicated(awkward)
    keys = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert kept.columns == awkward.columns
    # One row of each group: 6 for 6, 7, 7; 2 for the texts without words; the null key only where it stands alone.
    assert keys.count(6) == 1 and 7 not in keys and keys.count(2) == 1 and 3 not in keys and 4 not in keys and keys.count(None) == 1
    assert simhash.grouped(empty).count() == 0 and simhash.deduplicated(empty).count() == 0


def test_equal_ids_of_different_texts(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta"), (1, "one two three four five"), (1, "one two three four five")], "doc_id bigint, text string")
    assert sorted(r["text"] for r in simhash.deduplicated(docs).collect()) == ["alpha beta gamma delta", "one two three four five"]


class TestNeighbours:
    def test_hilbert_steps(self):
        for bits, wide in ((3, 2), (2, 3)):
            grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * wide, indexing="ij"), -1).reshape(-1, wide)
            keys = neighbours.hilbert(grid, bits)
            assert sorted(keys) == list(range(len(grid)))
            path = grid[np.argsort(keys)]
            assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()

    def plain(self, vectors, every=100, nearest=10):
        out = []
        for q, x in vectors:
            if q % every == 0:
                far = sorted((float(np.sqrt(((np.array(y) - np.array(x)) ** 2).sum())), i) for i, y in vectors if i != q)
                out += [(q, at + 1, i) for at, (_, i) in enumerate(far[:nearest])]
        return out

    def test_recall(self, spark):
        table_ = table(spark, "/root/testdata/sf0.1", "embeddings")
        want = set((q, i) for q, _, i in self.plain([(r["vec_id"], r["embedding"]) for r in table_.collect()]))
        got = neighbours.found(table_).collect()
        assert len(got) == len(want) and len(want & {(r["query_id"], r["vec_id"]) for r in got}) / len(want) >= 0.9

    @pytest.mark.parametrize("few", [4096, 50])
    def test_lengths_apart(self, spark, monkeypatch, few):
        """Each length is searched by itself, with curves or without."""
        monkeypatch.setattr(neighbours, "FEW", few)
        generator = np.random.default_rng(2)
        by_length = [[(start + i, generator.normal(size=size).tolist()) for i in range(count)] for start, size, count in ((0, 5, 130), (200, 3, 110), (400, 2, 3))]
        frame = spark.createDataFrame([r for rows in by_length for r in rows], "vec_id bigint, embedding array<double>")
        got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.search(frame, recall=1.0).collect())
        assert got == sorted(r for rows in by_length for r in self.plain(rows))

    def test_awkward_vectors(self, spark):
        generator = np.random.default_rng(1)
        good = [(i, generator.normal(size=6).tolist()) for i in range(0, 120)]
        copies = [(i, good[0][1]) for i in range(200, 260)]
        bad = [(300, None), (None, good[1][1]), (400, [0.0] * 6), (500, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (600, [float("nan")] * 6), (700, [float("inf")] + [0.0] * 5), (800, [1.0, 2.0]), (900, [])]
        schema = "vec_id bigint, embedding array<double>, score int, rank string"
        frame = spark.createDataFrame([(*r, 1, "x") for r in good + copies + bad], schema)
        got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.search(frame, recall=1.0).collect())
        assert got == sorted(self.plain(good + copies))
        assert neighbours.search(frame.where("false")).count() == 0
        assert neighbours.search(frame.where("vec_id = 1")).count() == 0
        assert neighbours.search(frame.where("vec_id = 0")).count() == 0


class TestPipeline:
    def test_stages(self, spark):
        docs = table(spark, DATA, "documents")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, DATA).cache()
            assert after.columns == docs.columns
            assert 0 < after.count() and after.join(docs, "doc_id", "left_anti").count() == 0
            docs = after
        last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
        assert last.count() == docs.count() and last.where("not round_trip").count() == 0

    def test_run(self, spark):
        assert corpus_pipeline.run(spark, DATA).where("n_tokens > 0").count() > 0

    def test_awkward_rows(self, spark, awkward, empty):
        plain = awkward.select("doc_id", "text", "lang", "source", "n_chars")
        for docs in (plain, awkward, empty):
            for _, stage in corpus_pipeline.STAGES[:-1]:
                after = stage(spark, docs, DATA)
                assert after.columns == docs.columns
                after.count()

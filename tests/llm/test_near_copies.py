"""The near-duplicate stage against brute force over five-word shingles."""

from __future__ import annotations

import random
import re

import corpus_pipeline
from tests.conftest import DATA
from tidemark.llm import minhash, near_copies, simhash
from tidemark.llm.common import table


def plain_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def plain_kept(rows):
    """The smallest id of each group that pairs of Jaccard index 0.8 or more make."""
    sets, parent = [(key, plain_shingles(text)) for key, text in rows], {key: key for key, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if 5 * len(x & y) >= 4 * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return sorted({find(key) for key in parent})


def edited(generator, text, count):
    words = text.split()
    for at in generator.sample(range(len(words)), count):
        words[at] = f"new{generator.randrange(10**6)}"
    return " ".join(words)


def crowd():
    """Originals with light and heavy edits, cut ends, a crowd around one text, a shared passage, short texts."""
    generator = random.Random(8)
    pool = [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(generator.choice(pool) for _ in range(n))
    texts = [None, "", " \n", "one two", "One  two", "one two three"]
    for n in (30, 60, 120, 250):
        for _ in range(8):
            text = prose(n)
            texts += [text, text.upper(), *(edited(generator, text, c) for c in (1, 1, 2, n // 40 + 1, n // 25 + 1, n // 10))]
            texts.append(" ".join(text.split()[: int(n * generator.uniform(0.7, 0.95))]))
    passage, centre = prose(40), prose(80)
    texts += [f"{passage} {prose(generator.randint(5, 60))}" for _ in range(40)]
    texts += [edited(generator, centre, generator.randint(1, 3)) for _ in range(80)]
    generator.shuffle(texts)
    return list(enumerate(texts))


def test_stage_equals_brute_force(spark):
    rows = crowd()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(r["doc_id"] for r in corpus_pipeline.single(spark, docs, DATA).collect())
    assert got == plain_kept(rows)


def test_documents(spark):
    docs = table(spark, DATA, "documents")
    got = sorted(r["doc_id"] for r in corpus_pipeline.single(spark, docs, DATA).collect())
    assert got == plain_kept([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_awkward_rows(spark, awkward, empty):
    kept = corpus_pipeline.single(spark, awkward, DATA)
    keys = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == awkward.columns
    assert keys.count(6) == 1 and 7 not in keys and keys.count(2) == 1 and 3 not in keys and 4 not in keys and keys.count(None) == 1
    assert corpus_pipeline.single(spark, empty, DATA).count() == 0


def test_equal_ids_of_different_texts(spark):
    rows = [(1, "alpha beta gamma delta"), (1, "one two three four five"), (1, "one two three four five")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(r["text"] for r in near_copies.deduplicated(docs).collect())
    assert got == ["alpha beta gamma delta", "one two three four five"]


def test_simhash_pairs_equal_brute_force(spark):
    """The index pairs each fingerprint that has a lesser one nearby, and each set with the least of its fingerprint."""
    rows = crowd()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = minhash.marked(docs, "doc_id", "text", near_copies.WIDTH, simhash.majority)
    signs = {r["fp"]: r["sign"] for r in sets.collect() if r["n"]}
    assert signs == {minhash.fingerprint(h): simhash.majority(h) for _, t in rows if len(h := minhash.shingles(t, near_copies.WIDTH))}
    got = [(r["a"], r["b"]) for r in near_copies.simhash_pairs(sets).collect()]
    heads = {}
    for fp, sign in signs.items():
        heads[sign] = min(fp, heads.get(sign, fp))
    apart = lambda x, y: ((x ^ y) & (1 << 64) - 1).bit_count()
    want = [(fp, heads[sign]) for fp, sign in signs.items() if heads[sign] != fp]
    for sign, fp in heads.items():
        if near := [other for other in heads if other < sign and apart(sign, other) <= near_copies.BITS]:
            want.append((fp, heads[min(near)]))
    assert sorted(got) == sorted(want) and len(got) > 10


def test_stage_asks_simhash_first(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(near_copies.simhash, "links", lambda *a, own=simhash.links: asked.append(a) or own(*a))
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "A b c d e f g")], "doc_id bigint, text string")
    assert [r["doc_id"] for r in corpus_pipeline.single(spark, docs, DATA).collect()] == [1] and asked


def test_stage_runs_few_queries(spark):
    """The driver keeps the plan, the stages and the tasks of every query, so a session of many runs must not ask much of each."""
    docs = spark.createDataFrame(crowd(), "doc_id bigint, text string")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    near_copies.deduplicated(docs).collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert store.executionsCount() - before <= 50

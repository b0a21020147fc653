"""Encoding, token store, sharding, mixing and I-Match against plain versions."""

from __future__ import annotations

import gc
import hashlib
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.conftest import DATA
from tidemark.llm import bpe, imatch, mixing, sharding, token_store
from tidemark.llm.common import table
from tidemark.operators.ranking import positions


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


class TestBytePair:
    def test_stretches_change_nothing(self, monkeypatch):
        codec = bpe.codec(bpe.RANKS, public_tokenizers.PATTERN)
        pool = ["a", "B", "é", " ", "  ", "\n", "'s", "12", "!", "…", "\x1c", "\x85", " ", "漢", "\t", "́"]
        generator = random.Random(1)
        for limit in (8, 50):
            monkeypatch.setattr(bpe, "LONG", limit)
            for _ in range(400):
                text = "".join(generator.choice(pool) for _ in range(generator.randint(0, 120)))
                ids = codec.encode(text)
                assert ids.tolist() == codec.library.encode_ordinary(text)
                assert codec.decode(ids) == text.encode()

    @pytest.mark.parametrize("text", [" " * 1_200_000 + "a", "a" * 300_000, "\n \t" * 50_000])
    def test_giant_runs(self, text):
        codec = bpe.codec(bpe.RANKS, public_tokenizers.PATTERN)
        assert codec.decode(codec.encode(text)) == text.encode()

    def test_digest(self, spark, awkward, empty):
        library = bpe.codec(bpe.RANKS, public_tokenizers.PATTERN).library
        want = []
        for r in awkward.collect():
            text = r["text"] or ""
            ids = np.array(library.encode_ordinary(text), dtype="<u4")
            want.append((r["doc_id"], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        assert rows(bpe.digest(awkward)) == sorted(want, key=str)
        assert bpe.digest(empty).count() == 0

    def test_columns_stay(self, awkward):
        coded = bpe.encode(awkward, ids="packed")
        assert coded.columns == [*awkward.columns, "packed"] and coded.count() == awkward.count()
        assert bpe.checked(awkward).where("not round_trip").count() == 0

    @pytest.mark.parametrize("part", [1, 1 << 22])
    def test_parts_hold_the_same_rows(self, awkward, empty, monkeypatch, part):
        monkeypatch.setattr(bpe, "PART", part)
        names = ["doc_id", "source", "n_tokens", "ids", "round_trip"]
        got = bpe.checked(awkward)
        want = bpe.encode(awkward).selectExpr("doc_id", "source", "cast(length(ids) div 4 as bigint) n_tokens", "ids", "true round_trip")
        assert got.columns == names and rows(got) == rows(want)
        assert bpe.checked(empty).columns == names and bpe.checked(empty).count() == 0


class TestTokenStore:
    def test_pieces_change_nothing(self, monkeypatch):
        monkeypatch.setattr(token_store, "REMEMBERED", 60)
        own = token_store.Encoder(token_store.TOKENIZER)
        pool = ["a", "B", "é", " ", " ", "  ", "\n", "'s", "12", "!", "\x1c", "\x85", " ", "漢", "\t", "́", "<|endoftext|>", "\r", ".", ","]
        generator = random.Random(2)
        for _ in range(600):
            texts = ["".join(generator.choice(pool) for _ in range(generator.randint(0, 40))) for _ in range(3)]
            for text, ids in zip(texts, own.encode(texts), strict=True):
                assert np.frombuffer(ids, "<u2").tolist() == own.library.encode(text, add_special_tokens=False).ids
        untouched = Tokenizer.from_file(token_store.TOKENIZER)
        texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "a <|endoftext |> b"]
        for text, ids in zip(texts, own.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u2").tolist() == untouched.encode(text, add_special_tokens=False).ids

    @pytest.mark.parametrize("count", [0, 1, 2, 7, 3000])
    def test_perfect_hash(self, count):
        keys = np.unique(np.random.default_rng(count).integers(-(2**62), 2**62, count)).view(np.uint64)
        again = token_store.PerfectHash.unpack(token_store.PerfectHash.build(keys).pack())
        assert sorted(again.slots(keys)) == list(range(len(keys)))

    def test_store(self, spark, awkward, empty, tmp_path):
        library = Tokenizer.from_file(token_store.TOKENIZER)
        ordered = sorted(awkward.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
        want, start = [], 0
        for r in ordered:
            ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 2], dtype="<u4").tobytes()
            want.append((r["doc_id"], start, len(ids) // 4, zlib.crc32(ids)))
            start += len(ids) // 4
        assert rows(token_store.stored(awkward)) == sorted(want, key=str)
        assert token_store.stored(empty).count() == 0

    def test_lookup(self, spark, tmp_path):
        docs = spark.createDataFrame([(i * 7 - 50, f"text number {i}") for i in range(300)], "doc_id bigint, text string")
        path = str(tmp_path / "store")
        token_store.write(docs, path)
        whole = {r["doc_id"]: bytes(r["ids"]) for r in token_store.read(spark, path).collect()}
        found = {r["doc_id"]: bytes(r["ids"]) for r in token_store.lookup(spark, path, [-50, 6, 7, 13, 10**9, 2043]).collect()}
        assert found == {k: whole[k] for k in (-50, 6, 13, 2043)}


class TestSharding:
    @staticmethod
    def least(sizes, count):
        """The smallest capacity by trying greedy passes."""
        low, high = max(max(sizes), -(-sum(sizes) // count)), sum(sizes)
        while low < high:
            middle, used, room = (low + high) // 2, 1, None
            room = middle
            for s in sizes:
                if s > room:
                    used, room = used + 1, middle
                room -= s
            low, high = (low, middle) if used <= count else (middle + 1, high)
        return low

    @pytest.mark.parametrize("cells", [2, 512])
    def test_cuts(self, spark, monkeypatch, cells):
        monkeypatch.setattr(sharding, "CELLS", cells)
        generator = random.Random(cells)
        for count, n in ((16, 300), (4, 3), (3, 40)):
            sizes = [generator.choice([1, 5, 40, 900]) + generator.randint(0, 30) for _ in range(n)]
            ends = np.cumsum(sizes).tolist()
            cuts = sharding.minimax_cuts(spark.createDataFrame([(e,) for e in ends], "e bigint"), "e", count)
            assert set(cuts) <= {0, *ends} and cuts[-1] == ends[-1]
            assert max(np.diff([0, *cuts])) == self.least(sizes, count)

    def test_shards(self, awkward, empty):
        out = sharding.assignment(awkward).collect()
        assert len(out) == awkward.count()
        shard_of, slots = {}, defaultdict(list)
        texts = {}
        for r in awkward.collect():
            texts.setdefault((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())), r["text"] or "")
        for r in out:
            text = texts[r["doc_id"], r["size"], r["text_crc32"]]
            assert shard_of.setdefault(text, r["shard"]) == r["shard"]
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
        assert sharding.assignment(empty).count() == 0

    def test_positions(self, spark):
        df = spark.range(1000).selectExpr("id", "id % 7 as w").repartition(5)
        from pyspark.sql import functions as F

        got = sorted(map(tuple, positions(df, [F.col("id").desc()], "at", {"w": "sum"}).collect()))
        total = 0
        for at, i in enumerate(range(999, -1, -1)):
            total += i % 7
            assert got[i] == (i, i % 7, at, total)


class TestMixing:
    def test_plan(self, awkward, empty):
        out = mixing.taken(awkward).collect()
        assert len(out) == awkward.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in out)
        assert sorted(map(tuple, out), key=str) == sorted(map(tuple, mixing.taken(awkward).collect()), key=str)
        words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes = Counter()
        for r in awkward.collect():
            sizes[r["source"]] += words(r["text"])
        # Targets by repeated sharing of what full sources cannot take.
        names = [*sorted(s for s in sizes if s is not None), None]
        weight = dict(zip(names, (5, 2, 1) * 3, strict=False))
        target, left = {}, 1.5 * sum(sizes.values())
        while True:
            free = [s for s in names if s not in target]
            level = left / sum(weight[s] for s in free)
            full = [s for s in free if weight[s] * level >= 2 * sizes[s]]
            if not full:
                break
            for s in full:
                target[s], left = 2 * sizes[s], left - 2 * sizes[s]
        target |= {s: weight[s] * level for s in free}
        assert {round(r["target"], 6) for r in out} == {round(v, 6) for v in target.values()}
        assert mixing.taken(empty).count() == 0

    def test_near_target(self, spark):
        out = mixing.plan(table(spark, DATA.replace("0.001", "0.01"), "documents")).selectExpr("source", "target", "size * rows * copies as w")
        for r in out.groupBy("source", "target").sum("w").collect():
            assert abs(r["sum(w)"] / r["target"] - 1) < 0.02

    def test_rows(self, awkward):
        repeated = mixing.mixed(awkward)
        assert repeated.columns == awkward.columns
        want = mixing.plan(awkward).selectExpr("sum(rows * copies)").first()[0]
        assert repeated.count() == want


class TestIMatch:
    def test_awkward_rows(self, awkward, empty):
        out = imatch.compared(awkward).collect()
        ordered = sorted(((r["doc_id"], r["text"] or "") for r in awkward.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        want = []
        for i, (key, text) in enumerate(ordered):
            follower, quarter = ordered[(i + 1) % len(ordered)][1], len(text) // 4
            edited = text[: len(text) - quarter] + follower[:quarter]
            want.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest()))
        assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in out), key=str) == sorted(want, key=str)
        prints = defaultdict(set)
        for r in out:
            assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
            prints[r["doc_id"]].add(r["fingerprint"])
        assert prints[6] == prints[7]
        assert imatch.compared(empty).count() == 0

    def test_one_row(self, spark):
        (only,) = imatch.compared(spark.createDataFrame([(1, "abcd efgh")], "doc_id bigint, text string")).collect()
        assert only["edited_sha256"] == hashlib.sha256(b"abcd efab").hexdigest() and only["near_next"] == 1.0

    def test_edits_stay_nearer_than_strangers(self, spark):
        out = imatch.compared(table(spark, DATA.replace("0.001", "0.01"), "documents")).where("n_chars > 500").toPandas()
        assert (out.near_edited > out.near_next).mean() > 0.9


def test_no_search_for_cycles_inside():
    """The collector would walk over all remembered pieces again and again; it is off inside and on afterwards."""
    own, seen = token_store.Encoder(token_store.TOKENIZER), []
    asked = own.ask
    own.ask = lambda *a: seen.append(gc.isenabled()) or asked(*a)
    text = "Words, end: here.\nNext ones-too, twice, twice! (a,b) a\tb, 1,2"
    ids = Tokenizer.from_file(token_store.TOKENIZER).encode(text, add_special_tokens=False).ids
    assert own.encode([text]) == [array(own.kind, ids).tobytes()] and gc.isenabled() and set(seen) == {False}

"""Token ids in files: raw payloads with a minimal perfect hash index over the document keys.

A store is a table of segments in the order of the keys. A segment holds the raw
ids of some documents one after another (16 bits each where the vocabulary
allows, else 32), the keys in payload order, and an index from key to place:
a minimal perfect hash sends each key to a slot of its own, and the slot holds a
fingerprint of the key, where its ids begin and how many there are. A look-up
costs the same for any segment size, and the fingerprint turns strangers away.
"""

from __future__ import annotations

import functools
import gc
import os
import struct
from array import array
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from string import punctuation

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.session import fresh_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END = 2
#: A segment is closed at this many ids or documents, whichever comes first.
SEGMENT_IDS = 1 << 20
SEGMENT_DOCS = 1 << 12
#: Pieces whose ids a worker remembers; at this many the older half goes.
REMEMBERED = 1_600_000
#: Pieces that one call of the library encodes, a line each.
TOGETHER = 50


class Memory(dict):
    """Ids of pieces, each found once; pieces not asked for in a long while are forgotten."""

    def __init__(self):
        super().__init__()
        self.old: dict[str, bytes] = {}

    def recall(self, piece: str) -> bytes | None:
        found = self.get(piece)
        if found is None and (found := self.old.get(piece)) is not None:
            self[piece] = found
        return found

    def trim(self) -> None:
        if len(self) > REMEMBERED // 2:
            self.old = dict(self)
            self.clear()


@contextmanager
def uncollected() -> Iterator[None]:
    """No search for reference cycles inside: it would walk over all that is remembered, again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Encoder:
    """The tokenizers library, asked once for each distinct piece of text.

    Texts are cut where no match of the byte-level pattern can cross: before a
    blank that follows anything but white space, around a single line end between
    such characters, and after a word's last letter. Pieces are then encoded
    alike alone and in the text. A text with other white space, or with the string
    of an added token, goes to the library whole.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        # A text with the string of an added token goes to the library whole, which knows what becomes of it.
        self.added = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        (self.line_end,) = self.library.encode("\n", add_special_tokens=False).ids
        self.spaced, self.plain = Memory(), Memory()  # pieces after a blank, and others

    def ask(self, pieces: list[str], before: str, found: dict[str, bytes]) -> None:
        """Put the ids of distinct pieces, each with ``before`` in front, in ``found``.

        Words and numbers go to the library many at a time, a line each: their
        ids stand between the ids of the line ends, which nothing else in them has.
        """
        plain = [p for p in pieces if p.isalnum()]
        other = [p for p in pieces if not p.isalnum()]
        lines = ["\n".join([before + p for p in plain[i : i + TOGETHER]]) for i in range(0, len(plain), TOGETHER)]
        width, words = self.width, iter(plain)
        for encoding in self.library.encode_batch_fast(lines, add_special_tokens=False):
            ids, start = encoding.ids, 0
            raw = array(self.kind, ids).tobytes()
            for _ in range(ids.count(self.line_end)):
                end = ids.index(self.line_end, start)
                found[next(words)] = raw[start * width : end * width]
                start = end + 1
            found[next(words)] = raw[start * width :]
        for piece, encoding in zip(other, self.library.encode_batch_fast([before + p for p in other], add_special_tokens=False), strict=True):
            found[piece] = array(self.kind, encoding.ids).tobytes()

    @staticmethod
    def split(piece: str) -> list[str] | None:
        """A piece as words and what stands between, of which all but the first come without a blank before them.

        None if white space leaves no safe cut around the piece.
        """
        if not piece or piece[-1].isspace():
            return None
        lines = piece.split("\n")
        if len(lines) > 1 and any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
            return [piece]
        out: list[str] = []
        for line in lines:
            word = line.rstrip(punctuation)
            out += ["\n"] * bool(out) + ([word, line[len(word) :]] if word != line and word[-1:].isalpha() else [line])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, packed in ``width`` bytes each."""
        with uncollected():
            return self.encoded(texts)

    def encoded(self, texts: list[str]) -> list[bytes]:
        self.spaced.trim()
        self.plain.trim()
        out: list[tuple[str, list[bytes | None]]] = []  # what comes first, and the ids of the pieces after blanks
        open_places: list[tuple[list[bytes | None], int, str]] = []
        parts: dict[str, list[str]] = {}  # pieces that are not known yet, in their parts
        get, recall, older = self.spaced.get, self.spaced.recall, self.spaced.old.get
        for text in texts:
            first, *rest = text.split(" ")
            found = list(map(get, rest))
            unsafe = (first != "" and first[-1].isspace()) or any(t in text for t in self.added)
            places = []
            for at in [i for i, ids in enumerate(found) if ids is None]:
                piece = rest[at]
                if piece not in parts:
                    ids = older(piece)
                    if ids is not None:
                        found[at] = self.spaced[piece] = ids
                        continue
                    # Most pieces are a word, or a word and what ends it; those need no closer look.
                    if piece.isalnum():
                        cut = [piece]
                    elif "\n" not in piece and (word := piece.rstrip(punctuation)) != piece and word.isalpha():
                        cut = [word, piece[len(word) :]]
                    elif (cut := self.split(piece)) is None:
                        unsafe = True
                        break
                    parts[piece] = cut
                places.append((found, at, piece))
            if unsafe:
                out.append((text, []))
            else:
                out.append((first, found))
                open_places += places
        # Ask for what is new: whole pieces after a blank, and parts without one.
        new = {cut[0] for cut in parts.values()}
        new = [p for p in new if recall(p) is None]
        self.ask(new, " ", self.spaced)
        new = {p for cut in parts.values() for p in cut[1:]} | {first for first, _ in out if first}
        new = [p for p in new if self.plain.recall(p) is None]
        self.ask(new, "", self.plain)
        for piece, cut in parts.items():
            if len(cut) > 1:
                self.spaced[piece] = self.spaced[cut[0]] + b"".join(map(self.plain.__getitem__, cut[1:]))
        for found, at, piece in open_places:
            found[at] = self.spaced[piece]
        return [(self.plain[first] if first else b"") + b"".join(found) for first, found in out]


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
    return Encoder(path)


def mix(keys: np.ndarray, salt: int) -> np.ndarray:
    """A reversible scramble of 64-bit keys, another one for each salt."""
    x = keys + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Salt of the fingerprints; the levels of the hash use 0, 1, 2, ...
PRINT = 1 << 20


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bits, a key's slot is the rank of its bit.

    On each level the keys that are still without a bit are hashed to twice as
    many places; those alone in theirs get it, the others go on.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.cumsum([0, *(int(bits.sum()) for bits in levels)])
        self.ranks = [np.cumsum(bits) - bits for bits in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = 2 * len(keys) + 1
            places = (mix(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(places, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[places]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where the key is surely not in the set. Strangers may get any slot."""
        out = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            places = (mix(keys[rest], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[places]
            out[rest[hit]] = self.before[level] + self.ranks[level][places[hit]]
            rest = rest[~hit]
            if not len(rest):
                break
        return out

    def pack(self) -> bytes:
        head = struct.pack(f"<{1 + len(self.levels)}I", len(self.levels), *map(len, self.levels))
        return head + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def unpack(cls, raw: bytes) -> PerfectHash:
        (count,) = struct.unpack_from("<I", raw)
        sizes = struct.unpack_from(f"<{count}I", raw, 4)
        levels, at = [], 4 + 4 * count
        for size in sizes:
            length = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, length, at), count=size).astype(bool))
            at += length
        return cls(levels)


#: An entry of a slot: fingerprint of the key, first id in the segment, ids, document's place in the segment.
ENTRY = np.dtype([("print", "<u4"), ("first", "<u4"), ("ids", "<u4"), ("place", "<u4")])
SEGMENT = "part int, segment int, nokeys int, first_key bigint, last_key bigint, docs int, ids bigint, ids_before bigint, width int, payload binary, keys binary, lengths binary, hash binary, entries binary"


class Segment:
    """One segment being written: keys ascending, null keys (``None``) first and outside of the index."""

    def __init__(self, part: int, number: int, before: int, width: int):
        self.part, self.number, self.before, self.width = part, number, before, width
        self.keys: list[int | None] = []
        self.payloads: list[bytes] = []
        self.ids = 0

    def add(self, key: int | None, payload: bytes) -> None:
        self.keys.append(key)
        self.payloads.append(payload)
        self.ids += len(payload) // self.width

    def row(self) -> dict:
        lengths = np.array([len(p) // self.width for p in self.payloads], dtype="<u4")
        known = np.array([k for k in self.keys if k is not None], dtype="<i8")
        nokeys = len(self.keys) - len(known)
        distinct, first = np.unique(known, return_index=True)
        starts = np.cumsum(np.r_[0, lengths[:-1]])
        # A key that repeats in the segment has its rows side by side; the entry spans them all.
        spans = np.add.reduceat(lengths[nokeys:], first) if len(distinct) else np.empty(0, "<u4")
        hashed = PerfectHash.build(distinct.view(np.uint64))
        entries = np.zeros(len(distinct), ENTRY)
        slots = hashed.slots(distinct.view(np.uint64))
        entries["print"][slots] = mix(distinct.view(np.uint64), PRINT).astype("<u4")
        entries["first"][slots] = starts[nokeys + first] if len(distinct) else 0
        entries["ids"][slots] = spans
        entries["place"][slots] = nokeys + first
        return {
            "part": self.part, "segment": self.number, "nokeys": nokeys,
            "first_key": int(known[0]) if len(known) else None, "last_key": int(known[-1]) if len(known) else None,
            "docs": len(self.keys), "ids": self.ids, "ids_before": self.before, "width": self.width,
            "payload": b"".join(self.payloads), "keys": known.tobytes(), "lengths": lengths.tobytes(),
            "hash": hashed.pack(), "entries": entries.tobytes(),
        }


class Reader:
    """Keyed access to one segment."""

    def __init__(self, hashed: bytes, entries: bytes):
        self.hash, self.entries = PerfectHash.unpack(hashed), np.frombuffer(entries, ENTRY)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The entries of the keys; ``ids`` and ``first`` of a stranger are 0 and its ``print`` does not matter."""
        wanted = keys.astype("<i8").view(np.uint64)
        slots = self.hash.slots(wanted)
        out = np.zeros(len(keys), [*ENTRY.descr, ("found", "?")])
        there = np.flatnonzero(slots >= 0)
        got = self.entries[slots[there]]
        same = got["print"] == mix(wanted[there], PRINT).astype("<u4")
        for name in ENTRY.names:
            out[name][there[same]] = got[name][same]
        out["found"][there[same]] = True
        return out


def write(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, end: int = END) -> None:
    """Encode every whole text and write a store of segments at ``path``, documents by ascending key.

    Null texts count as empty; every document ends with the id ``end``. Null keys
    come first; they are in the payload and have no index entry. Rows that repeat a
    key stand side by side in the order of their texts. An empty table writes an empty store.
    Whole texts are range-partitioned and sorted by Spark; a task holds one
    segment at a time, which only a single document can make larger.
    """

    def segments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, now = encoder(tokenizer), None
        tail = int(end).to_bytes(own.width, "little")
        for frame in frames:
            nokey = frame["key"].isna().to_numpy()
            keys, texts, part = frame["key"].fillna(0).astype("int64").to_numpy(), frame["text"].to_list(), frame["part"].to_list()
            for start in range(0, len(frame), 256):
                for i, payload in enumerate(own.encode(texts[start : start + 256]), start):
                    now = now or Segment(part[i], 0, 0, own.width)
                    now.add(None if nokey[i] else int(keys[i]), payload + tail)
                    if now.ids >= SEGMENT_IDS or len(now.keys) >= SEGMENT_DOCS:
                        yield pd.DataFrame([now.row()])
                        now = Segment(now.part, now.number + 1, now.before + now.ids, own.width)
        if now is not None and now.keys:
            yield pd.DataFrame([now.row()])

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("key").asc_nulls_first(), F.col("text")]
    rows = rows.repartitionByRange(F.col("key").asc_nulls_first()).sortWithinPartitions(*order)
    rows.withColumn("part", F.spark_partition_id()).mapInPandas(segments, SEGMENT).write.parquet(path)


def offsets(store: DataFrame) -> DataFrame:
    """Ids before each part of a store: one row per writing task, so small enough to send to every task."""
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return store.groupBy("part").agg(F.sum("ids").alias("ids")).select("part", F.coalesce(F.sum("ids").over(ahead), F.lit(0)).alias("part_before"))


def wide(payload: bytes, width: int) -> np.ndarray:
    """Raw ids as unsigned 32-bit integers."""
    return np.frombuffer(payload, f"<u{width}").astype("<u4")


def _spans(row, found: np.ndarray, keys: np.ndarray) -> Iterable[tuple[int | None, int, int, bytes]]:
    """(key, start, count, ids as packed 32-bit integers) of each found key, one per document."""
    lengths = np.frombuffer(row.lengths, "<u4")
    for key, entry in zip(keys, found, strict=True):
        left, first, place = int(entry["ids"]), int(entry["first"]), int(entry["place"])
        while left > 0:  # the rows of a repeated key
            count = int(lengths[place])
            yield int(key), first, count, wide(row.payload[first * row.width : (first + count) * row.width], row.width).tobytes()
            first, left, place = first + count, left - count, place + 1


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a store through its index: (doc_id, start, n_tokens, ids).

    ``start`` counts the ids of all documents before it, ``ids`` are packed
    little-endian unsigned 32-bit integers. Keys of a segment are looked up in
    its index; documents without a key are read in payload order.
    """

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                keys = np.unique(np.frombuffer(row.keys, "<i8"))
                found = Reader(row.hash, row.entries).find(keys)
                if not found["found"].all():
                    raise ValueError(f"segment {row.part}/{row.segment} of {path} does not know its own keys")
                lengths, out, at = np.frombuffer(row.lengths, "<u4"), [], 0
                for count in lengths[: row.nokeys]:
                    out.append((None, at, int(count), wide(row.payload[at * row.width : (at + int(count)) * row.width], row.width).tobytes()))
                    at += int(count)
                out += _spans(row, found, keys)
                base = row.part_before + row.ids_before
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array([r[0] for r in out], dtype="Int64"),
                        "start": [base + r[1] for r in out],
                        "n_tokens": [r[2] for r in out],
                        "ids": [r[3] for r in out],
                    }
                )

    store = spark.read.schema(SEGMENT).parquet(path)
    placed = store.join(F.broadcast(offsets(store)), "part")
    return placed.mapInPandas(rows, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """The documents of a short list of keys: (doc_id, n_tokens, ids); unknown keys have no row.

    Only segments whose key range holds a wanted key are read, down to the files' statistics.
    """

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = np.unique(np.array(keys, dtype="<i8"))
        for frame in frames:
            for row in frame.itertuples(index=False):
                found = Reader(row.hash, row.entries).find(wanted)
                there = found["found"]
                out = list(_spans(row, found[there], wanted[there]))
                yield pd.DataFrame({"doc_id": [r[0] for r in out], "n_tokens": [r[2] for r in out], "ids": [r[3] for r in out]})

    store = spark.read.schema(SEGMENT).parquet(path)
    inside = F.lit(False)
    for key in keys:
        inside = inside | ((F.col("first_key") <= key) & (F.col("last_key") >= key))
    return store.where(inside).mapInPandas(rows, "doc_id bigint, n_tokens bigint, ids binary")


def stored(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Write a store of ``documents`` in the shared folder, read it back and digest every document's ids."""
    spark = docs.sparkSession
    path = fresh_path(spark, "token-store")
    write(docs, path, tokenizer=tokenizer)
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))




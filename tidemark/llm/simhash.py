"""Near-duplicate documents by SimHash fingerprints.

Fingerprints are compared through an inverted index over their eight byte
positions. Two fingerprints that differ in at most ``k`` bits differ in at most
``k`` bytes, so they share at least ``8 - k`` positional bytes: the count that a
pair has to reach. A list of one positional byte would hold a 256th of all
fingerprints, so the index lists hold whole sets of ``8 - k`` positional bytes.
A pair meets in a list exactly if its tally reaches the count; no list can hold
more than ``256 ** k`` fingerprints, and random pairs hardly ever meet. Each
pair's tally decides which one of its lists reports it, and it is then verified.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import fresh
from tidemark.llm.components import roots
from tidemark.session import materialize

SHINGLE = 3
BITS = 2
#: Hashes whose bits are counted at once.
BLOCK = 1 << 14
#: Lists up to this length are compared pair by pair, longer ones by flipping bits.
SHORT = 128


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text as a signed 64-bit number; 0 without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and the ASCII white space only
    if not words:
        return 0
    if len(words) < width:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(width)), strict=False))
    digest, counts, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0
    while block := [digest(s, 42) for s in islice(shingles, BLOCK)]:
        hashes = np.array(block, dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(block)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<i8")[0])


def majority(hashes: np.ndarray) -> int:
    """SimHash of 64-bit hashes as a signed number: the bits that are set in over half of them; 0 without any."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        counts += np.unpackbits(hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, width: int = SHINGLE) -> Column:
    """The fingerprints of a text column."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    return of(text)


def shared_bytes(difference: np.ndarray) -> np.ndarray:
    """How many of the eight positional bytes are equal, from the exclusive or of two fingerprints."""
    return (difference.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)


def bits_set(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values)


def byte_masks(count: int) -> list[int]:
    """Masks of every set of ``count`` byte positions, as signed numbers."""
    masks = [sum(0xFF << (8 * p) for p in kept) for kept in combinations(range(8), count)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


class Lists:
    """Links within runs of equal (list, key), for rows sorted so."""

    def __init__(self, k: int):
        self.k = k
        self.masks = np.array(byte_masks(8 - k), dtype=np.int64).view(np.uint64)

    def report(self, which: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which candidate pairs are links that this list reports.

        The tally must reach the count and the differing bits be few enough.
        A pair that shares more bytes than the count lies in several lists; the
        first of them reports it.
        """
        difference = a ^ b
        good = (shared_bytes(difference) >= 8 - self.k) & (bits_set(difference) <= self.k)
        first = np.full(len(a), -1)
        for at in range(len(self.masks) - 1, -1, -1):
            first[(difference & self.masks[at]) == 0] = at
        return good & (first == which)

    def short(self, which: np.ndarray, run: np.ndarray, values: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for step in range(1, most):
            near = np.flatnonzero(run[:-step] == run[step:])
            if not len(near):
                return
            a, b = values[near], values[near + step]
            good = self.report(which[near], a, b)
            yield a[good], b[good]

    def long(self, which: int, values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """A long list: look for every value with up to ``k`` of its free bits flipped."""
        values = np.sort(values)
        free = [bit for bit in range(64) if not int(self.masks[which]) >> bit & 1]
        for flips in range(1, self.k + 1):
            for bits in combinations(free, flips):
                other = values ^ np.uint64(sum(1 << bit for bit in bits))
                at = np.minimum(np.searchsorted(values, other), len(values) - 1)
                hit = (values[at] == other) & (values < other)
                if hit.any():
                    a, b = values[hit], other[hit]
                    good = self.report(np.full(len(a), which), a, b)
                    yield a[good], b[good]

    def links(self, which: np.ndarray, keys: np.ndarray, values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        starts = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (keys[1:] != keys[:-1])])
        lengths = np.diff(np.r_[starts, len(values)])
        run, size = np.repeat(np.arange(len(starts)), lengths), np.repeat(lengths, lengths)
        some = (size > 1) & (size <= SHORT)
        yield from self.short(which[some], run[some], values[some], SHORT)
        for at in np.flatnonzero(lengths > SHORT):
            yield from self.long(int(which[starts[at]]), values[starts[at] : starts[at] + lengths[at]])


def links(distinct: DataFrame, k: int = BITS) -> DataFrame:
    """Pairs (a, b) of different fingerprints that differ in at most ``k`` bits, each once.

    ``distinct`` has the column ``fp``, no value twice. Work grows with the number of
    fingerprints and of links: lists travel sorted, and a long list is probed
    bit by bit, not pair by pair.
    """
    masks = byte_masks(8 - k)
    listed = distinct.select("fp", F.posexplode(F.array(*(F.lit(m) for m in masks))).alias("which", "mask"))
    listed = listed.select("fp", F.col("which").cast("tinyint").alias("which"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    listed = listed.repartition("which", "key").sortWithinPartitions("which", "key")

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, rest = Lists(k), None
        for frame in frames:
            rows = (frame["which"].to_numpy(), frame["key"].to_numpy(), frame["fp"].to_numpy().view(np.uint64))
            if rest is not None:
                rows = tuple(np.concatenate(pair) for pair in zip(rest, rows, strict=True))
            if not len(rows[0]):
                continue
            # The last list may go on in the next batch.
            last = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            rest = tuple(r[cut:] for r in rows)
            for a, b in own.links(*(r[:cut] for r in rows)) if cut else ():
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})
        if rest is not None:
            for a, b in own.links(*rest):
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return listed.mapInPandas(found, "a bigint, b bigint")


def rooted(marked: DataFrame, k: int = BITS) -> DataFrame:
    """Every distinct fingerprint ``fp`` of ``marked`` with the root of its group: (fp, root)."""
    distinct = materialize(marked.select("fp").distinct(), "fingerprints")
    tree = roots(materialize(links(distinct, k), "links"))
    return distinct.join(tree.select(F.col("a").alias("fp"), "b"), "fp", "left").select("fp", F.coalesce("b", "fp").alias("root"))


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, k: int = BITS) -> DataFrame:
    """One row per row of ``docs``: (key, fp, component_id).

    ``fp`` is the fingerprint as a signed number, ``component_id`` the smallest
    key that links of at most ``k`` differing bits lead to, the row's own
    included. Null and empty texts, and texts of white space, have
    fingerprint 0 and are linked like others. Equal fingerprints are compared
    once, so thousands of copies cost one entry. Null keys never become a
    component's id unless it has no other; repeated keys are rows of their own.
    An empty table gives no rows.
    """
    marked = materialize(docs.select(F.col(key), fingerprints(F.col(text), width).alias("fp")), "simhash")
    trees = materialize(rooted(marked, k), "simhash-roots")
    least = marked.groupBy("fp").agg(F.min(key).alias("least")).join(trees, "fp")
    ids = least.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(least.select("fp", "root").join(ids, "root").select("fp", "component_id"), "fp").select(key, "fp", "component_id")


def first_of_groups(docs: DataFrame, marked: DataFrame, trees: DataFrame, of: Callable[[Column], Column], key: str, text: str) -> DataFrame:
    """The row of ``docs`` with the smallest key of each root, null keys last; one of the rows that repeat key and fingerprint.

    ``marked`` has (key, fp) of each row, ``trees`` (fp, root), and ``of`` makes the fingerprint of a text.
    """
    each = marked.groupBy("key", "fp").agg(F.count(F.lit(1)).alias("rows"))
    least = F.min(F.struct(F.col("key").isNull().alias("last"), "key", "fp")).alias("least")
    # In two steps, so that a group of very many rows meets as one row per fingerprint.
    per_print = each.groupBy("fp").agg(least)
    stay = per_print.join(trees, "fp").groupBy("root").agg(F.min("least").alias("least"))
    repeated = each.groupBy("key").agg(F.sum("rows").alias("rows")).where("rows > 1").select(F.col("key").alias("again"))
    stay = stay.select(F.col("least.key").alias("key"), F.col("least.fp").alias("fp"))
    stay = stay.join(repeated.withColumn("_twice", F.lit(True)), F.col("key").eqNullSafe(F.col("again")), "left")
    names = {n: fresh(docs, f"_{n}") for n in ("key", "fp", "twice", "own", "rank")}
    stay = stay.select(F.col("key").alias(names["key"]), F.col("fp").alias(names["fp"]), F.coalesce("_twice", F.lit(False)).alias(names["twice"]))
    kept = docs.join(stay, docs[key].eqNullSafe(F.col(names["key"])))
    # Fingerprints are needed again only where a key repeats.
    kept = kept.withColumn(names["own"], of(F.when(F.col(names["twice"]), F.col(text))))
    kept = kept.where(~F.col(names["twice"]) | (F.col(names["own"]) == F.col(names["fp"])))
    alike = Window.partitionBy(names["key"], names["fp"]).orderBy(F.col(text))
    return kept.withColumn(names["rank"], F.row_number().over(alike)).where(F.col(names["rank"]) == 1).select(*docs.columns)


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, k: int = BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest key, null keys last.

    Of rows that repeat key and fingerprint one stays. Columns stay as they are.
    """
    marked = materialize(docs.select(F.col(key).alias("key"), fingerprints(F.col(text), width).alias("fp")), "simhash")
    return first_of_groups(docs, marked, rooted(marked, k), lambda texts: fingerprints(texts, width), key, text)


def grouped(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint in 16 hexadecimal digits and the id of its group.

    The lists are those of six of the eight positional bytes: a pair meets in one exactly if its tally of shared
    positional bytes reaches six, which two bits guarantee. Rows and cases as in :func:`near_groups`.
    """
    return near_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

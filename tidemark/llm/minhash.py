"""Near-duplicate documents by b-bit MinHash over word shingles, every link confirmed on whole sets.

A document's set of shingle hashes gives ``MINIMA`` minima. Whole minima, ``ROWS``
at a time, are hashed to bands; sets that share a band are candidates. Two sets
of similarity ``s`` share none with chance ``(1 - s ** ROWS) ** BANDS``: one in
ten million at 0.8. Of each minimum only ``KEPT`` low bits stay, packed into two
bit planes. Different minima agree in them by accident with chance
``2 ** -KEPT``, so the similarity is estimated from the share of agreeing minima
less what accident adds. A candidate pair goes on if a pair at the threshold
would score so low less than once in a billion; then the whole sets are compared.

A band that many sets share is not compared pair by pair. Sets are compared with
one leader of their bands, then with the least and greatest of each, and only
then with sets that no link joins to them yet: in short bands pair by pair, in
long ones by their packed bits in cells of bounded size.

Sets are compared by 64-bit hashes of their shingles. Two different shingles of
a pair of documents are taken for one with a chance below 1e-10 for texts of
20,000 words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import pairwise
from math import exp, inf, lgamma, log

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import release, trim
from tidemark.llm.components import roots
from tidemark.session import materialize

WIDTH = 2
#: Similarity of near copies, in hundredths.
LEAST = 80
ROWS = 6
MINIMA = 320
BANDS = MINIMA // ROWS
KEPT = 2
#: Packed signature: ``KEPT`` planes of one bit for each minimum.
WORDS = MINIMA // 64
PLANES = [f"w{i}" for i in range(KEPT * WORDS)]
#: Chance that a pair at the threshold is lost by the estimate.
LOST = 1e-9
#: Up to so many sets share a short band.
SHORT = 16
#: Sets of one side of a cell, about; packed bits only, and whole sets.
CELL, WHOLE_CELL = 1024, 256
#: So many sets of another group are tried first for a set of a long band; the rest of that group is searched whole.
FIRST = 2
#: Shingles whose values are made at once.
BLOCK = 256
#: Up to so many wanted keys go to every executor, so that the texts need not travel.
SENT = 500_000

STEP = np.uint64(0x9E3779B97F4A7C15)
_draw = np.random.default_rng(2011)
MASKS = _draw.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
FACTORS = _draw.integers(0, 1 << 31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers so that every bit depends on all."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Distinct hashes of the word shingles, ascending as signed numbers; fewer words are one shingle, none give none.

    A-Z are lower-cased; words are cut at the ASCII white space.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.int64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if len(words) < width:
        width = len(words)
    count = len(words) - width + 1
    out = np.full(count, width, np.uint64)
    for i in range(width):
        out = out * STEP + each[i : i + count]
    return np.unique(mixed(out).view(np.int64))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of a set under each of the random orders, as unsigned 32-bit numbers."""
    short = (hashes.view(np.uint64) >> np.uint64(32)).astype(np.uint32)
    least = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), BLOCK):
        values = short[at : at + BLOCK, None] ^ MASKS
        values *= FACTORS
        np.minimum(least, values.min(axis=0), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One number for each band: a hash of its place and its whole minima."""
    parts = least[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        out = out * STEP + parts[:, i]
    return mixed(out).view(np.int64)


def packed(least: np.ndarray) -> np.ndarray:
    """``KEPT`` bits of each minimum, one plane after the other, as signed 64-bit numbers."""
    low = (least ^ (least >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    low ^= low >> np.uint32(13)
    planes = [np.packbits((low >> np.uint32(i)).astype(np.uint8) & 1, bitorder="little") for i in range(KEPT)]
    return np.concatenate(planes).view(np.int64)


def fingerprint(hashes: np.ndarray) -> int:
    """One signed number for a set; 0 for the empty one."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), 42)).view(np.int64)) if len(hashes) else 0


def fingerprints(width: int):
    """Column function: the set's number of each text."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(shingles(t, width)) for t in texts], dtype="int64")

    return of


def most_differing(least: int = LEAST) -> int:
    """The most minima that may differ in their kept bits: a pair at ``least`` hundredths differs in more with a chance below ``LOST``."""
    chance = (1 - least / 100) * (1 - 2.0**-KEPT)
    if chance <= 0:
        return 0
    beyond = 0.0
    for count in range(MINIMA, -1, -1):
        ways = lgamma(MINIMA + 1) - lgamma(count + 1) - lgamma(MINIMA - count + 1)
        beyond += exp(ways + count * log(chance) + (MINIMA - count) * log(1 - chance))
        if beyond >= LOST:
            return count
    return MINIMA


def similarity(differing: float) -> float:
    """Estimate of the similarity from the number of minima that differ in their kept bits, corrected for accidental agreement."""
    accident = 2.0**-KEPT
    return (1 - differing / MINIMA - accident) / (1 - accident)


def marked(docs: DataFrame, key: str, text: str, width: int, sign: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """Per row: key, the set's number ``fp``, its size ``n``, its bands and packed bits; with ``sign`` also what that makes of the set. One pass over the texts."""
    fields = ", ".join(f"{w} bigint" for w in [*PLANES, *["sign"] * (sign is not None)])

    @F.pandas_udf(f"fp bigint, n int, bands array<bigint>, {fields}")
    def of(texts: pd.Series) -> pd.DataFrame:
        release()
        trim()
        names, sizes, listed, bits, signs = [], [], [], np.zeros((len(texts), len(PLANES)), np.int64), {}
        for row, t in enumerate(texts):
            hashes = shingles(t, width)
            names.append(fingerprint(hashes))
            sizes.append(len(hashes))
            if sign is not None:
                signs.setdefault("sign", []).append(sign(hashes))
            if len(hashes):
                least = minima(hashes)
                listed.append(bands(least))
                bits[row] = packed(least)
            else:
                listed.append([])
        return pd.DataFrame({"fp": names, "n": sizes, "bands": listed} | {w: bits[:, i] for i, w in enumerate(PLANES)} | signs)

    return materialize(docs.select(F.col(key).alias("key"), of(F.col(text)).alias("of")).select("key", "of.*"), "minhash")


def shared_bands(sets: DataFrame) -> DataFrame:
    """Rows (s, fp, low, high) of the bands that different sets share, with the least and greatest set of each."""
    each = sets.where("n > 0").select("fp", F.explode("bands").alias("s"))
    heads = each.groupBy("s").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high")
    return materialize(each.join(heads, "s").select("s", "fp", "low", "high").distinct(), "bands")


def differing(a: str, b: str) -> Column:
    """How many minima of two signatures, whose columns begin with ``a`` and ``b``, differ in their kept bits."""
    either = [reduce(Column.bitwiseOR, (F.col(f"{a}{w}").bitwiseXOR(F.col(f"{b}{w}")) for w in PLANES[at::WORDS])) for at in range(WORDS)]
    return reduce(Column.__add__, map(F.bit_count, either))


class Links:
    """Confirmed links between sets, found step by step."""

    def __init__(self, docs: DataFrame, sets: DataFrame, key: str, text: str, width: int, least: int):
        self.docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        self.width, self.least, self.most = width, least, most_differing(least)
        self.bands = shared_bands(sets)
        # Sets that share any band, each once. All values of a set are equal, so the least is any.
        own = sets.join(self.bands.select("fp").distinct(), "fp", "left_semi")
        self.prints = materialize(own.groupBy("fp").agg(*(F.min(c).alias(c) for c in ("key", "n", *PLANES)), F.any_value("bands").alias("bands")), "signatures")
        self.tested = None
        # Groups so far as stars (a, b), and links that came after.
        self.stars, self.new = self.bands.where("false").select(F.col("fp").alias("a"), F.col("low").alias("b")), []

    @property
    def found(self) -> DataFrame:
        """Links that join the groups found so far."""
        return reduce(DataFrame.unionByName, [self.stars, *self.new])

    def take(self, links: DataFrame) -> None:
        links = materialize(links, "near-links")
        if links.count():
            self.new.append(links)

    def roots(self) -> DataFrame:
        if self.new:
            self.stars, self.new = roots(self.found), []
        return self.stars.select(F.col("a").alias("fp"), F.col("b").alias("root"))

    def rooted(self, rows: DataFrame, tree: DataFrame, of: str, out: str) -> DataFrame:
        names = tree.select(F.col("fp").alias(of), F.col("root").alias(out))
        return rows.join(names, of, "left").withColumn(out, F.coalesce(out, of))

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sizes and packed bits allow the threshold, with a key of each."""
        for side in ("a", "b"):
            pairs = pairs.join(self.prints.select(*(F.col(c).alias(f"{side}_{c}") for c in ("fp", "key", "n", *PLANES))), F.col(side) == F.col(f"{side}_fp"))
        able = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * self.least
        return pairs.where(able & (differing("a_", "b_") <= self.most)).select("a", "b", "a_key", "b_key")

    def whole(self, wanted: DataFrame, most: float = inf) -> DataFrame:
        """Rows of ``wanted`` (wanted_key, fp, ...) with the whole set of ``fp``, made from the text of the key. ``most``: no more rows than that, if it is known."""
        width = self.width

        @F.pandas_udf("array<bigint>")
        def of(texts: pd.Series, names: pd.Series) -> pd.Series:
            trim()
            sets = (shingles(t, width) for t in texts)
            # A key may repeat, so the set's own number decides.
            return pd.Series([s if fingerprint(s) == name else None for s, name in zip(sets, names, strict=True)], dtype=object)

        if most <= SENT or wanted.count() <= SENT:
            wanted = F.broadcast(wanted)
        rows = self.docs.join(wanted, F.col("key").eqNullSafe(F.col("wanted_key")))
        # Not deterministic only by name: so it runs once, and on the joined rows alone.
        rows = rows.withColumn("hashes", of.asNondeterministic()("text", "fp"))
        return rows.where("hashes is not null").drop("key", "text", "wanted_key")

    def add(self, pairs: DataFrame, sure: DataFrame | None = None) -> None:
        """Confirm those of the pairs (a, b) that are likely and were not tested yet, and all of ``sure`` (a, b, a_key, b_key)."""
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        likely = self.likely(pairs)
        self.confirm(likely if sure is None else sure.unionByName(likely).dropDuplicates(["a", "b"]))

    def confirm(self, pairs: DataFrame) -> None:
        """Confirm pairs (a, b, a_key, b_key) on whole sets. Sets of ``a`` travel with their pair, those of ``b`` once."""
        pairs = materialize(pairs, "likely")
        tested = pairs.select("a", "b")
        self.tested = tested if self.tested is None else self.tested.unionByName(tested)
        most = pairs.count()
        if not most:
            return
        left = self.whole(pairs.select(F.col("a_key").alias("wanted_key"), F.col("a").alias("fp"), "b"), most).withColumnsRenamed({"fp": "a", "hashes": "x"})
        right = self.whole(pairs.select(F.col("b_key").alias("wanted_key"), F.col("b").alias("fp")).distinct(), most)
        right = right.dropDuplicates(["fp"]).withColumnsRenamed({"fp": "b", "hashes": "y"})
        both = F.size(F.array_intersect("x", "y"))
        alike = both * 100 >= (F.size("x") + F.size("y") - both) * self.least
        self.take(left.join(right, "b").where(alike).select("a", "b"))

    def leaders(self, first: DataFrame | None = None) -> None:
        """Each set with the least leader of its bands, then with the others that lead to another group. Sets of one group need no more links.

        The pairs of ``first`` (a, b, a_key, b_key) are confirmed with the first of these, in one pass over the texts.
        """
        pairs = self.bands.where("fp <> low").groupBy("fp").agg(F.min("low").alias("b")).select(F.col("fp").alias("a"), "b")
        self.add(pairs, first)
        ends = self.bands.select("fp", F.explode(F.array("low", "high")).alias("b")).where("fp <> b").distinct()
        tree = self.roots()
        ends = self.rooted(self.rooted(ends, tree, "fp", "root"), tree, "b", "other")
        self.add(ends.where("root <> other").select(F.col("fp").alias("a"), "b"))

    def rest(self) -> None:
        """Sets of bands that still hold several groups. One at least of two such sets is not of the band's largest group."""
        rows_roots = self.roots()
        rows = self.rooted(self.bands.select("s", "fp"), rows_roots, "fp", "root")
        mixed_bands = rows.groupBy("s").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("all")).where("low <> high")
        rows = materialize(rows.join(mixed_bands.select("s", "all"), "s"), "mixed-bands")
        longest = rows.agg(F.max("all")).first()[0]
        if longest is None:
            return
        sizes = rows.groupBy("s", "root").agg(F.count(F.lit(1)).alias("size"))
        largest = sizes.groupBy("s").agg(F.max(F.struct("size", "root")).alias("most")).select("s", F.col("most.root").alias("largest"), F.col("most.size").alias("size"))
        rows = materialize(rows.join(largest, "s").withColumn("few", F.col("all") - F.col("size")), "sized-bands")
        few = rows.where("root <> largest")
        near = few.where(F.col("all") <= SHORT).select("s", F.col("fp").alias("b"), F.col("root").alias("other"))
        short = rows.where(F.col("all") <= SHORT).join(near, "s").where("root <> other")
        short = short.select(F.greatest("fp", "b").alias("a"), F.least("fp", "b").alias("b"))
        if longest <= SHORT:
            self.add(short.distinct())
            return
        long = materialize(self.cells(rows.where(F.col("all") > SHORT), few.where(F.col("all") > SHORT)), "cells")
        self.add(short.unionByName(long.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))).distinct())
        before = self.rooted(self.bands.select("fp").distinct(), rows_roots, "fp", "root")
        crowded = long.where("more").select(F.col("x").alias("fp"), "root").distinct()
        tree = self.roots()
        crowded = self.rooted(self.rooted(crowded, tree, "fp", "own"), tree, "root", "other").where("own <> other").select("fp", "root")
        crowded = materialize(crowded, "crowded")
        if crowded.count():
            self.take(self.searched(crowded, before))

    def searched(self, crowded: DataFrame, members: DataFrame) -> DataFrame:
        """One link (a, b) of each set ``fp`` to a member of the group ``root``, if there is any: whole sets of both in cells of bounded size."""
        sizes = crowded.groupBy("root").agg(F.count(F.lit(1)).alias("few"))
        sizes = members.join(sizes, "root").groupBy("root", "few").agg(F.count(F.lit(1)).alias("all"))
        dealt = self.dealt(crowded.join(sizes, "root"), members.join(sizes, "root"), ["root"], WHOLE_CELL)
        used = self.prints.join(dealt.select("fp").distinct(), "fp", "left_semi")
        sets = self.whole(used.select(F.col("key").alias("wanted_key"), "fp")).dropDuplicates(["fp"])
        least, most = self.least, self.most

        def confirm(frame: pd.DataFrame) -> pd.DataFrame:
            own, out = Cell(frame, least, most), []
            sets = [np.sort(h) for h in frame["hashes"]]
            for at, able, apart in own.likely(np.zeros(len(frame), np.int64), True):
                for other in able[np.argsort(apart, kind="stable")]:
                    x, y = sets[at], sets[other]
                    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                    if both * 100 >= (len(x) + len(y) - both) * least:
                        out.append((own.names[at], own.names[other]))
                        break
            return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

        return dealt.join(self.prints.select("fp", "n", *PLANES), "fp").join(sets, "fp").groupBy("root", "i", "j").applyInPandas(confirm, "a bigint, b bigint")

    def dealt(self, few: DataFrame, rows: DataFrame, keys: list[str], cell: int) -> DataFrame:
        """Both sides dealt by hash into cells (i, j): each of ``few`` (side 0) meets each of ``rows`` (side 1) in one."""
        width, height = F.ceil(F.col("all") / cell).cast("int"), F.ceil(F.col("few") / cell).cast("int")
        drawn = lambda seed, parts: F.pmod(F.xxhash64(F.lit(seed), "fp"), parts).cast("int")
        every = lambda parts: F.explode(F.sequence(F.lit(0), parts - 1))
        names = [*keys, "i", "j", "side", "fp", *(["root"] if "root" not in keys else [])]
        left = few.withColumn("i", drawn(1, height)).withColumn("j", every(width)).withColumn("side", F.lit(0))
        right = rows.withColumn("j", drawn(2, width)).withColumn("i", every(height)).withColumn("side", F.lit(1))
        return left.select(*names).unionByName(right.select(*names))

    def cells(self, rows: DataFrame, few: DataFrame) -> DataFrame:
        """Sets of long bands compared by their packed bits: (x, root, y, more) with the ``FIRST`` likeliest of another group for each set, and whether there are more.

        A band that two sets of different groups share holds several groups; if the first such band is a short one, the pair is compared there.
        """
        least, most = self.least, self.most

        def compare(frame: pd.DataFrame) -> pd.DataFrame:
            own, out = Cell(frame, least, most), []
            groups, listed = frame["root"].to_numpy(), np.stack(frame["bands"])
            place = np.argmax(listed == frame["s"].to_numpy()[:, None], axis=1)
            for at, able, apart in own.likely(groups, False):
                # A pair is told of in the first band that it shares.
                first = np.argmax(listed[able] == listed[at], axis=1) == place[at]
                able, apart = able[first], apart[first]
                able = able[np.lexsort((apart, groups[able]))]
                # Runs of one group, the likeliest first.
                edges = np.flatnonzero(np.diff(groups[able])) + 1
                for low, high in pairwise([0, *edges.tolist(), len(able)]):
                    out += [(own.names[at], groups[y], own.names[y], bool(high - low > FIRST)) for y in able[low : min(high, low + FIRST)]]
            return pd.DataFrame(out, columns=["x", "root", "y", "more"]).astype({"x": "int64", "root": "int64", "y": "int64", "more": bool})

        bits = self.prints.select("fp", "n", "bands", *PLANES)
        return self.dealt(few, rows, ["s"], CELL).join(bits, "fp").groupBy("s", "i", "j").applyInPandas(compare, "x bigint, root bigint, y bigint, more boolean")


    def trees(self, sets: DataFrame, first: DataFrame | None = None) -> DataFrame:
        """(fp, root) of every distinct set, after all links are found; ``first`` as in :meth:`leaders`."""
        self.leaders(first)
        self.rest()
        return materialize(self.rooted(sets.select("fp").distinct(), self.roots(), "fp", "root"), "near-roots")


class Cell:
    """The rows of a cell, their packed bits in one array."""

    def __init__(self, frame: pd.DataFrame, least: int, most: int):
        self.words = frame[PLANES].to_numpy(np.int64).view(np.uint64).reshape(len(frame), KEPT, WORDS)
        self.names, self.n, self.side = (frame[c].to_numpy() for c in ("fp", "n", "side"))
        self.least, self.most = least, most

    def likely(self, groups: np.ndarray, alike: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each row of side 0: the rows of side 1 of another group (``alike``: of the same) that sizes and bits let pass, and their differing minima."""
        there = np.flatnonzero(self.side == 1)
        for at in np.flatnonzero(self.side == 0):
            able = there[(groups[there] == groups[at]) == alike]
            able = able[np.minimum(self.n[able], self.n[at]) * 100 >= np.maximum(self.n[able], self.n[at]) * self.least]
            apart = np.bitwise_count(np.bitwise_or.reduce(self.words[able] ^ self.words[at], axis=1)).sum(axis=1)
            yield int(at), able[apart <= self.most], apart[apart <= self.most]


def near_sets(docs: DataFrame, key: str, text: str, width: int = WIDTH, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Rows (key, fp, n) of the documents, and (fp, root) of every distinct set: sets of one group have one root."""
    sets = marked(docs, key, text, width)
    return sets.select("key", "fp", "n"), Links(docs, sets, key, text, width, least).trees(sets)


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """One row per row of ``docs``: (key, n_shingles, component_id, kept).

    Documents are linked if the intersection of their sets of ``width``-word
    shingles has at least ``least`` hundredths of the size of the union.
    ``component_id`` is the smallest key that links lead to, the row's own
    included; ``kept`` marks the rows that have it themselves. A text of fewer
    words is one shingle; null and empty texts, and texts of white space, have
    none and are linked with nothing. Equal sets are compared once, so thousands
    of copies cost one entry. A null key becomes a component's id only where no
    row of the group has another (it is then null, and kept); repeated keys are
    rows of their own. An empty table gives no rows; other columns are not read.
    """
    rows, trees = near_sets(docs, key, text, width, least)
    least_keys = rows.where("n > 0").groupBy("fp").agg(F.min("key").alias("least")).join(trees, "fp")
    ids = least_keys.groupBy("root").agg(F.min("least").alias("id"))
    ids = least_keys.select("fp", "root").join(ids, "root").select("fp", "id")
    out = rows.join(ids, "fp", "left").withColumn("id", F.when(F.col("n") > 0, F.col("id")).otherwise(F.col("key")))
    return out.select(F.col("key").alias(key), F.col("n").cast("bigint").alias("n_shingles"), F.col("id").alias("component_id"), F.col("id").eqNullSafe(F.col("key")).alias("kept"))


def grouped(docs: DataFrame) -> DataFrame:
    """Near-duplicate groups of ``documents`` by two-word shingles; rows and cases as in :func:`near_groups`."""
    return near_groups(docs)

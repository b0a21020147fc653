"""Contiguous shards of near-equal bytes whose largest is as small as can be.

Groups of rows that must stay together stand in a fixed order. The smallest
shard capacity for which a greedy pass needs no more shards than given is found
by binary search, and the cuts are those of that pass. DataFrame functions only:
the running totals stay in Spark, and the search sees a bounded number of them,
finer and finer around the places where cuts can lie.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import positions
from tidemark.session import materialize

#: Cells into which each uncertain stretch is divided per look at the totals.
CELLS = 512


class Totals:
    """What is known of the increasing running totals: in each cell its first and last total, nothing between."""

    def __init__(self, cells: list[tuple[int, int]]):
        self.first = [a for a, _ in cells]
        self.last = [b for _, b in cells]

    def reach(self, limit: int) -> tuple[int, int]:
        """Bounds of the largest total that is at most ``limit``."""
        k = bisect_right(self.first, limit) - 1
        if k < 0:
            return 0, 0
        if self.last[k] <= limit:
            return self.last[k], self.last[k]
        return self.first[k], limit

    def cuts(self, capacity: int, shards: int, upper: bool) -> list[int]:
        """Ends of the shards of a greedy pass, with every reach taken at its lower or upper bound."""
        ends, end = [], 0
        for _ in range(shards):
            end = self.reach(end + capacity)[upper]
            ends.append(end)
        return ends

    def capacity(self, low: int, total: int, shards: int, upper: bool) -> int:
        """The smallest capacity, ``low`` or more, whose pass reaches the total."""
        high = max(low, total)
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, upper)[-1] >= total:
                high = middle
            else:
                low = middle + 1
        return low


def look(totals: DataFrame, ends: str, stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """First and last total in each of ``CELLS`` cells of every stretch (a, b]."""
    which, cell = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for i, (a, b) in enumerate(stretches):
        inside = (F.col(ends) > a) & (F.col(ends) <= b)
        width = max(1, -(-(b - a) // CELLS))
        which = F.when(inside, i).otherwise(which)
        cell = F.when(inside, F.floor((F.col(ends) - a - 1) / F.lit(width).cast("double")).cast("bigint")).otherwise(cell)
    cells = totals.select(which.alias("which"), cell.alias("cell"), F.col(ends).alias("at")).where("which is not null")
    return sorted((r[0], r[1]) for r in cells.groupBy("which", "cell").agg(F.min("at"), F.max("at")).select("min(at)", "max(at)").collect())


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def minimax_cuts(totals: DataFrame, ends: str, shards: int) -> list[int]:
    """Running totals at which the shards end; the largest shard is as small as any contiguous cut allows.

    ``totals`` has one row per group with the running total ``ends`` of positive
    sizes. No rows give no cuts. Each round reads at most ``shards * CELLS``
    pairs of numbers and narrows the uncertain stretches by about that factor,
    so a table of any size needs a handful of rounds.
    """
    total = totals.agg(F.max(ends)).first()[0]
    if total is None:
        return []
    known: dict[tuple[int, int], None] = dict.fromkeys(look(totals, ends, [(0, total)]))
    while True:
        have = Totals(sorted(known))
        low = have.capacity(-(-total // shards), total, shards, True)
        high = have.capacity(low, total, shards, False)
        early, late = have.cuts(low, shards, False), have.cuts(high, shards, True)
        if low == high and early == late:
            return early
        open_cells = [(a, b) for a, b in known if a < b]
        stretches = [(a, b) for a, b in open_cells if any(a <= hi + 1 and b >= lo for lo, hi in zip(early, late, strict=True))]
        # A cell runs from its first to its last total; both ends stay known.
        for a, b in stretches:
            del known[a, b]
            known[a, a] = None
        for wave in (merged([(a, b) for a, b in stretches])[i : i + shards] for i in range(0, len(stretches), shards)):
            if wave:
                known.update(dict.fromkeys(look(totals, ends, wave)))


def shards(docs: DataFrame, key: str = "doc_id", text: str = "text", count: int = 16) -> DataFrame:
    """Every row of ``docs`` with its shard and its slot: (key, size, text_crc32, shard, slot).

    Size is the UTF-8 bytes of the text plus 1. Rows of equal text form one group
    and share a shard; groups stand in the order of their smallest key (null
    keys first), ties by the text's hash. A null text counts as empty and stands
    with the empty texts. Repeated rows are rows of their own. Slots run from 0 in
    the order of the keys. With fewer groups than shards the last shards are
    empty; an empty table gives no rows. Only ``key`` and ``text`` are read, so
    other columns cannot clash.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key),
        (F.octet_length(whole) + 1).cast("bigint").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(whole, 256)).alias("_text"),
    )
    rows = materialize(rows, "shard-rows")
    groups = rows.groupBy("_text").agg(F.sum("size").alias("_bytes"), F.min(F.struct(F.col(key).alias("first"))).alias("_first"))
    groups = positions(groups, [F.col("_first.first").asc_nulls_first(), F.col("_text")], "_at", {"_bytes": "_end"})
    groups = materialize(groups.select("_text", "_end"), "shard-groups")
    cuts = minimax_cuts(groups, "_end", count)
    # A group lies in the shard after every cut that is at or before its start.
    shard = sum((F.when(F.col("_end") > cut, 1).otherwise(0) for cut in cuts[:-1]), F.lit(0))
    placed = rows.join(groups.select("_text", shard.cast("int").alias("shard")), "_text").drop("_text")
    placed = positions(placed, [F.col("shard"), F.col(key).asc_nulls_first(), F.col("size"), F.col("text_crc32")], "_at")
    starts = placed.groupBy("shard").agg(F.min("_at").alias("_start"))  # one row per shard
    return placed.join(F.broadcast(starts), "shard").select(key, "size", "text_crc32", "shard", (F.col("_at") - F.col("_start")).alias("slot"))


def assignment(docs: DataFrame) -> DataFrame:
    """The shards of ``documents`` under the law ``bytes``."""
    return shards(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

"""Approximate nearest neighbours along shifted space-filling curves.

Vectors are projected several times onto a few random directions, shifted, and
put on a Hilbert curve each time. Spark sorts each curve by range; the
candidates of a query are its neighbours within a window on any of the curves,
ranked by their true distance. How wide the window has to be is measured: for a
bounded sample of queries the true neighbours are found by brute force, and the
window is the one in which all but a small share of them lie on some curve.

Equal vectors are one point, which carries the smallest ids; so thousands of
copies neither crowd a window nor hide other neighbours.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hashed_share
from tidemark.operators.ranking import positions
from tidemark.session import materialize

NEAREST = 10
EVERY = 100
CURVES = 8
DIRECTIONS = 8
BITS = 7
#: Share of the sample's true neighbours that the window has to hold on some curve.
RECALL = 0.95
#: Queries of which the true neighbours are found by brute force, at most about.
SAMPLE_QUERIES = 128
#: Numbers that the directions are learned from, at most about.
SAMPLE_NUMBERS = 2_000_000
#: Lengths with up to so many distinct vectors are searched without curves, one task each.
FEW = 4096
#: Candidates that are compared in one task at a time.
BLOCK = 4096
SEED = 11


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with whole coordinates below ``1 << bits``; one row per point.

    Coordinates are turned into the curve's transposed form from the highest bit
    down (exchange or invert the lower bits of the first coordinate), Gray
    decoded, and their bits interleaved.
    """
    x = cells.T.astype(np.uint64)
    one, zero = np.uint64(1), np.uint64(0)
    for bit in range(bits - 1, 0, -1):
        low = np.uint64((1 << bit) - 1)
        for i in range(len(x)):
            high = (x[i] >> np.uint64(bit)) & one == one
            swap = np.where(high, zero, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(bit)) & one == one, np.uint64((1 << bit) - 1), zero)
    x ^= turn
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for row in x:
            out = (out << one) | ((row >> np.uint64(bit)) & one)
    return out.astype(np.int64)


def packed(vectors: DataFrame, key: str, vector: str, nearest: int, every: int) -> DataFrame:
    """Distinct vectors as points: (h, g, rep, members, asks, size, point).

    ``h`` and ``g`` are two hashes of the vector. ``members`` are the ``nearest + 1`` smallest ids of the vector, ``rep`` the
    smallest, ``asks`` whether any id is divisible by ``every``, ``point`` the packed numbers.
    """
    kind = "<f8" if "double" in dict(vectors.dtypes)[vector] else "<f4"

    @F.pandas_udf("binary")
    def pack(arrays: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(a, dtype=kind).astype("<f8").tobytes() for a in arrays], dtype=object)

    v = F.col("v")
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & v.isNotNull())
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False)))
    rows = rows.withColumns({"h": F.xxhash64(F.lit(0), "v"), "g": F.xxhash64(F.lit(1), "v")})
    asks = rows.groupBy("h", "g").agg(F.bool_or(F.col("id") % every == 0).alias("asks"))
    order = Window.partitionBy("h", "g").orderBy("id")
    least = rows.withColumn("at", F.dense_rank().over(order)).where(F.col("at") <= nearest + 1)
    least = least.groupBy("h", "g").agg(F.array_sort(F.collect_set("id")).alias("members"), F.any_value("v").alias("v"))
    points = least.join(asks, ["h", "g"]).select("h", "g", F.col("members")[0].alias("rep"), "members", "asks", F.size("v").alias("size"), pack("v").alias("point"))
    return materialize(points, "points")


def matrix(points: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(points), dtype="<f8").reshape(len(points), -1) if len(points) else np.empty((0, 0))


def directions(points: DataFrame, count: int, curves: int, wide: int) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """For each curve its directions, shifts and the width of all cells, from a bounded sample of the points."""
    numbers = len(points.select("point").first()[0]) // 8
    sample = hashed_share(points, "rep", SAMPLE_NUMBERS / numbers / max(count, 1)).select("point").collect()
    known = matrix(pd.Series([r[0] for r in sample])) if sample else np.zeros((1, numbers))
    generator, out = np.random.default_rng(SEED), []
    centred = known - known.mean(axis=0)
    # Random directions, drawn as the data spread.
    spread = np.linalg.svd(centred.T @ centred / len(known) + 1e-12 * np.eye(numbers))
    for _ in range(curves):
        drawn = (spread[0] * np.sqrt(spread[1])) @ generator.normal(size=(numbers, max(1, min(wide, numbers))))
        axes = np.linalg.qr(drawn)[0]
        seen = known @ axes
        width = max(float((seen.max(axis=0) - seen.min(axis=0)).max()), 1e-12) * 1.3
        # The shift leaves the sample inside the cells; what lies outside goes to the border cells.
        shift = seen.min(axis=0) - generator.uniform(0.02, 0.25, seen.shape[1]) * width
        out.append((axes, shift, width))
    return out


def truth(points: DataFrame, asked: list[tuple[int, bytes]], nearest: int) -> list[tuple[int, int]]:
    """(asking point, near point) for the true ``nearest`` points of a bounded list of queries; one pass over all points."""
    names, queries = [a for a, _ in asked], matrix(pd.Series([p for _, p in asked]))

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list[list[tuple[float, int]]] = [[] for _ in names]
        for frame in frames:
            reps, x = frame["rep"].to_numpy(), matrix(frame["point"])
            for i, (name, q) in enumerate(zip(names, queries, strict=True)):
                far = ((x - q) ** 2).sum(axis=1)
                far[reps == name] = np.inf
                some = np.argsort(far, kind="stable")[:nearest]
                best[i] = heapq.nsmallest(nearest, best[i] + [(float(far[k]), int(reps[k])) for k in some if far[k] < np.inf])
        out = [(name, d, rep) for name, found in zip(names, best, strict=True) for d, rep in found]
        yield pd.DataFrame(out, columns=["asker", "far", "near"])

    found = points.select("rep", "point").mapInPandas(scan, "asker bigint, far double, near bigint")
    order = Window.partitionBy("asker").orderBy("far", "near")
    ranked = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= nearest)
    return [(r[0], r[1]) for r in ranked.select("asker", "near").collect()]


def window(points: DataFrame, curve: DataFrame, asking: int, nearest: int, recall: float, curves: int) -> int:
    """The window that holds the share ``recall`` of a sample's true neighbours."""
    sample = hashed_share(points.where("asks"), "rep", SAMPLE_QUERIES / max(asking, 1)).select("rep", "point").collect()
    if not sample:
        sample = points.where("asks").orderBy("rep").limit(1).select("rep", "point").collect()
    pairs = truth(points, [(r[0], r[1]) for r in sample], nearest)
    names = sorted({n for pair in pairs for n in pair})
    if not names:
        return nearest
    listed = points.sparkSession.createDataFrame([(n,) for n in names], "rep bigint")  # a few numbers for each query of the sample
    places: dict[int, np.ndarray] = {n: np.zeros(curves, np.int64) for n in names}
    for r in curve.join(F.broadcast(listed), "rep").select("rep", "curve", "place").collect():
        places[r[0]][r[1]] = r[2]
    apart = sorted(int(np.abs(places[a] - places[b]).min()) for a, b in pairs)
    return max(nearest, apart[min(len(apart) - 1, int(np.ceil(recall * len(apart))) - 1)])


def compared_whole(points: DataFrame, nearest: int) -> DataFrame:
    """(asker, near, score) of points of lengths that few have, all against all of their length."""

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        x, reps, out = matrix(frame["point"]), frame["rep"].to_numpy(), []
        for at in np.flatnonzero(frame["asks"].to_numpy()):
            far = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
            out += [(int(reps[at]), int(reps[k]), float(far[k])) for k in np.lexsort((reps, far))[: nearest + 1]]
        return pd.DataFrame(out, columns=["asker", "near", "score"])

    return points.groupBy("size").applyInPandas(of, "asker bigint, near bigint, score double")


def search(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", nearest: int = NEAREST, every: int = EVERY, recall: float = RECALL, curves: int = CURVES) -> DataFrame:
    """The nearest other vectors of every id divisible by ``every``: (query_id, rank, vec_id, score).

    Score is the Euclidean distance in double precision; ties go to the smaller
    id. Rows with a null id, and vectors that are null, empty, all zero or hold a
    null, infinite or undefined number take no part. Vectors of different lengths
    never meet: every length is searched by itself. Rows that repeat an id are
    never neighbours of that id. No queries or no vectors give no rows. Other columns are not read.
    """
    points = packed(vectors, key, vector, nearest, every)
    lengths = points.groupBy("size").agg(F.count(F.lit(1)).alias("count"), F.count_if(F.col("asks")).alias("asking")).where("asking > 0")
    few = points.join(lengths.where(F.col("count") <= FEW).select("size"), "size", "left_semi")
    met = compared_whole(few, nearest)
    for length, count, asking in lengths.where(F.col("count") > FEW).orderBy("size").collect():  # each stands for more than FEW vectors
        met = met.unionByName(along_curves(points.where(F.col("size") == length), count, asking, nearest, recall, curves))
    order = Window.partitionBy("asker").orderBy("score", "near")
    best = met.withColumn("at", F.row_number().over(order)).where(F.col("at") <= nearest + 1).drop("at")
    # Points back to ids: the asking ones to all their queries, the near ones to their smallest members.
    best = best.join(points.select(F.col("rep").alias("near"), "members"), "near").select("asker", "score", F.explode("members").alias("vec_id"))
    asked = vectors.select(F.col(key).cast("bigint").alias("query_id"), F.col(vector).alias("v")).where(F.col("query_id") % every == 0)
    hashes = asked.select("query_id", F.xxhash64(F.lit(0), "v").alias("h"), F.xxhash64(F.lit(1), "v").alias("g")).distinct()
    asked = hashes.join(points.where("asks").select("h", "g", F.col("rep").alias("asker")), ["h", "g"]).select("query_id", "asker").distinct()
    found = asked.join(best, "asker").where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    return found.select("query_id", "rank", "vec_id", "score")


def found(vectors: DataFrame) -> DataFrame:
    """The ten nearest of every hundredth vector of ``embeddings``."""
    return search(vectors)


def along_curves(points: DataFrame, count: int, asking: int, nearest: int, recall: float, curves: int) -> DataFrame:
    """(asker, near, score) of points of one length: the nearest within the window on any of the curves."""
    turns = directions(points, count, curves, DIRECTIONS)

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = matrix(frame["point"])
            for i, (axes, shift, width) in enumerate(turns if len(x) else []):
                cells = np.clip(np.floor((x @ axes - shift) / width * (1 << BITS)), 0, (1 << BITS) - 1)
                yield pd.DataFrame({"curve": i, "key": hilbert(cells, BITS), "rep": frame["rep"]})

    keys = points.select("rep", "point").mapInPandas(placed, "curve int, key bigint, rep bigint")
    curve = positions(keys, [F.col("curve"), F.col("key"), F.col("rep")], "place").select("curve", "rep", "place")
    curve = materialize(curve, "curves")
    reach = window(points, curve, asking, nearest, recall, curves)

    # Every point stands in one block of each curve; an asking point goes to all blocks that its window touches.
    at = curve.join(points.select("rep", "asks", "point"), "rep")
    block = F.floor(F.col("place") / BLOCK).cast("bigint")
    stands = at.select(block.alias("block"), "place", "rep", F.lit(False).alias("asker"), "point")
    touched = F.sequence(F.floor(F.greatest(F.col("place") - reach, F.lit(0)) / BLOCK).cast("bigint"), F.floor((F.col("place") + reach) / BLOCK).cast("bigint"))
    asks = at.where("asks").select(F.explode(touched).alias("block"), "place", "rep", F.lit(True).alias("asker"), "point")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place", kind="stable")
        asker = frame["asker"].to_numpy()
        here, there = frame[~asker], frame[asker]
        out: list[tuple[int, int, float]] = []
        if len(here) and len(there):
            x, places, reps = matrix(here["point"]), here["place"].to_numpy(), here["rep"].to_numpy()
            for q, place, name in zip(matrix(there["point"]), there["place"], there["rep"], strict=True):
                low, high = np.searchsorted(places, place - reach), np.searchsorted(places, place + reach, "right")
                if low < high:
                    far = np.sqrt(((x[low:high] - q) ** 2).sum(axis=1))
                    limit = np.partition(far, nearest)[nearest] if len(far) > nearest else np.inf
                    some = np.flatnonzero(far <= limit)
                    some = some[np.lexsort((reps[low + some], far[some]))][: nearest + 1]
                    out += [(int(name), int(reps[low + k]), float(far[k])) for k in some]
        return pd.DataFrame(out, columns=["asker", "near", "score"])

    return stands.unionByName(asks).groupBy("block").applyInPandas(compare, "asker bigint, near bigint, score double").distinct()

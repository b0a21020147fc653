"""Hard negatives from zone-mapped blocks of vectors.

Vectors stand in the order of a Hilbert curve over their widest directions and
are cut into blocks; a block is one row of a Parquet table with the least and
greatest value of each component (its zone) beside its packed vectors. What a
block can score against the anchors of another block follows from the two zones
by interval arithmetic, so pairs are chosen from the zones alone, whose columns
are all that is read for it; only the blocks of chosen pairs are read whole.

Zones have a second level of at most ``TOP`` rows, which goes to every task. An
anchor's own block, where the curve has put its neighbours, is searched first;
what it finds is the least that another block has to be able to give.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hashed_share
from tidemark.llm.neighbours import hilbert
from tidemark.operators.ranking import positions
from tidemark.session import materialize

EVERY = 50
POSITIVES = 5
NEGATIVES = 3
#: A negative's score in hundredths of the positive's.
LOW, HIGH = 50, 95
SCALE = 256
BLOCK = 2048
TOP = 1024
#: Directions and bits of the curve; lengths of vectors that get one, and numbers it is learned from, at most about.
DIRECTIONS, BITS, LENGTHS, SAMPLE_NUMBERS = 8, 7, 16, 2_000_000
#: Scores stay within these.
LEAST, MOST = 1 - (1 << 63), (1 << 63) - 1


def ints(packed: bytes, rows: int, size: int) -> np.ndarray:
    return np.frombuffer(packed, "<i8").reshape(rows, size)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered rows: in floating point where nothing is rounded, else in long numbers, kept within 64 bits."""
    size = lambda x: max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
    if a.shape[1] * size(a) * size(b) < 1 << 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T if a.shape[1] else np.zeros((len(a), len(b)))
    return np.clip(exact, LEAST, MOST).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, some: np.ndarray, count: int) -> np.ndarray:
    """The places among ``some`` of the ``count`` highest scores, ties by smaller id."""
    if len(some) > 4 * count:
        least = np.partition(scores[some], len(some) - count)[len(some) - count]
        some = some[scores[some] >= least]
    return some[np.lexsort((ids[some], -scores[some]))][:count]


def window(score: int) -> tuple[int, int]:
    """Least and greatest score of a negative; the least is above the greatest if none can be."""
    return -(-LOW * score // 100), HIGH * score // 100


def curves(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Axes, shift and widths of the curve for each of the commonest lengths, from a bounded sample."""
    out = {}
    for length, count in rows.groupBy("dim").count().orderBy(F.col("count").desc(), "dim").limit(LENGTHS).collect():
        if not length:
            continue
        share = SAMPLE_NUMBERS / LENGTHS / length / count
        sample = hashed_share(rows.where(F.col("dim") == length), "id", share).select("point").limit(1 + SAMPLE_NUMBERS // length).collect()
        if sample:
            known = np.stack([np.frombuffer(r[0], "<i8") for r in sample]).astype(float)
            centred = known - known.mean(axis=0)
            axes = np.linalg.svd(centred.T @ centred)[0][:, :DIRECTIONS]
            seen = known @ axes
            low, high = seen.min(axis=0), seen.max(axis=0)
            out[length] = (axes, low, np.maximum(high - low, 1e-9))
    return out


def blocks(rows: DataFrame, block: int) -> DataFrame:
    """The block table of rows (id, label, dim, point)."""
    rows = materialize(rows.dropDuplicates(["id", "label", "point"]), "vectors")
    turns = curves(rows)

    @F.pandas_udf("bigint")
    def placed(lengths: pd.Series, points: pd.Series) -> pd.Series:
        out = np.zeros(len(points), np.int64)
        for length in set(lengths) & set(turns):
            axes, low, width = turns[length]
            own = np.flatnonzero(lengths == length)
            x = np.stack([np.frombuffer(points.iloc[i], "<i8") for i in own]).astype(float) @ axes
            out[own] = hilbert(np.clip(np.floor((x - low) / width * (1 << BITS)), 0, (1 << BITS) - 1), BITS)
        return pd.Series(out)

    order = [F.col("dim"), F.col("curve"), F.col("id"), F.col("label")]
    rows = positions(rows.withColumn("curve", placed("dim", "point")), order, "place").withColumn("block", F.floor(F.col("place") / block).cast("bigint"))

    def built(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        first, points = frame.iloc[0], b"".join(frame["point"])
        x, labels = ints(points, len(frame), first["dim"]), frame["label"].to_numpy(np.int64)
        zone = (x.min(axis=0).astype(float), x.max(axis=0).astype(float))
        row = (first["block"], first["dim"], len(frame), int(labels.min()), int(labels.max()), *zone, frame["id"].to_numpy("<i8").tobytes(), labels.astype("<i8").tobytes(), points)
        return pd.DataFrame([row], columns=["block", "dim", "rows", "label_low", "label_high", "low", "high", "ids", "labels", "points"])

    schema = "block bigint, dim int, rows int, label_low bigint, label_high bigint, low array<double>, high array<double>, ids binary, labels binary, points binary"
    return materialize(rows.select("block", "dim", "id", "label", "point").groupBy("block", "dim").applyInPandas(built, schema), "blocks")


class Block:
    """A row of the block table, opened."""

    def __init__(self, row: tuple, prefix: str = ""):
        get = lambda name: getattr(row, prefix + name)
        self.ids, self.labels = np.frombuffer(get("ids"), "<i8"), np.frombuffer(get("labels"), "<i8")
        self.x = ints(get("points"), len(self.ids), get("dim"))


CHUNK = "a_block bigint, a_dim int, least bigint, most bigint, a_label_low bigint, a_label_high bigint, a_low array<double>, a_high array<double>, a_ids binary, a_labels binary, a_points binary, asks binary"


def chunk(row: tuple, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, asks: np.ndarray) -> tuple:
    """The anchors of a block with what they ask for: rows of ``asks`` end with the least and the greatest score wanted."""
    zone = (x.min(axis=0).astype(float), x.max(axis=0).astype(float))
    wanted = (int(asks[:, -2].min()), int(asks[:, -1].max()))
    return (row.block, row.dim, *wanted, int(labels.min()), int(labels.max()), *zone, ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), x.astype("<i8").tobytes(), asks.astype("<i8").tobytes())


NAMES = [c.split()[0] for c in CHUNK.split(", ")]


def anchors(table: DataFrame, every: int, count: int) -> DataFrame:
    """A chunk per block with the rows whose id is divisible by ``every``: asks (least, most) for positives, the least from the own block."""

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                own = Block(row)
                at = np.flatnonzero(own.ids % every == 0)
                if not len(at):
                    continue
                asks = np.full((len(at), 2), LEAST, np.int64)
                asks[:, 1] = MOST
                for i, scores in enumerate(products(own.x[at], own.x)):
                    same = np.sort(scores[(own.labels == own.labels[at[i]]) & (own.ids != own.ids[at[i]])])
                    if len(same) >= count:
                        asks[i, 0] = same[-count]
                yield pd.DataFrame([chunk(row, own.x[at], own.ids[at], own.labels[at], asks)], columns=NAMES)

    return materialize(table.select("block", "dim", "ids", "labels", "points").mapInPandas(of, CHUNK), "anchors")


def reach(a_low: np.ndarray, a_high: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of points of two boxes, with room for rounding."""
    ends = np.stack([a_low * low, a_low * high, a_high * low, a_high * high])
    room = 1e-9 * np.abs(ends).max(axis=0).sum(axis=-1) + 1e-6
    return ends.min(axis=0).sum(axis=-1) - room, ends.max(axis=0).sum(axis=-1) + room


def chosen(chunks: DataFrame, table: DataFrame, same_label: bool, top: int) -> DataFrame:
    """Pairs (a_block, a_dim, block) that the zones cannot rule out.

    For positives (``same_label``) the labels of both must be able to meet, for
    negatives to differ.
    """
    zones = table.select("block", "dim", "label_low", "label_high", "low", "high")
    last, width = table.agg(F.max("block"), F.max("dim")).first()
    if last is None:
        return chunks.select("a_block", "a_dim", F.col("a_block").alias("block")).where("false")
    # So many blocks are one zone of the upper level, which has a bounded number of zones and of numbers.
    zones = zones.withColumn("upper", F.floor(F.col("block") / F.lit(-(-(last + 1) // max(1, min(top, (1 << 21) // max(width, 1)))))).cast("bigint"))
    parts = zones.select("upper", "dim", F.posexplode(F.arrays_zip("low", "high")).alias("at", "ends"))
    parts = parts.groupBy("upper", "dim", "at").agg(F.min("ends.low").alias("low"), F.max("ends.high").alias("high"))
    boxes = parts.groupBy("upper", "dim").agg(F.array_sort(F.collect_list(F.struct("at", "low", "high"))).alias("box"))
    lengths = zones.groupBy("upper").agg(F.min("dim").alias("dim"), F.max("dim").alias("dim_high"))
    # An upper zone of several lengths has no box and rules nothing out but other lengths.
    upper = lengths.join(boxes.select("upper", "dim", "box"), ["upper", "dim"], "left").select("upper", "dim", "dim_high", "box.low", "box.high").collect()

    def uppers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                able = [z for z in upper if z.dim <= row.a_dim <= z.dim_high]
                boxed = [z for z in able if z.dim == z.dim_high and row.a_dim]
                names = [z.upper for z in able if z.dim < z.dim_high or not row.a_dim]
                if boxed:
                    low, high = reach(row.a_low, row.a_high, np.array([z.low for z in boxed]), np.array([z.high for z in boxed]))
                    names += [z.upper for z, a, b in zip(boxed, low, high, strict=True) if b >= row.least and a <= row.most]
                yield pd.DataFrame({"a_block": row.a_block, "a_dim": row.a_dim, "upper": names})

    @F.pandas_udf("boolean")
    def able(a_low: pd.Series, a_high: pd.Series, low: pd.Series, high: pd.Series, least: pd.Series, most: pd.Series) -> pd.Series:
        out = []
        for a, b, c, d, e, f in zip(a_low, a_high, low, high, least, most, strict=True):
            x, y = reach(a, b, c, d)
            out.append(bool(y >= e and x <= f))
        return pd.Series(out, dtype=bool)

    asked = chunks.select("a_block", "a_dim", "least", "most", "a_label_low", "a_label_high", "a_low", "a_high")
    found = asked.mapInPandas(uppers, "a_block bigint, a_dim int, upper bigint")
    found = found.join(asked, ["a_block", "a_dim"]).join(zones, (found["upper"] == zones["upper"]) & (found["a_dim"] == zones["dim"]))
    one = (F.col("label_low") == F.col("label_high")) & (F.col("a_label_low") == F.col("a_label_high")) & (F.col("label_low") == F.col("a_label_low"))
    labels = (F.col("label_low") <= F.col("a_label_high")) & (F.col("a_label_low") <= F.col("label_high")) if same_label else ~one
    return materialize(found.where(labels & able("a_low", "a_high", "low", "high", "least", "most")).select("a_block", "a_dim", "block"), "block-pairs")


def read(pairs: DataFrame, chunks: DataFrame, table: DataFrame) -> DataFrame:
    """The chosen pairs with the packed anchors of one side and the packed block of the other."""
    asked = chunks.select("a_block", "a_dim", "a_ids", "a_labels", "a_points", "asks")
    whole = table.select("block", "dim", "ids", "labels", "points")
    rows = pairs.join(asked, ["a_block", "a_dim"])
    return rows.join(whole, (rows["block"] == whole["block"]) & (rows["a_dim"] == whole["dim"])).drop(whole["block"])


def positives(pairs: DataFrame, count: int) -> DataFrame:
    """The ``count`` best rows of the same label for each anchor: (a_block, a_dim, anchor, which, id, score)."""

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                own, other, out = Block(row, "a_"), Block(row), []
                asks = np.frombuffer(row.asks, "<i8").reshape(-1, 2)
                for i, scores in enumerate(products(own.x, other.x)):
                    some = np.flatnonzero((other.labels == own.labels[i]) & (other.ids != own.ids[i]) & (scores >= asks[i, 0]))
                    out += [(row.a_block, row.a_dim, i, int(other.ids[k]), int(scores[k])) for k in best(scores, other.ids, some, count)]
                yield pd.DataFrame(out, columns=["a_block", "a_dim", "anchor", "id", "score"])

    found = pairs.mapInPandas(of, "a_block bigint, a_dim int, anchor int, id bigint, score bigint")
    order = Window.partitionBy("a_block", "a_dim", "anchor").orderBy(F.col("score").desc(), "id")
    return materialize(found.withColumn("which", F.row_number().over(order)).where(F.col("which") <= count), "positives")


def windows(chunks: DataFrame, table: DataFrame, known: DataFrame, count: int) -> DataFrame:
    """Chunks that ask for negatives: rows (anchor, positive's number, id and score, least, most), the least raised to what the own block gives."""
    asked = F.array_sort(F.collect_list(F.struct("anchor", "which", "id", "score"))).alias("known")  # POSITIVES for each anchor at most
    asked = known.groupBy("a_block", "a_dim").agg(asked).select("a_block", "a_dim", *(F.col(f"known.{c}").alias(f"k_{c}") for c in ("anchor", "which", "id", "score")))
    own = read(chunks.select("a_block", "a_dim", F.col("a_block").alias("block")), chunks, table)

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                mine, other, asks = Block(row, "a_"), Block(row), []
                scores = products(mine.x, other.x)
                for anchor, which, name, score in zip(row.k_anchor, row.k_which, row.k_id, row.k_score, strict=True):
                    low, high = window(int(score))
                    if low > high:
                        continue
                    near = scores[anchor][(other.labels != mine.labels[anchor]) & (scores[anchor] >= low) & (scores[anchor] <= high)]
                    if len(near) >= count:
                        low = int(np.partition(near, len(near) - count)[len(near) - count])
                    asks.append((anchor, which, name, score, low, high))
                if asks:
                    whole = np.array(asks, np.int64)
                    used, whole[:, 0] = np.unique(whole[:, 0], return_inverse=True)
                    yield pd.DataFrame([chunk(row, mine.x[used], mine.ids[used], mine.labels[used], whole)], columns=NAMES)

    return materialize(own.join(asked, ["a_block", "a_dim"]).mapInPandas(of, CHUNK), "windows")


def negatives(pairs: DataFrame, count: int) -> DataFrame:
    """The ``count`` best rows of another label inside each window."""

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                own, other, out = Block(row, "a_"), Block(row), []
                scores = products(own.x, other.x)
                for anchor, which, name, score, low, high in np.frombuffer(row.asks, "<i8").reshape(-1, 6).tolist():
                    some = np.flatnonzero((scores[anchor] >= low) & (scores[anchor] <= high) & (other.labels != own.labels[anchor]))
                    near = best(scores[anchor], other.ids, some, count)
                    out += [(row.a_block, row.a_dim, anchor, which, int(own.ids[anchor]), name, score, int(other.ids[k]), int(scores[anchor][k])) for k in near]
                yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    schema = "a_block bigint, a_dim int, anchor int, which int, anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    order = Window.partitionBy("a_block", "a_dim", "anchor", "which").orderBy(F.col("negative_score").desc(), "negative_id")
    found = pairs.mapInPandas(of, schema).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def usable(rows: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """Rows (id, label, dim, point) with whole-numbered components; those that take no part are gone."""

    @F.pandas_udf("binary")
    def pack(arrays: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(a, dtype="<i8").tobytes() for a in arrays], dtype=object)

    v = F.col("v")
    own = rows.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).alias("v")).where("id is not null and label is not null and v is not null")
    own = own.where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * SCALE))
    return own.select("id", "label", F.size("v").alias("dim"), pack(whole).alias("point"))


def mine(rows: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding", every: int = EVERY, positive: int = POSITIVES, negative: int = NEGATIVES, block: int = BLOCK, top: int = TOP) -> DataFrame:
    """Hard negatives of every id divisible by ``every``: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components count as ``floor(256 * x)``; a score is the whole-numbered inner
    product, ties go to the smaller id. Positives are the ``positive`` best other
    rows of the anchor's label, negatives the ``negative`` best rows of another
    label with 50 to 95 hundredths of the positive's score (none for a negative
    score). Rows with a null id, label, vector or component, or one that is not
    finite, take no part. Vectors of different lengths never meet. Rows that
    repeat id, label and vector count once; rows of the anchor's own id are never
    its positives. Components and scores beyond 64 bits stay at the bound. No
    anchors give no rows; other columns are not read.
    """
    table = blocks(usable(rows, key, label, vector), block)
    chunks = anchors(table, every, positive)
    known = positives(read(chosen(chunks, table, True, top), chunks, table), positive)
    asking = windows(chunks, table, known, negative)
    return negatives(read(chosen(asking, table, False, top), asking, table), negative)


def mined(vectors: DataFrame) -> DataFrame:
    """Hard negatives in ``embeddings``, where every seventh id carries a wrong label. Cases as in :func:`mine`."""
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.select("vec_id", wrong.alias("label"), "embedding"))


ORACLE = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {SCALE})) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), positives AS (
  SELECT anchor_id, vec_id, score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND {LOW} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""

"""Exact k-nearest join on plane coordinates.

The reference points get one Morton code each, the interleaved bits of their two
cell numbers, and are sorted by it once. A cell of any size is then a prefix of
the code and a run of the sorted points; it holds more than ``LEAF_ROWS`` points
exactly if two points that many places apart share its prefix. So the leaf of a
point (the largest cell around it that is not crowded) follows from the codes a
few places away, and every point has one leaf. The leaves and the cells above
them, with their counts and bounding boxes, are a written table.

Every query walks down from the top cell. At each level it keeps the cells that
can still hold one of its ``k`` nearest points: the counts and bounding boxes of
the kept cells give a radius that surely holds ``k`` points, and a cell farther
away than that is dropped. What is left are a few leaf cells per query, whose
points are compared.

Work per query grows with the depth of the cells (logarithm of the table), not
with the size of a dense neighbourhood. Copies of one coordinate beyond the
first ``k`` by tie order can never be an answer and are dropped beforehand.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import keep_priority, positions
from tidemark.session import materialize

LEAF_ROWS = 32
#: Levels of cells; each has sixteen children on the level below, so a level is four bits of the code.
LEVELS = 12
#: Sorted points that one task looks over at a time.
STRETCH = 8192
# The masks that spread 24 bits over the even bits of 48.
SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def _morton(x: Column, y: Column) -> Column:
    """Interleaved bits of two cell numbers below ``4 ** LEVELS``."""
    spread = lambda v: reduce(lambda n, step: F.shiftleft(n, step[0]).bitwiseOR(n).bitwiseAND(F.lit(step[1])), SPREAD, v)
    return F.shiftleft(spread(y), 1).bitwiseOR(spread(x))


def _node(level: Column, prefix: Column) -> Column:
    """Cell id: level and code prefix in one integer."""
    return F.shiftleft(level.cast("bigint"), 56).bitwiseOR(prefix)


def _coded(points: DataFrame, box) -> DataFrame:
    """Points with their code, and their place in the order of the codes."""
    side = max(box["high_x"] - box["low_x"], box["high_y"] - box["low_y"]) or 1.0
    top = 4**LEVELS - 1

    def index(name: str, origin: float) -> Column:
        return F.least(F.floor((F.col(name) - F.lit(origin)) / F.lit(side / 4**LEVELS)), F.lit(top).cast("bigint"))

    return positions(points.withColumn("_code", _morton(index("_x", box["low_x"]), index("_y", box["low_y"]))), [F.col("_code")], "_place")


def _with_leaves(coded: DataFrame, leaf_rows: int) -> DataFrame:
    """Points with the id of their leaf (``_node``) and its level.

    Each stretch of the sorted points also gets the ``leaf_rows`` points before
    and after it, so the windows are bounded and see all they need.
    """
    stretch = max(STRETCH, leaf_rows)
    block, inside = F.floor(F.col("_place") / stretch).cast("bigint"), F.col("_place") % stretch
    own = coded.withColumns({"_block": block, "_own": F.lit(True)})
    # Neighbours only lend their codes.
    lent = [c if c in ("_code", "_place") else F.lit(None).cast(dict(coded.dtypes)[c]).alias(c) for c in coded.columns]
    after = coded.where((block > 0) & (inside < leaf_rows)).select(*lent, (block - 1).alias("_block"), F.lit(False).alias("_own"))
    before = coded.where(inside >= stretch - leaf_rows).select(*lent, (block + 1).alias("_block"), F.lit(False).alias("_own"))
    near = Window.partitionBy("_block").orderBy("_place")
    apart = F.col("_code").bitwiseXOR(F.lead("_code", leaf_rows).over(near))
    # The lowest level on which the point and the one ``leaf_rows`` places on are in one cell, which is crowded.
    crowded = reduce(Column.__add__, (F.when(F.shiftright(apart, 4 * i) > 0, 1).otherwise(0) for i in range(LEVELS)))
    rows = own.unionByName(after).unionByName(before).withColumn("_crowded", F.when(apart.isNotNull(), crowded))
    lowest = F.min("_crowded").over(near.rowsBetween(-leaf_rows, 0))
    level = F.greatest(F.coalesce(lowest - 1, F.lit(LEVELS)), F.lit(0))
    rows = rows.withColumn("_level", level).where("_own")
    prefix = F.expr("shiftright(_code, cast(4 * _level as int))")
    return rows.withColumn("_node", _node(F.col("_level"), prefix)).drop("_block", "_own", "_crowded", "_place")


CELL = ("_node", "_n", "_x0", "_x1", "_y0", "_y1")


def _index(points: DataFrame, box, leaf_rows: int):
    """Points with their leaves, the cell table, and facts: lowest leaf level and the cells below the top.

    Only leaves are copied to the levels above them. The top cell has at most
    16 children, which come back with the facts.
    """
    placed = materialize(_with_leaves(_coded(points, box), leaf_rows), "leaves")
    ends = [fn(axis).alias(out) for axis, low, high in (("_x", "_x0", "_x1"), ("_y", "_y0", "_y1")) for fn, out in ((F.min, low), (F.max, high))]
    leaves = placed.groupBy("_level", "_node").agg(F.count("*").alias("_n"), F.any_value("_code").alias("_code"), *ends)
    spans = leaves.withColumn("_leaf_level", F.col("_level")).withColumn("_level", F.explode(F.sequence(F.col("_level"), F.lit(LEVELS))))
    cell, above = (F.expr(f"shiftright(_code, cast(4 * (_level + {i}) as int))") for i in (0, 1))
    spans = spans.withColumns({"_node": _node(F.col("_level"), cell), "_parent": _node(F.col("_level") + 1, above)})
    ends = [fn(c).alias(c) for c, fn in (("_x0", F.min), ("_x1", F.max), ("_y0", F.min), ("_y1", F.max))]
    cells = spans.groupBy("_level", "_node", "_parent").agg(F.sum("_n").alias("_n"), *ends, F.bool_or(F.col("_level") == F.col("_leaf_level")).alias("_leaf"))
    tree = materialize(cells, "tree", "_level")
    facts = tree.agg(
        F.min(F.when(F.col("_leaf"), F.col("_level"))).alias("low"),
        F.collect_list(F.when(F.col("_level") == LEVELS - 1, F.struct(*CELL))).alias("top"),
    ).first()
    return placed, tree, facts


def _gap(q: Column, low: Column, high: Column) -> Column:
    return F.greatest(low - q, q - high, F.lit(0.0))


def _reach(q: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.abs(q - low), F.abs(q - high))


def nearest(
    queries: DataFrame,
    reference: DataFrame,
    k: int,
    query_id: str,
    tie: str,
    x: str = "easting",
    y: str = "northing",
    leaf_rows: int | None = None,
) -> DataFrame:
    """The ``k`` nearest reference rows of every query.

    Gives ``query_id``, ``rank`` (1..k), ``d2`` (squared distance) and all
    reference columns. Ties go to the smaller ``tie`` value. Queries without
    coordinates give no rows; with fewer than ``k`` reference rows all come
    back. ``query_id`` must be unique and must not be a reference column.
    """
    leaf_rows = leaf_rows or max(LEAF_ROWS, 2 * k)
    points = (
        reference.withColumns({"_x": F.col(x).cast("double"), "_y": F.col(y).cast("double")})
        .where(F.col("_x").isNotNull() & F.col("_y").isNotNull() & ~F.isnan("_x") & ~F.isnan("_y"))
    )
    copies = Window.partitionBy("_x", "_y").orderBy(tie)
    points = points.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k).drop("_copy")
    ends = [fn(axis).alias(f"{name}{axis}") for axis in ("_x", "_y") for name, fn in (("low", F.min), ("high", F.max))]
    points = materialize(points, "reference")
    box = points.agg(F.count("*").alias("n"), *ends).first()

    asked = queries.select(
        F.col(query_id), F.col(x).cast("double").alias("_qx"), F.col(y).cast("double").alias("_qy")
    ).where(F.col("_qx").isNotNull() & F.col("_qy").isNotNull() & ~F.isnan("_qx") & ~F.isnan("_qy"))
    d2 = (F.col("_x") - F.col("_qx")) * (F.col("_x") - F.col("_qx")) + (F.col("_y") - F.col("_qy")) * (
        F.col("_y") - F.col("_qy")
    )
    ranked = Window.partitionBy(query_id).orderBy("d2", tie)
    if box["n"] <= leaf_rows:
        # At most ``leaf_rows`` reference rows in all: one leaf.
        pairs = asked.join(F.broadcast(points))
    else:
        placed, tree, facts = _index(points, box, leaf_rows)
        # Few input bytes become many pairs: fix the number of tasks, or the
        # planner would merge them by input size.
        spark = queries.sparkSession
        tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        leaves = _walk(asked.repartition(tasks, query_id), tree, facts, k, query_id)
        pairs = leaves.join(placed.drop("_code", "_level"), "_node").where(d2 <= F.col("_radius")).drop("_node", "_radius")
    return (
        pairs.withColumn("d2", d2)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .drop("_qx", "_qy", "_x", "_y")
    )


def _walk(asked: DataFrame, tree: DataFrame, facts, k: int, query_id: str) -> DataFrame:
    """Leaf cells that can hold one of the k nearest points, per query."""
    cell = [F.col(name) for name in CELL[1:]]

    def steps(level: int) -> DataFrame:
        """From the cells of a level down to their children; leaves of that level and above stay."""
        below = tree.where(F.col("_level") == level - 1).select(F.col("_parent").alias("_at"), F.col("_node").alias("_next"), *cell)
        stay = tree.where(F.col("_leaf") & (F.col("_level") >= level)).select(F.col("_node").alias("_at"), F.col("_node").alias("_next"), *cell)
        return below.unionByName(stay)

    top = F.array(*[F.struct(*[F.lit(row[name]).alias(name) for name in CELL]) for row in facts["top"]])
    front = asked.select(query_id, "_qx", "_qy", F.lit(float("inf")).alias("_radius"), F.inline(top))
    front = front.withColumnRenamed("_node", "_next")
    qx, qy = F.col("_qx"), F.col("_qy")
    gx, gy = _gap(qx, F.col("_x0"), F.col("_x1")), _gap(qy, F.col("_y0"), F.col("_y1"))
    rx, ry = _reach(qx, F.col("_x0"), F.col("_x1")), _reach(qy, F.col("_y0"), F.col("_y1"))
    near, far = gx * gx + gy * gy, rx * rx + ry * ry
    mine = Window.partitionBy(query_id)
    growing = mine.orderBy("_far").rowsBetween(Window.unboundedPreceding, 0)
    enough = F.min(F.when(F.col("_held") >= k, F.col("_far"))).over(mine)
    for step in range(LEVELS - facts["low"]):
        if step:
            # The upper levels are a few rows each, which the planner sees and sends to every task.
            front = front.join(steps(LEVELS - step), F.col("_node") == F.col("_at"))
        front = (
            front.select(
                query_id, "_qx", "_qy", "_radius", "_n", F.col("_next").alias("_node"), near.alias("_near"), far.alias("_far")
            )
            # The radius of the level above still holds: drop most cells before sorting.
            .where("_near <= _radius")
            .withColumn("_held", F.sum("_n").over(growing))
            .select(query_id, "_qx", "_qy", F.least("_radius", enough).alias("_radius"), "_near", "_node")
            .where("_near <= _radius")
            .drop("_near")
        )
    return front


def nearest_one(queries: DataFrame, reference: DataFrame, query_id: str, tie: str = "postcode") -> DataFrame:
    """Nearest reference row of every query location."""
    return nearest(queries, reference, 1, query_id, tie).drop("rank")


def vote(neighbours: DataFrame, query_id: str, label: str, out: str) -> DataFrame:
    """Most frequent label among the neighbours; ties go to the smallest label."""
    counts = neighbours.groupBy(query_id, label).count()
    return keep_priority(counts, [query_id], [F.col("count").desc(), F.col(label)]).select(
        query_id, F.col(label).alias(out)
    )


def distance_weighted(neighbours: DataFrame, query_id: str, value: str, out: str) -> DataFrame:
    """Inverse-distance mean; an exact hit uses only the neighbours at distance 0."""
    hit = F.col("d2") == 0
    weight = F.when(hit, 1.0).otherwise(1.0 / F.sqrt("d2"))
    return (
        neighbours.groupBy(query_id)
        .agg(
            F.avg(F.when(hit, F.col(value))).alias("_hit"),
            (F.sum(weight * F.col(value)) / F.sum(weight)).alias("_mean"),
        )
        .select(query_id, F.coalesce("_hit", "_mean").alias(out))
    )

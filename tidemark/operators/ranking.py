"""Orderings and rankings that do not gather a large group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

RANK_BUCKETS = 4096


def keyed_hash(key: Column, seed: int = 42) -> Column:
    """Seeded, partition-independent pseudo-random number below 1,000,003 of a key of any type.

    Made of the leading hexadecimal digits of an MD5, which other engines have too. A null key counts as ''.
    """
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("bigint") % F.lit(1_000_003).cast("bigint")


def keep_priority(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    The rank filter is pushed below the shuffle as a group limit, so a key
    with many copies sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_k_rank", F.row_number().over(window)).where("_k_rank = 1").drop("_k_rank")


def stacked(tables: Sequence[DataFrame], priority: str = "_k_table") -> DataFrame:
    """Union by name, with the position of the table a row came from."""
    parts = [table.withColumn(priority, F.lit(i)) for i, table in enumerate(tables)]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def upsert(base: DataFrame, new: DataFrame, key: str, newest_wins: bool = True) -> DataFrame:
    """Union of two tables with one row per key; says which table wins."""
    order = F.col("_k_table").desc() if newest_wins else F.col("_k_table").asc()
    rest = [F.col(name) for name in base.columns if name != key]
    return keep_priority(stacked([base, new]), [key], [order, *rest]).drop("_k_table")


def unique_per(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """``key`` and ``cols`` with one row per key: the first by the columns' values, NULLs last."""
    return keep_priority(df.select(key, *cols), [key], [F.col(c).asc_nulls_last() for c in cols])


def latest_per_key(df: DataFrame, keys: Sequence[str], time: str, tie: str) -> DataFrame:
    """Last row per key in time order; a missing time counts as last."""
    return keep_priority(df, keys, [F.col(time).desc_nulls_first(), F.col(tie).desc_nulls_last()])


def rank_within(df: DataFrame, group: str, order: Column, key: str, out: str) -> DataFrame:
    """Exact ``row_number`` (from 1) within each group by ``(order, key)``.

    ``order`` must be a pseudo-random integer below 1,000,003. Its value range
    is cut into buckets; rows are ranked inside (group, bucket) and shifted by
    the rows of the buckets before, so no task sees a whole group.
    """
    df = df.withColumn("_r_order", order).withColumn(
        "_r_bucket", F.floor(F.col("_r_order") * RANK_BUCKETS / F.lit(1_000_003)).cast("int")
    )
    before = Window.partitionBy(group).orderBy("_r_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        df.groupBy(group, "_r_bucket")
        .count()
        .select(
            F.col(group).alias("_r_group"),
            F.col("_r_bucket").alias("_r_b"),
            F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_r_before"),
        )
    )
    inside = Window.partitionBy(group, "_r_bucket").orderBy("_r_order", key)
    return (
        df.withColumn(out, F.row_number().over(inside))
        .join(sizes, F.col(group).eqNullSafe(F.col("_r_group")) & (F.col("_r_bucket") == F.col("_r_b")))
        .withColumn(out, F.col(out) + F.col("_r_before"))
        .drop("_r_order", "_r_bucket", "_r_group", "_r_b", "_r_before")
    )


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Shuffled stratified folds 0..folds-1; class counts differ by one at most."""
    ranked = rank_within(df, label, keyed_hash(F.col(key), seed), key, "fold")
    return ranked.withColumn("fold", F.pmod(F.col("fold") - 1, F.lit(folds)).cast("int"))


def hash_split(df: DataFrame, key: str, shares: dict[str, int], seed: int = 42, out: str = "split") -> DataFrame:
    """Name a split per row by hash of its key; shares are parts of their sum."""
    place = F.pmod(keyed_hash(F.col(key), seed), F.lit(sum(shares.values())))
    column, edge = None, 0
    for name, share in shares.items():
        edge += share
        column = F.when(place < edge, name) if column is None else column.when(place < edge, name)
    return df.withColumn(out, column)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def positions(df: DataFrame, order: list[Column], pos: str, sums: dict[str, str] | None = None) -> DataFrame:
    """``df`` with its place (from 0) in the given order and, for ``sums`` {column: name}, running totals.

    Rows are range-partitioned, so no task holds them all; what lies before a
    partition is added from one row per partition. Totals include the row itself.
    The sorted rows are written once, which fixes the partition of every row.
    """
    sums = sums or {}
    part, place, count = fresh(df, "_part"), fresh(df, "_place"), fresh(df, "_count")
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    )
    placed = materialize(placed, "positions")
    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy(part).agg(F.count(F.lit(1)).alias(count), *(F.sum(c).alias(f"{count}_{c}") for c in sums))
    # One row per partition: as small as the list of tasks.
    before = before.select(
        F.col(part),
        F.coalesce(F.sum(count).over(ahead), F.lit(0)).alias(f"{count}_"),
        *(F.coalesce(F.sum(f"{count}_{c}").over(ahead), F.lit(0)).alias(f"{count}_{c}") for c in sums),
    )
    if sums:
        inside = Window.partitionBy(part).orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
        placed = placed.withColumns({name: F.sum(c).over(inside) for c, name in sums.items()})
    placed = placed.join(F.broadcast(before), part)
    found = {pos: F.col(place) + F.col(f"{count}_")} | {name: F.col(name) + F.col(f"{count}_{c}") for c, name in sums.items()}
    return placed.withColumns(found).select(*df.columns, pos, *sums.values())


def category_codes(df: DataFrame, col: str, out: str, modulo: int | None = None) -> DataFrame:
    """Table of distinct labels with their place in sorted order, from 0, however many there are."""
    labels = df.select(col).where(F.col(col).isNotNull()).distinct()
    code = F.col(out).cast("int")
    return positions(labels, [F.col(col)], out).withColumn(out, F.pmod(code, F.lit(modulo)) if modulo else code)

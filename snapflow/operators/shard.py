"""Positions in total key order, key limits and stride shards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapflow.session import cut

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def ordered_keys(df: DataFrame, key: str) -> DataFrame:
    return distinct_keys(df, key).orderBy(key)


def ordinal(df: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """0-based position of each row in the order of ``order``, which must be unique.

    A global window would sort everything in one task. Rows are range
    partitioned instead and numbered inside each partition; the sizes of the
    partitions before it give each partition its offset. The range partitioned
    rows are written once, because its sampled bounds differ between runs.
    """
    low = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    ranged = cut(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_mid", _ROW_BITS))
    # one row per range partition, so this window and the broadcast stay small
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + low)
        .drop("_part", "_mid", "_offset")
    )


def limit_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """First ``n`` rows in key order; all rows for n <= 0. Applied before sharding.

    By position, so that no task gathers the n first rows of every other.
    """
    if n <= 0:
        return df
    return ordinal(df, key, name="_pos").filter(F.col("_pos") < n).drop("_pos")


def stride_shard(df: DataFrame, key: str, index: int, count: int) -> DataFrame:
    """Every ``count``-th row in key order, starting at ``index``."""
    if count <= 1:
        return df
    return ordinal(df, key, name="_pos").filter(F.col("_pos") % count == index).drop("_pos")


def with_shard(df: DataFrame, key: str, count: int, name: str = "shard") -> DataFrame:
    """All stride shards at once, as a column."""
    if count <= 1:
        return df.withColumn(name, F.lit(0))
    numbered = ordinal(df, key, name="_pos")
    return numbered.withColumn(name, (F.col("_pos") % count).cast("int")).drop("_pos")


def union_shards(shards: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, shards)


def task_grid(keys: DataFrame, grades: list[int] | Column, name: str = "strong") -> DataFrame:
    """Each key with each grade; a generator, so no join and no shuffle."""
    if not isinstance(grades, Column):
        grades = F.array(*[F.lit(g) for g in grades])
    return keys.withColumn(name, F.explode(grades.cast("array<smallint>")))

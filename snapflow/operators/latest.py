"""Latest row per key and top rows per group."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapflow.functions.scalars import from_naive_utc

# Spark prunes row_number() <= n before the shuffle up to this n
_PRUNED_RANK = "spark.sql.optimizer.windowGroupLimitThreshold"


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key; ``order`` decides between all rows of a key.

    An aggregate rather than a window: each map task keeps one row per key, so
    a key holding a third of the input sends one row per task. A single, non-null
    order column, or a time and a whole number packed into one, over fixed-width
    columns needs no sort at all.
    """
    rest = [c for c in df.columns if c not in keys]
    packed = _packed(df, order)
    if packed is not None:
        newest = [F.max_by(c, "_order").alias(c) for c in rest]
        return df.withColumn("_order", packed).groupBy(*keys).agg(*newest).select(*df.columns)
    if len(order) == 1:
        newest = [F.max_by(c, order[0]).alias(c) for c in rest]
        return df.groupBy(*keys).agg(*newest).select(*df.columns)
    rest = [c for c in rest if c not in order]
    at = F.struct(*order)
    # apart, so that an unused order is pruned
    grouped = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), at).alias("_row"), F.max(at).alias("_at")
    )
    return grouped.select(*keys, "_row.*", "_at.*").select(*df.columns)


def _packed(df: DataFrame, order: list[str]) -> Column | None:
    """A time and a whole number as one fixed-width number in the same order, nulls least; None for other types."""
    types = dict(df.dtypes)
    if len(order) != 2 or types[order[0]] not in ("timestamp", "timestamp_ntz") or types[order[1]] not in ("int", "bigint"):
        return None
    at = F.col(order[0])
    micros = F.unix_micros(from_naive_utc(at) if types[order[0]] == "timestamp_ntz" else at)
    low = F.coalesce(F.col(order[1]).cast("bigint"), F.lit(-(1 << 63))).cast("decimal(20,0)") + F.lit(Decimal(1 << 63))
    high = F.coalesce(micros, F.lit(-(1 << 61))).cast("decimal(19,0)") * F.lit(Decimal(1 << 64))
    return (high + low).cast("decimal(38,0)")


def unique_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` unchanged, raising when a key occurs twice."""
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(
        F.any_value(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias("_n")
    )
    checked = F.when(
        F.col("_n") > 1,
        F.raise_error(F.concat(F.lit("duplicate key: "), F.to_json(F.struct(*keys)))).cast("boolean"),
    ).otherwise(True)
    return grouped.filter(checked).select(*keys, "_row.*").select(*df.columns)


def top_per_group(
    df: DataFrame, group: list[str], order: list[Column], n: int, tie: str
) -> DataFrame:
    """First ``n`` rows of each group with their rank; none for n <= 0.

    ``order`` must end in the unique column ``tie``. Each map task forwards at
    most n rows of a group; beyond the rank Spark prunes by itself, the same is
    done over salted sub-groups first.
    """
    if n <= 0:
        return df.withColumn("rank", F.lit(1)).filter(F.lit(False))
    conf = df.sparkSession.conf
    if n > int(conf.get(_PRUNED_RANK)):
        salt = F.pmod(F.xxhash64(tie), F.lit(int(conf.get("spark.sql.shuffle.partitions"))))
        part = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", salt)
            .withColumn("_r", F.row_number().over(part))
            .filter(F.col("_r") <= n)
            .drop("_salt", "_r")
        )
    whole = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= n)


def top_cards(df: DataFrame, n: int) -> DataFrame:
    """Best rated cards: rating descending with nulls last, then key."""
    if n <= 0:
        return df.filter(F.lit(False))
    return df.orderBy(F.desc_nulls_last("main_ovr"), F.asc("spid")).limit(n)


def top_cards_per_run(df: DataFrame, n: int) -> DataFrame:
    return top_per_group(
        df, ["run_id"], [F.desc_nulls_last("main_ovr"), F.asc("spid")], n, tie="spid"
    )


def previous(versions: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    """Each stored version of a key beside the value of the version before it; null for the first.

    A key has as many rows as versions changed it, so no window grows with the table.
    """
    return versions.withColumn(name, F.lag(value).over(Window.partitionBy(*keys).orderBy(order)))

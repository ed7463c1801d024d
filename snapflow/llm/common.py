"""What several operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.session import cut

_BATCH_ROWS = 256


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of at most 256 rows, so that long texts stay bounded."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > _BATCH_ROWS:
        spark.conf.set(key, str(_BATCH_ROWS))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected links: (node, root), root the smallest node reachable.

    Alternating large-star and small-star rounds: every node is linked to the
    smallest neighbour until all links point at roots. Each round is written,
    so lineage stays short and a lost executor costs one round. Minima are
    combined before the shuffle; a hub's links are split by the adaptive join.
    Null ends and links of a node to itself are ignored; roots are left out.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    now = cut(links.filter(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct())
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").filter(F.col("v") != F.col("m"))
        now = cut(
            moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).distinct()
        )
        ends = now.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            now.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        counts = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        # all links point at roots: no node has two of them, or one and is pointed at
        if not counts.filter("up + down > 1 and up > 0").take(1):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))

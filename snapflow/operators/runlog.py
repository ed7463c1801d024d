"""Run log: rows to append, counts, and per-run roll-ups over all runs at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.functions.scalars import batch_time, json_rows, or_zero, to_json_list, to_naive_utc
from snapflow.operators.shard import ordinal
from snapflow.operators.upsert import ACTION, INSERT, UPDATE
from snapflow.schemas import LOG_SEASONS, LOG_SPIDS, LOG_TRAITS, RUN_LOG
from snapflow.session import cut

SYNC, CRAWL = "sync", "crawl"
_LIST_ITEMS = 10_000  # most items aimed at per logged list


def _as_log(df: DataFrame) -> DataFrame:
    cols = [c.strip().split(" ") for c in RUN_LOG.split(",")]
    have = set(df.columns)
    return df.select(
        *[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in cols]
    )


def sync_counts(catalogue: DataFrame, seasons: DataFrame) -> DataFrame:
    """New keys and new seasons of one catalogue run."""
    inserted = F.count_if(F.col(ACTION) == INSERT)
    spids = catalogue.agg(inserted.alias("new_spids"))
    return spids.withColumn("new_seasons", seasons.agg(inserted).scalar())


def sync_log(
    catalogue: DataFrame, seasons: DataFrame, run_id: str, now, items: int = _LIST_ITEMS
) -> DataFrame:
    """Log rows of a catalogue run.

    Lists keep the order of the ``place`` column, or of the key without one. One row
    while the new keys fit one list; a first load of any size fills further rows,
    numbered by ``seq``, so no single list holds them all. Readers concatenate the
    lists of all sync rows of a run.
    """
    def inserted(merged: DataFrame, *cols: str) -> DataFrame:
        # counted and listed below, so the upsert behind it runs once
        new = merged.filter(F.col(ACTION) == INSERT)
        new = new if "place" in new.columns else new.withColumn("place", F.col(cols[0]))
        numbered = ordinal(new.select(*cols, "place"), "place", cols[0], name="at")
        return cut(numbered.withColumn("row", F.floor(F.col("at") / items).cast("int")).drop("place"))

    new_spids = inserted(catalogue, "spid")
    new_seasons = inserted(seasons, "season_id", "class_name")
    total = F.greatest(
        new_spids.agg(F.count(F.lit(1))).scalar(), new_seasons.agg(F.count(F.lit(1))).scalar()
    )
    rows = F.greatest(F.lit(1), F.ceil(total / items)).cast("int")

    def lists(df: DataFrame, key: str, item: Column, name: str, count: str) -> DataFrame:
        in_order = F.transform(F.sort_array(F.collect_list(F.struct("at", item.alias("item")))), lambda x: x["item"])
        return df.groupBy("row").agg(to_json_list(in_order).alias(name), F.count(F.lit(1)).alias(count))

    spark = catalogue.sparkSession
    return _as_log(
        spark.range(1)
        .select(F.explode(F.sequence(F.lit(0), rows - 1)).alias("row"))
        .join(lists(new_spids, "spid", F.col("spid"), "new_spids", "n"), "row", "left")
        .join(
            lists(new_seasons, "season_id", F.struct("season_id", "class_name"), "new_seasons", "m"),
            "row", "left",
        )
        .select(
            F.lit(run_id).alias("run_id"),
            F.lit(SYNC).alias("phase"),
            F.col("row").alias("seq"),
            or_zero(F.col("n")).alias("new_players"),
            F.coalesce("new_spids", F.lit("[]")).alias("new_spids"),
            F.coalesce("new_seasons", F.lit("[]")).alias("new_seasons"),
            batch_time(now).alias("created_at"),
        )
    )


def shard_counts(merged: DataFrame, rejects: DataFrame) -> DataFrame:
    """Inserted, updated and failed cards per shard; shards without either are absent."""
    written = merged.select(
        "shard",
        (F.col(ACTION) == INSERT).alias("new"),
        (F.col(ACTION) == UPDATE).alias("upd"),
        F.lit(False).alias("bad"),
    )
    failed = rejects.select(
        "shard", F.lit(False).alias("new"), F.lit(False).alias("upd"), F.lit(True).alias("bad")
    )
    return written.unionByName(failed).groupBy("shard").agg(
        F.count_if("new").alias("new_players"),
        F.count_if("upd").alias("changed"),
        F.count_if("bad").alias("failures"),
    )


def crawl_log(
    counts: DataFrame, new_traits: DataFrame, run_id: str, now, shards: int = 1
) -> DataFrame:
    """One log row per shard, empty shards included.

    ``new_traits`` holds (shard, id, name); ids are smallint, which bounds the list.
    """
    spark = counts.sparkSession
    all_shards = spark.range(shards).select(F.col("id").cast("int").alias("shard"))
    traits = new_traits.groupBy("shard").agg(
        to_json_list(F.sort_array(F.collect_list(F.struct("id", "name")))).alias("new_traits")
    )
    return _as_log(
        all_shards.join(counts, "shard", "left")
        .join(traits, "shard", "left")
        .select(
            F.lit(run_id).alias("run_id"),
            F.lit(CRAWL).alias("phase"),
            "shard",
            *[or_zero(F.col(c)).alias(c) for c in ("new_players", "changed", "failures")],
            F.coalesce("new_traits", F.lit("[]")).alias("new_traits"),
            batch_time(now).alias("created_at"),
        )
    )


def append_log(rows: DataFrame, path: str) -> None:
    # few files per run, and a run with very many rows in several tasks
    rows.hint("rebalance", F.col("run_id")).write.mode("append").partitionBy("run_id").parquet(path)


def put_log(rows: DataFrame, path: str, name: str) -> None:
    """Log rows as the part ``name`` of their run, in place of what that part held: written twice they count once."""
    named = rows.withColumn("part", F.lit(name)).hint("rebalance", F.col("run_id"))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "part").parquet(path)


def run_totals(log: DataFrame, expected: int) -> DataFrame:
    """Per run: sums over crawl rows, shards seen and missing, time of the first row."""
    crawl = F.col("phase") == CRAWL

    def total(c: str) -> Column:
        return F.sum(F.when(crawl, or_zero(F.col(c))).otherwise(0)).alias(c)

    logged = F.count_distinct(F.when(crawl, F.col("shard")))
    return log.groupBy("run_id").agg(
        total("new_players"),
        total("changed"),
        total("failures"),
        logged.cast("int").alias("shards_logged"),
        F.lit(expected).alias("shards_expected"),
        (expected - logged).cast("int").alias("missing_shards"),
        F.min("created_at").alias("first_logged"),
    )


def run_since(log: DataFrame) -> DataFrame:
    """Start of each run as naive UTC."""
    return log.groupBy("run_id").agg(to_naive_utc(F.min("created_at")).alias("since"))


def logged_traits(log: DataFrame, order: list[str]) -> DataFrame:
    """New traits per run, one row per id: last name wins, place of the first mention."""
    items = log.filter(F.col("phase") == CRAWL).select(
        "run_id", *order, F.posexplode(json_rows(F.col("new_traits"), LOG_TRAITS)).alias("pos", "t")
    )
    at = F.struct(*order, "pos")
    return items.groupBy("run_id", F.col("t.id").alias("id")).agg(
        F.max_by("t.name", at).alias("name"), F.min(at).alias("first_at")
    )


def logged_seasons(log: DataFrame, order: list[str]) -> DataFrame:
    """New seasons per run in logged order, duplicates kept."""
    return log.filter(F.col("phase") == SYNC).select(
        "run_id",
        *order,
        F.posexplode(json_rows(F.col("new_seasons"), LOG_SEASONS)).alias("pos", "s"),
    ).select("run_id", F.struct(*order, "pos").alias("at"), "s.season_id", "s.class_name")


def logged_spids(log: DataFrame) -> DataFrame:
    """New card keys per run, duplicates kept."""
    return log.filter(F.col("phase") == SYNC).select(
        "run_id", F.explode(json_rows(F.col("new_spids"), LOG_SPIDS)).alias("spid")
    )

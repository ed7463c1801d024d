"""Landed inputs and narrow reads of the maintained tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow import schemas
from snapflow.functions.text import page_key


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGES).parquet(path)


def with_page_keys(pages: DataFrame) -> DataFrame:
    """Card key and grade from the page address; null when absent or malformed."""
    return pages.withColumn("spid", page_key(F.col("url"), "spid")).withColumn(
        "strong", page_key(F.col("url"), "n1Strong", "smallint")
    )


def _place() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    ).alias("place")


def read_card_catalogue(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Catalogue of (spid, name, place), a JSON array or, for large ones, JSON lines.

    An array file is one split; JSON lines are read in parallel. ``place`` orders the
    entries as the files have them: by file, split and row.
    """
    raw = spark.read.schema(schemas.CARD_CATALOGUE).option("multiLine", not lines).json(path)
    return raw.select(F.col("id").alias("spid"), "name", _place())


def read_season_catalogue(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    raw = spark.read.schema(schemas.SEASON_CATALOGUE).option("multiLine", not lines).json(path)
    return raw.select(
        F.col("seasonId").alias("season_id"),
        F.col("className").alias("class_name"),
        F.col("seasonImg").alias("season_img"),
        _place(),
    )


def card_keys(players: DataFrame) -> DataFrame:
    return players.select("spid").distinct()


def target_keys(spid: DataFrame, only_new: bool = False) -> DataFrame:
    """All catalogue keys, or only those not done yet."""
    keys = spid.filter(~F.col("crawled")) if only_new else spid
    return keys.select("spid")


def for_keys(df: DataFrame, keys: DataFrame, key: str = "spid") -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


def existing_state(players: DataFrame, keys: DataFrame) -> DataFrame:
    """What change detection needs of the known cards among ``keys``."""
    return for_keys(players.select("spid", "id", "content_hash", "main_ovr"), keys)


def known_ids(dim: DataFrame) -> DataFrame:
    return dim.select("id")


def read_run_log(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """Logged rows; one run reads only its own partition."""
    log = spark.read.schema(schemas.RUN_LOG).parquet(path)
    log = log.select(*[c.strip().split(" ")[0] for c in schemas.RUN_LOG.split(",")])
    return log if run_id is None else log.filter(F.col("run_id") == run_id)

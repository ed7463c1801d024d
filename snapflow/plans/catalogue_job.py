"""Catalogue job: card and season catalogues to their tables, and one sync log entry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.operators.runlog import sync_log
from snapflow.operators.shard import limit_keys
from snapflow.operators.upsert import upsert_catalogue, upsert_seasons
from snapflow.session import cut
from snapflow.sources.readers import target_keys


@dataclass
class CatalogueRun:
    spid: DataFrame      # card catalogue after the run, with the action per key
    seasons: DataFrame   # season table after the run, with the action per season
    log: DataFrame       # sync rows


def placed(catalogue: DataFrame) -> DataFrame:
    """Entries with their place in the source; a frame that no reader placed is taken in partition order."""
    if "place" in catalogue.columns:
        return catalogue
    return catalogue.withColumn("place", F.monotonically_increasing_id())


def leading(catalogue: DataFrame, n: int) -> DataFrame:
    """First ``n`` entries in source order, with their place; all of them for n <= 0."""
    return limit_keys(placed(catalogue), "place", n)


def last_of_each(catalogue: DataFrame, key: str) -> DataFrame:
    """One entry per key, the last in source order; null keys are left out."""
    rest = [c for c in catalogue.columns if c not in (key, "place")]
    grouped = catalogue.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.max_by(F.struct(*rest), "place").alias("_row"), F.max("place").alias("place")
    )
    return grouped.select(key, "_row.*", "place")


def run_catalogue_job(
    cards: DataFrame,
    seasons: DataFrame,
    spid: DataFrame,
    season_table: DataFrame,
    run_id: str,
    now,
    limit: int = 0,
) -> CatalogueRun:
    """Upsert both catalogues; runs once before the card job of the same run.

    Of several entries of a key the last counts. Lists are logged in source order.
    """
    card_batch = cut(last_of_each(leading(cards, limit), "spid"))
    season_batch = cut(last_of_each(placed(seasons), "season_id"))
    merged = cut(upsert_catalogue(spid, card_batch.drop("place")))
    merged_seasons = cut(upsert_seasons(season_table, season_batch.drop("place")))
    log = sync_log(
        merged.join(card_batch.select("spid", "place"), "spid", "left"),
        merged_seasons.join(season_batch.select("season_id", "place"), "season_id", "left"),
        run_id, now,
    )
    return CatalogueRun(merged, merged_seasons, log)


def card_targets(spid: DataFrame, only_new: bool = False, limit: int = 0) -> DataFrame:
    """Keys the card job works on: all or undone ones, limited in key order."""
    return limit_keys(target_keys(spid, only_new), "spid", limit)

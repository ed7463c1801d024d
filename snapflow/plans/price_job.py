"""Price job: landed price pages to changed rows of the latest-price table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from snapflow.operators.extract import latest_prices
from snapflow.operators.latest import latest_per_key
from snapflow.operators.shard import limit_keys, stride_shard, task_grid
from snapflow.operators.upsert import upsert_latest
from snapflow.schemas import PRICE_LATEST
from snapflow.sources import snapshots
from snapflow.sources.readers import card_keys

KEYS = ["spid", "strong"]


def work_list(
    players: DataFrame, grades: Column | list[int], limit: int = 0, index: int = 0, count: int = 1
) -> DataFrame:
    """(spid, strong) pairs of one shard; the limit applies before sharding."""
    keys = stride_shard(limit_keys(card_keys(players), "spid", limit), "spid", index, count)
    return task_grid(keys, grades)


def price_batch(pages: DataFrame, as_of: Column, work: DataFrame | None = None) -> DataFrame:
    """Latest price per (spid, strong) of the landed pages, for the pairs of a work list.

    Of several pages of one pair the last landed, by page id, counts.
    """
    points = latest_prices(pages, as_of)
    if work is not None:
        points = points.join(work.select(*KEYS), KEYS, "left_semi")
    return latest_per_key(points, KEYS, ["page_id"]).drop("page_id")


def commit_prices(batch: DataFrame, root: str, now, commit_id: str | None = None, buckets: int = 64) -> int:
    """Merge one price per pair into the snapshot under ``root``, laid out for search:
    grades are folders, and prices are sorted in each file. Returns the version."""
    return snapshots.commit(
        batch,
        root,
        PRICE_LATEST,
        KEYS,
        lambda state, batch, keys: upsert_latest(state, batch, now, keys),
        buckets,
        commit_id,
        layout=("strong",),
        order=("price",),
    )


def run_price_job(
    pages: DataFrame,
    root: str,
    as_of: Column,
    now,
    commit_id: str | None = None,
    work: DataFrame | None = None,
    buckets: int = 64,
) -> int:
    """Merge landed price pages into the snapshot under ``root``; returns its version.

    ``work`` limits the run to the pairs of a work list; ``commit_id`` names the run
    and its shard.
    """
    return commit_prices(price_batch(pages, as_of, work), root, now, commit_id, buckets)

"""Incremental ingest: landed files in bounded batches into the snapshot."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapflow.operators.upsert import upsert_latest
from snapflow.plans.price_job import KEYS, price_batch
from snapflow.queries import prices
from snapflow.queries.registry import query
from snapflow.schemas import PRICE_LATEST
from snapflow.session import work_dir
from snapflow.sources import snapshots
from snapflow.streaming.ingest import ingest_pages, spread_pages, upsert_stream


@query(f"""
WITH {prices.SERIES_SQL}
SELECT spid, strong, CAST(price_date AS VARCHAR) AS price_date, price FROM series WHERE i = n_points - 1
""")
def stream_price_pages(spark, sf_dir):
    """Landed price pages streamed file by file into the latest-price snapshot."""
    landed, root = work_dir(spark, "landed"), work_dir(spark, "stream")
    # row groups small enough that several tasks read a file
    prices.price_pages(spark, sf_dir).repartition(3, "page_id").write.option("parquet.block.size", 8 << 20).parquet(landed)
    upsert_stream(
        ingest_pages(spark, landed, max_files=1), root, PRICE_LATEST, KEYS,
        lambda pages: price_batch(spread_pages(pages), F.lit(prices.AS_OF)),
        lambda state, batch, keys: upsert_latest(state, batch, prices.SECOND, keys),
        work_dir(spark, "offsets"), buckets=8,
    ).awaitTermination()
    state = snapshots.read_snapshot(spark, root, PRICE_LATEST)
    return state.select(
        "spid", F.col("strong").cast("bigint").alias("strong"),
        F.col("price_date").cast("string").alias("price_date"), "price",
    )


@query(f"{prices.SLICES_SQL} SELECT spid, strong, price, price_date, updated_on FROM state")
def stream_upsert(spark, sf_dir):
    """Two landed slices streamed into the snapshot, each stamped with its own time."""
    landed, root = work_dir(spark, "landed"), work_dir(spark, "stream")
    schema = "spid bigint, strong smallint, price bigint, price_date date"
    old, new = prices.state_and_batch(spark, sf_dir)
    offsets = work_dir(spark, "offsets")
    for rows, now in ((old.drop("updated_at"), prices.FIRST), (new, prices.SECOND)):
        rows.select("spid", "strong", "price", "price_date").write.mode("append").parquet(landed)
        upsert_stream(
            ingest_pages(spark, landed, schema=schema), root, PRICE_LATEST, KEYS,
            lambda batch: batch,
            lambda state, batch, keys, now=now: upsert_latest(state, batch, now, keys),
            offsets, buckets=8,
        ).awaitTermination()
    return prices._plain(snapshots.read_snapshot(spark, root, PRICE_LATEST))


@query(f"{prices.SLICES_SQL} SELECT spid, strong, price, price_date, updated_on FROM state")
def two_streams(spark, sf_dir):
    """Two streams into one snapshot, each with its own checkpoint: the first batch of both counts."""
    root = work_dir(spark, "stream")
    schema = "spid bigint, strong smallint, price bigint, price_date date"
    old, new = prices.state_and_batch(spark, sf_dir)
    for rows, now in ((old.drop("updated_at"), prices.FIRST), (new, prices.SECOND)):
        landed = work_dir(spark, "landed")
        rows.select("spid", "strong", "price", "price_date").write.parquet(landed)
        upsert_stream(
            ingest_pages(spark, landed, schema=schema), root, PRICE_LATEST, KEYS,
            lambda batch: batch,
            lambda state, batch, keys, now=now: upsert_latest(state, batch, now, keys),
            work_dir(spark, "offsets"), buckets=8,
        ).awaitTermination()
    return prices._plain(snapshots.read_snapshot(spark, root, PRICE_LATEST))

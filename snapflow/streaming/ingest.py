"""Incremental runs over newly landed pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from snapflow.operators.upsert import ACTION, INSERT
from snapflow.plans.kept_tables import card_transaction, has_undone
from snapflow.schemas import PAGES
from snapflow.sources import snapshots
from snapflow.sources.transactions import find_record, unfinished


def ingest_pages(
    spark: SparkSession, path: str, max_files: int = 1000, schema: str = PAGES
) -> DataFrame:
    """New files under ``path`` as a stream, in batches of at most ``max_files``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def spread_pages(pages: DataFrame) -> DataFrame:
    """Pages of a micro-batch over all tasks, before they are parsed.

    A file written by one task is often one row group and so one split, whose pages one task would parse.
    """
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pages.repartition(tasks, "page_id", "url")


def upsert_stream(
    stream: DataFrame,
    root: str,
    schema: str,
    keys: list[str],
    to_batch: Callable[[DataFrame], DataFrame],
    merge: Callable[[DataFrame, DataFrame, list[str]], DataFrame],
    checkpoint: str,
    buckets: int = 64,
    name: str | None = None,
) -> StreamingQuery:
    """Merge everything landed so far into the snapshot under ``root``, then stop.

    Each micro-batch is one commit named by the stream and its batch id, so a batch
    replayed after a failure changes nothing. The stream's name is its checkpoint
    folder unless given: another stream, or a new checkpoint, is never taken for it.
    """
    name = name or checkpoint

    def commit(batch: DataFrame, batch_id: int) -> None:
        rows = to_batch(batch)
        snapshots.commit(rows, root, schema, keys, merge, buckets, commit_id=f"{name}#{batch_id}")

    return (
        stream.writeStream.foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def pending_work(catalogue: DataFrame, spid: DataFrame) -> DataFrame:
    """Keys a catalogue run gained, and keys still undone; one row."""
    gained = catalogue.agg(F.count_if(F.col(ACTION) == INSERT).alias("gained"))
    return gained.withColumn("undone", spid.agg(F.count_if(~F.col("crawled"))).scalar())


def needs_run(catalogue: DataFrame, spid: DataFrame) -> bool:
    """Whether the card stage has work: the catalogue gained keys or some are undone."""
    gained = catalogue.filter(F.col(ACTION) == INSERT).select("spid")
    undone = spid.filter(~F.col("crawled")).select("spid")
    return not gained.limit(1).unionByName(undone.limit(1)).isEmpty()


def card_stream(
    stream: DataFrame,
    store: str,
    run_id: str,
    now,
    checkpoint: str,
    shards: int = 1,
    buckets: int = 64,
    name: str | None = None,
    only_new: bool = True,
) -> StreamingQuery:
    """Run the kept card job on all card pages landed so far, batch by batch, then stop.

    A micro-batch is one transaction named by the run, the stream and its batch id, so the progress of the source and
    the tables stay in step: a batch that comes again is found by its name, and one that died half done is carried
    out. With ``only_new`` the gate comes first: a batch does nothing while no card of the catalogue is undone.
    The stream's name is its checkpoint folder unless given.
    """
    name = name or checkpoint

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, part = batch.sparkSession, f"{name}#{batch_id}"
        known = find_record(spark, store, f"{run_id}/{part}") is not None
        if known and not unfinished(spark, store):
            return
        if known or not only_new or has_undone(spark, store):
            card_transaction(batch, store, run_id, now, shards, buckets=buckets, part=part).commit()

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

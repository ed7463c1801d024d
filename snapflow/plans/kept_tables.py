"""The catalogue and card jobs on tables they keep: players, members, catalogue, seasons and log under one folder.

    <store>/players, members, spid, seasons   snapshots
    <store>/log/run_id=<id>/part=<job>        log rows
    <store>/tx, intents, done                 transactions over them

A job is one transaction named by its run and part. Its rows are stored before a table is touched, so a job that
died is repeated, or finished by the next one, without being computed again, and every table changes once. Jobs
may run side by side: of two that started from the same tables the later one resolves its names, ids and changes
again from what the earlier one left, but parses its pages once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.operators.runlog import put_log
from snapflow.operators.upsert import ACTION, KEEP, changes, upsert, upsert_catalogue
from snapflow.plans.card_job import apply_cards, parse_cards
from snapflow.plans.catalogue_job import last_of_each, leading, placed, run_catalogue_job
from snapflow.schemas import PLAYERS, SEASON, SPID
from snapflow.session import cut
from snapflow.sources import snapshots
from snapflow.sources.readers import existing_state, for_keys
from snapflow.sources.transactions import Prepared, Record, Transaction

MEMBERS = "dim string, id int, name string, attribute string"
#: Schema, key and the columns that tell whether a row differs.
TABLES = {
    "members": (MEMBERS, ["dim", "id"], ["name"]),
    "players": (PLAYERS, ["spid"], ["content_hash", "updated_at"]),
    "spid": (SPID, ["spid"], ["name", "crawled", "crawled_at"]),
    "seasons": (SEASON, ["season_id"], ["class_name", "season_img"]),
}
LOG = "log"
HIGHEST = "highest player id"


def read_kept(spark: SparkSession, store: str, table: str) -> DataFrame:
    return snapshots.read_snapshot(spark, f"{store}/{table}", TABLES[table][0])


def kept_for(keys: DataFrame, store: str, table: str) -> DataFrame:
    """Rows of a kept table for some keys: only the keys' buckets are opened."""
    schema, by, _ = TABLES[table]
    return snapshots.read_for_keys(keys, f"{store}/{table}", schema, by)


def known_cards(keys: DataFrame, store: str) -> DataFrame:
    """What change detection needs of the kept cards among ``keys``."""
    return existing_state(kept_for(keys, store, "players"), keys)


def apply_rows(store: str, buckets: int):
    """Writes the rows of one table of a transaction; done again, it changes nothing."""

    def apply(table: str, rows: DataFrame, name: str) -> None:
        if table == LOG:
            put_log(rows, f"{store}/{LOG}", name)
            return
        schema, keys, compare = TABLES[table]
        snapshots.commit(
            rows, f"{store}/{table}", schema, keys,
            lambda state, batch, keys: upsert(state, batch, keys, compare), buckets, name,
        )

    return apply


def _transaction(spark: SparkSession, store: str, name: str, prepare, buckets: int) -> Transaction:
    return Transaction(spark, store, name, prepare, apply_rows(store, buckets))


def card_transaction(
    pages: DataFrame, store: str, run_id: str, now, shards: int = 1, targets: DataFrame | None = None,
    buckets: int = 64, shard: int | None = None, part: str | None = None,
) -> Transaction:
    """One card run as a transaction: new members, changed cards, marks of processed cards and log rows.

    ``shard`` is the number of a job that runs beside others of the same run, over its own pages. The name is made of
    run and ``part``, by default the shard. Only the buckets of the landed cards are read; the highest id in
    use comes from the record of the transaction before.
    """
    spark = pages.sparkSession
    parsed: list[DataFrame] = []

    def prepare(last: Record | None) -> Prepared:
        if not parsed:
            parsed.append(parse_cards(pages, targets))
        records = parsed[0]
        keys = records.select("spid").filter(F.col("spid").isNotNull())
        players = kept_for(keys, store, "players")
        top = last and last.facts.get(HIGHEST)
        if top is None:  # the store is new, or older than its records
            top = read_kept(spark, store, "players").agg(F.max("id")).first()[0] or 0
        spid = for_keys(kept_for(keys, store, "spid"), keys)
        members = read_kept(spark, store, "members")
        run = apply_cards(records, players, spid, members, run_id, now, shards, shard, int(top))
        highest = run.landed.agg(F.max("id")).first()[0] or 0
        # all rows are computed from the tables before the run
        return Prepared(
            {
                "members": run.created,
                "players": changes(run.landed).drop(ACTION),
                "spid": for_keys(run.spid, run.landed.filter(F.col(ACTION) != KEEP)),
                LOG: run.log,
            },
            {HIGHEST: str(max(int(top), highest))},
        )

    name = f"{run_id}/{part or ('cards' if shard is None else f'cards-{shard}')}"
    return _transaction(spark, store, name, prepare, buckets)


def run_kept_card_job(
    pages: DataFrame, store: str, run_id: str, now, shards: int = 1, targets: DataFrame | None = None,
    buckets: int = 64, shard: int | None = None, part: str | None = None,
) -> Record:
    """One card run against the kept tables, written to them; repeated under its name it changes nothing,
    and what an earlier attempt left undone is done."""
    return card_transaction(pages, store, run_id, now, shards, targets, buckets, shard, part).commit()


def _carried(last: Record | None) -> dict[str, str]:
    """Facts that a job without new cards hands on."""
    return {HIGHEST: last.facts[HIGHEST]} if last and HIGHEST in last.facts else {}


def add_to_catalogue(entries: DataFrame, store: str, name: str, buckets: int = 64) -> Record:
    """Merge catalogue rows (spid, name), unique per key, without a log row; known keys take a new name only."""

    def prepare(last: Record | None) -> Prepared:
        merged = upsert_catalogue(kept_for(entries, store, "spid"), entries)
        return Prepared({"spid": changes(merged).drop(ACTION)}, _carried(last))

    return _transaction(entries.sparkSession, store, name, prepare, buckets).commit()


def catalogue_transaction(
    cards: DataFrame, seasons: DataFrame, store: str, run_id: str, now, limit: int = 0, buckets: int = 64
) -> Transaction:
    """The catalogue job as a transaction: new and renamed cards and seasons, and the sync rows of the log."""
    spark = cards.sparkSession
    given: list[DataFrame] = []

    def prepare(last: Record | None) -> Prepared:
        if not given:
            given.extend([cut(last_of_each(leading(cards, limit), "spid")), cut(last_of_each(placed(seasons), "season_id"))])
        run = run_catalogue_job(
            *given, kept_for(given[0], store, "spid"), read_kept(spark, store, "seasons"), run_id, now,
        )
        rows = {"seasons": changes(run.seasons).drop(ACTION), "spid": changes(run.spid).drop(ACTION), LOG: run.log}
        return Prepared(rows, _carried(last))

    return _transaction(spark, store, f"{run_id}/sync", prepare, buckets)


def run_kept_catalogue_job(
    cards: DataFrame, seasons: DataFrame, store: str, run_id: str, now, limit: int = 0, buckets: int = 64
) -> Record:
    """Both catalogues against the kept tables, and their log rows; runs once before the card jobs of its run."""
    return catalogue_transaction(cards, seasons, store, run_id, now, limit, buckets).commit()


def has_undone(spark: SparkSession, store: str) -> bool:
    """The gate of the card stage: whether the kept catalogue has a card that is not done."""
    return not read_kept(spark, store, "spid").filter(~F.col("crawled")).limit(1).isEmpty()

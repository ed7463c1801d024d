"""Kept tables: jobs that die and are repeated, several writers, pruned reads, streamed cards."""

import datetime as dt
import shutil
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from snapflow.operators.upsert import upsert_latest
from snapflow.plans import kept_tables
from snapflow.queries.cards import card_key, card_pages
from snapflow.queries.registry import table
from snapflow.schemas import PLAYERS, PRICE_LATEST
from snapflow.sources import snapshots, transactions
from snapflow.sources.markers import create_if_absent, names, numbered, read_text
from snapflow.sources.readers import read_run_log
from snapflow.streaming.ingest import card_stream, ingest_pages

SF = "/root/testdata/sf0.001"
FIRST, SECOND = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8)
KEYS = ["spid", "strong"]


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    """(earlier pages, all pages) of 36 cards, a few defective."""
    out = []
    for name, size in (("early", F.col("p_size") - (F.col("p_partkey") % 3 == 0).cast("int")), ("all", None)):
        path = str(tmp_path_factory.mktemp("pages") / name)
        made = card_pages(spark, SF, size).filter("page_id <= 36")
        (made.filter("page_id % 5 <> 0") if name == "early" else made).coalesce(2).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def catalogue(spark):
    parts = table(spark, SF, "part").filter("p_partkey <= 40")
    return parts.select(card_key(F.col("p_partkey")).alias("spid"), F.col("p_name").alias("name"))


def new_store(spark, path):
    store = str(path)
    kept_tables.add_to_catalogue(catalogue(spark), store, "r1/sync", buckets=2)
    return store


def state(spark, store):
    """All that the tables hold, the log included."""
    out = {t: rows(kept_tables.read_kept(spark, store, t), "*") for t in ("players", "members", "spid")}
    out["log"] = rows(read_run_log(spark, f"{store}/log"), "run_id", "shard", "new_players", "changed", "failures", "new_traits")
    return out


def by_name(spark, store):
    """What the tables say whatever the ids of names are."""
    members = kept_tables.read_kept(spark, store, "members")
    players = kept_tables.read_kept(spark, store, "players").withColumn("id", F.explode("trait_ids"))
    named = players.join(members.filter("dim = 'trait'").select("id", F.col("name").alias("trait")), "id")
    return rows(named, "spid", "main_ovr", "updated_at", "ovr_change", "trait"), rows(members, "dim", "name")


class Died(Exception):
    pass


@pytest.fixture(scope="module")
def first_run(spark, pages, tmp_path_factory):
    """A store after the first run; tests work on copies."""
    store = new_store(spark, tmp_path_factory.mktemp("kept") / "s")
    kept_tables.run_kept_card_job(pages[0], store, "r1", FIRST, shards=2, buckets=2)
    return store


@pytest.fixture(scope="module")
def undisturbed(spark, pages, first_run, tmp_path_factory):
    store = shutil.copytree(first_run, str(tmp_path_factory.mktemp("kept") / "s"))
    kept_tables.run_kept_card_job(pages[1], store, "r2", SECOND, shards=2, buckets=2)
    return state(spark, store)


@pytest.mark.parametrize("step", ["intents", "record", "members", "players", "spid", "log"])
def test_died_and_repeated(spark, pages, first_run, undisturbed, tmp_path, monkeypatch, step):
    """A job that dies after any step and is repeated leaves the tables of an undisturbed one."""
    store = shutil.copytree(first_run, str(tmp_path / "s"))
    real_apply, real_create = kept_tables.apply_rows, transactions.create_if_absent

    def dying_apply(store, buckets):
        def apply(table, rows, name):
            if step == "record":
                raise Died
            real_apply(store, buckets)(table, rows, name)
            if table == step:
                raise Died
        return apply

    def dying_create(spark, path, text):
        if step == "intents" and "/tx/" in path:
            raise Died
        return real_create(spark, path, text)

    with monkeypatch.context() as m:
        m.setattr(kept_tables, "apply_rows", dying_apply)
        m.setattr(transactions, "create_if_absent", dying_create)
        with pytest.raises(Died):
            kept_tables.run_kept_card_job(pages[1], store, "r2", SECOND, shards=2, buckets=2)
    assert transactions.unfinished(spark, store) == ([] if step == "intents" else [3])
    kept_tables.run_kept_card_job(pages[1], store, "r2", SECOND, shards=2, buckets=2)
    assert state(spark, store) == undisturbed
    kept_tables.run_kept_card_job(pages[0], store, "r2", SECOND, shards=2, buckets=2)  # by its name: done
    assert state(spark, store) == undisturbed
    assert transactions.unfinished(spark, store) == []


def test_a_dead_job_is_carried_out_by_the_next(spark, pages, undisturbed, tmp_path):
    store = new_store(spark, tmp_path / "s")
    kept_tables.card_transaction(pages[0], store, "r1", FIRST, shards=2, buckets=2).take()
    assert kept_tables.read_kept(spark, store, "players").count() == 0
    kept_tables.run_kept_card_job(pages[1], store, "r2", SECOND, shards=2, buckets=2)
    assert state(spark, store) == undisturbed


def test_writers_from_one_base(spark, pages, tmp_path):
    """Four jobs prepared from the same tables and committed in any order: the tables of the same order in sequence."""
    order = (2, 0, 3, 1)
    stores = [new_store(spark, tmp_path / n) for n in ("together", "sequence")]
    jobs = {}
    for store in stores:
        jobs[store] = [
            kept_tables.card_transaction(pages[1].filter(F.col("page_id") % 4 == i), store, "r1", FIRST, buckets=2, shard=i) for i in range(4)
        ]
    for job in jobs[stores[0]]:
        job.prepare()
    for i in order:
        jobs[stores[0]][i].commit()
    for i in order:
        jobs[stores[1]][i].commit()
    assert state(spark, stores[0]) == state(spark, stores[1])
    ids = rows(kept_tables.read_kept(spark, stores[0], "players"), "id")
    assert ids == sorted(((i + 1,) for i in range(len(ids))), key=str)


def test_writers_at_the_same_time(spark, pages, tmp_path):
    one, many = new_store(spark, tmp_path / "one"), new_store(spark, tmp_path / "many")
    kept_tables.run_kept_card_job(pages[1], one, "r1", FIRST, buckets=2)
    with ThreadPoolExecutor(3) as pool:
        jobs = [
            pool.submit(kept_tables.run_kept_card_job, pages[1].filter(F.col("page_id") % 3 == i), many, "r1", FIRST, buckets=2, shard=i) for i in range(3)
        ]
        for job in jobs:
            job.result()
    assert by_name(spark, one) == by_name(spark, many)
    assert transactions.unfinished(spark, many) == [] and numbered(spark, f"{many}/tx") == [1, 2, 3, 4]


BATCH = "spid bigint, strong smallint, price bigint, price_date date"


def put(spark, root, given, commit_id=None, buckets=8):
    batch = spark.createDataFrame([(k, 1, v, None) for k, v in given.items()], BATCH)
    return snapshots.commit(batch, root, PRICE_LATEST, KEYS, lambda s, b, k: upsert_latest(s, b, FIRST, k), buckets, commit_id)


def prices(spark, root, version=None):
    return {r.spid: r.price for r in snapshots.read_snapshot(spark, root, PRICE_LATEST, version).collect()}


def test_a_later_writer_keeps_what_the_other_did_not_touch(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    put(spark, root, {k: k for k in range(60)}, "base")
    merged, real, real_create = [], snapshots._merged, snapshots.create_if_absent
    batch = {k: 100 + k for k in range(60)}

    def spy(batch, current, hit, *rest):
        merged.append(set(hit))
        return real(batch, current, hit, *rest)

    def overtaken(spark, path, text):
        monkeypatch.setattr(snapshots, "create_if_absent", real_create)
        put(spark, root, {3: 1_003, 70: 70}, "other")  # gets the number first
        return real_create(spark, path, text)

    monkeypatch.setattr(snapshots, "_merged", spy)
    monkeypatch.setattr(snapshots, "create_if_absent", overtaken)
    assert put(spark, root, batch, "mine") == 3
    assert prices(spark, root) == {**batch, 70: 70}
    assert prices(spark, root, 2)[3] == 1_003
    whole, others, again = merged
    assert again == others & whole and len(again) < len(whole)  # the rest of the buckets stayed as merged
    assert snapshots.commit_counts(spark, root, 3).first().asDict() == {"attempted": 60, "insert": 0, "update": 60, "skip": 0}
    moved = {r.spid for r in snapshots.read_changes(spark, root, PRICE_LATEST, 3).collect()}
    assert moved == set(batch)


def test_the_same_commit_by_two_writers_counts_once(spark, tmp_path, monkeypatch):
    root, real_create = str(tmp_path / "t"), snapshots.create_if_absent

    def overtaken(spark, path, text):
        monkeypatch.setattr(snapshots, "create_if_absent", real_create)
        put(spark, root, {1: 1}, "same", buckets=4)  # another bucket count, too
        return real_create(spark, path, text)

    monkeypatch.setattr(snapshots, "create_if_absent", overtaken)
    assert put(spark, root, {1: 1}, "same") == 1
    assert snapshots.commits(spark, root).count() == 1
    with pytest.raises(ValueError, match="other rows"):
        put(spark, root, {1: 2}, "same")


def test_first_commits_side_by_side(spark, tmp_path):
    root = str(tmp_path / "t")
    with ThreadPoolExecutor(3) as pool:
        jobs = [pool.submit(put, spark, root, {k: k for k in range(i, 60, 3)}, f"w{i}", 4 + i) for i in range(3)]
        assert sorted(j.result() for j in jobs) == [1, 2, 3]
    assert prices(spark, root) == {k: k for k in range(60)}


def test_keys_open_their_own_buckets(spark, tmp_path):
    root = str(tmp_path / "t")
    names_ = [c.strip().split(" ")[0] for c in PLAYERS.split(",")]
    players = spark.range(500).select(*[(F.col("id") if c in ("id", "spid") else F.lit(None)).alias(c) for c in names_])
    types = dict(t.strip().split(" ") for t in PLAYERS.split(","))
    players = players.select(*[F.col(c).cast(types[c]).alias(c) for c in names_]).withColumn("content_hash", F.lit("h"))
    store = str(tmp_path / "s")
    root = f"{store}/players"
    snapshots.commit(players, root, PLAYERS, ["spid"], lambda s, b, k: kept_tables.upsert(s, b, k, ["content_hash"]), 32)
    assert len(snapshots.manifest(spark, root)) == 32
    for asked in ([7], [7, 8, 9], list(range(0, 500, 40)), [10_000], []):
        keys = spark.createDataFrame([(k,) for k in asked], "spid bigint")
        want = {r.b for r in keys.select(snapshots.bucket_of(["spid"], 32).alias("b")).collect()}
        read = snapshots.read_for_keys(keys, root, PLAYERS, ["spid"])
        opened = {int(f.split("bucket=")[1].split("/")[0]) for f in read.inputFiles()}
        assert opened == want
        assert rows(kept_tables.known_cards(keys, store), "spid") == sorted(((k,) for k in asked if k < 500), key=str)


def test_change_feed(spark, tmp_path):
    root = str(tmp_path / "t")
    for given in ({1: 1, 2: 2}, {2: 3, 4: 4}, {1: 1}, {1: 9}):
        put(spark, root, given, buckets=2)
    feed = snapshots.read_feed(spark, root, PRICE_LATEST)
    assert rows(feed, "version", "spid", "price", "action") == [
        (1, 1, 1, "insert"), (1, 2, 2, "insert"), (2, 2, 3, "update"), (2, 4, 4, "insert"), (4, 1, 9, "update"),
    ]
    assert rows(snapshots.read_feed(spark, root, PRICE_LATEST, 2, 3), "version", "spid") == [(2, 2), (2, 4)]
    assert snapshots.read_feed(spark, str(tmp_path / "none"), PRICE_LATEST).count() == 0


def test_markers(spark, tmp_path):
    path = f"{tmp_path}/d/1.json"
    assert read_text(spark, path) is None and names(spark, f"{tmp_path}/d") == []
    assert create_if_absent(spark, path, "é one") and not create_if_absent(spark, path, "two")
    assert read_text(spark, path) == "é one" and names(spark, f"{tmp_path}/d") == ["1.json"] and numbered(spark, f"{tmp_path}/d") == [1]


def test_cards_streamed_in_slices(spark, pages, tmp_path):
    one, streamed = new_store(spark, tmp_path / "one"), new_store(spark, tmp_path / "streamed")
    kept_tables.run_kept_card_job(pages[1], one, "r1", FIRST, buckets=2)
    landed = str(tmp_path / "landed")
    for i in range(3):
        pages[1].filter(F.col("page_id") % 3 == i).coalesce(1).write.mode("append").parquet(landed)
    for offsets in ("a", "a", "b"):  # nothing new, then the whole stream again
        card_stream(ingest_pages(spark, landed, max_files=1), streamed, "r1", FIRST, str(tmp_path / offsets), buckets=2, name="cards").awaitTermination()
        assert numbered(spark, f"{streamed}/tx") == [1, 2, 3, 4]
    assert by_name(spark, one) == by_name(spark, streamed)
    totals = read_run_log(spark, f"{streamed}/log").agg(F.sum("new_players"), F.sum("failures")).first()
    assert tuple(totals) == tuple(read_run_log(spark, f"{one}/log").agg(F.sum("new_players"), F.sum("failures")).first())


def test_the_gate_keeps_a_done_catalogue_shut(spark, pages, tmp_path):
    store = str(tmp_path / "s")
    good = pages[1].filter("page_id IN (1, 2)")
    kept_tables.add_to_catalogue(catalogue(spark).filter("spid % 1000000000 IN (1, 2)"), store, "sync", buckets=2)
    landed = str(tmp_path / "landed")
    good.coalesce(1).write.parquet(landed)
    for offsets, name in (("a", "x"), ("b", "y")):
        card_stream(ingest_pages(spark, landed), store, "r1", FIRST, str(tmp_path / offsets), buckets=2, name=name).awaitTermination()
        assert not kept_tables.has_undone(spark, store)
    assert numbered(spark, f"{store}/tx") == [1, 2]


def test_catalogue_job_on_kept_tables(spark, tmp_path):
    store = str(tmp_path / "s")
    cards = spark.createDataFrame([(1, "a"), (2, "b")], "spid bigint, name string")
    seasons = spark.createDataFrame([(5, "five", None)], "season_id int, class_name string, season_img string")
    kept_tables.run_kept_catalogue_job(cards, seasons, store, "r1", FIRST, buckets=2)
    more = cards.filter("spid = 2").withColumn("name", F.lit("B")).unionByName(spark.createDataFrame([(3, "c")], cards.schema))
    later = seasons.unionByName(spark.createDataFrame([(6, "six", "u")], seasons.schema))
    for _ in range(2):
        kept_tables.run_kept_catalogue_job(more, later, store, "r2", SECOND, buckets=2)
    assert rows(kept_tables.read_kept(spark, store, "spid"), "spid", "name", "crawled") == [(1, "a", False), (2, "B", False), (3, "c", False)]
    assert rows(kept_tables.read_kept(spark, store, "seasons"), "season_id", "class_name") == [(5, "five"), (6, "six")]
    log = rows(read_run_log(spark, f"{store}/log"), "run_id", "phase", "new_players", "new_seasons", "new_spids")
    assert log == [
        ("r1", "sync", 2, '[{"season_id":5,"class_name":"five"}]', "[1,2]"), ("r2", "sync", 1, '[{"season_id":6,"class_name":"six"}]', "[3]"),
    ]


def test_card_versions_come_in_several_tasks(spark):
    """The part table is one split; the wide rows made of it, and what a commit keeps of them, are not."""
    from snapflow.queries.cards import card_versions

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for df in card_versions(spark, "/root/testdata/sf0.001"):
        assert tasks == df.select("spid").groupBy(F.spark_partition_id()).count().count()

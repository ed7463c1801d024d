import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapflow.operators.dims import get_or_create, new_members, resolve_ids
from snapflow.operators.latest import top_cards, top_per_group
from snapflow.operators.runlog import (
    append_log,
    crawl_log,
    logged_spids,
    run_totals,
    shard_counts,
    sync_counts,
    sync_log,
)
from snapflow.plans.price_job import commit_prices
from snapflow.operators.shard import limit_keys, ordinal, stride_shard, union_shards, with_shard
from snapflow.operators.upsert import upsert_catalogue, upsert_latest, upsert_seasons
from snapflow.plans.report import run_message, run_summary, top_changed, top_new
from snapflow.queries import streams
from snapflow.schemas import PAGES, PRICE_LATEST, RUN_LOG, SEASON, SPID
from snapflow.sources import snapshots
from snapflow.sources.readers import read_card_catalogue, read_run_log, read_season_catalogue, target_keys
from snapflow.streaming.ingest import ingest_pages, needs_run, upsert_stream

T = dt.datetime


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("n", [0, 1, 7, 100, 1003])
def test_ordinal_and_shards(spark, n):
    keys = spark.range(n).select((F.col("id") * 7919 % 10007).alias("spid"))
    want = sorted(i * 7919 % 10007 for i in range(n))
    assert rows(ordinal(keys, "spid"), "position", "spid") == list(enumerate(want))
    shards = [stride_shard(keys, "spid", i, 3) for i in range(3)]
    for i, shard in enumerate(shards):
        assert [r[0] for r in rows(shard, "spid")] == want[i::3]
    assert [r[0] for r in rows(union_shards(shards), "spid")] == want
    assert rows(with_shard(keys, "spid", 3), "shard", "spid") == sorted((i % 3, k) for i, k in enumerate(want))
    assert [r[0] for r in rows(limit_keys(keys, "spid", 5), "spid")] == want[:5]
    assert limit_keys(keys, "spid", 0).count() == stride_shard(keys, "spid", 0, 1).count() == n


def test_positions_of_a_hot_leading_column(spark):
    df = spark.range(500).select(F.lit("hot").alias("a"), (500 - F.col("id")).alias("b"))
    assert rows(ordinal(df, "a", "b"), "position", "b") == [(i, i + 1) for i in range(500)]


def test_get_or_create(spark):
    dim = spark.createDataFrame([(4, "a", "old"), (9, "b", "old")], "id int, name string, image_url string")
    met = spark.createDataFrame(
        [("a", "new", 1), ("d", "d2", 3), ("c", "c1", 2), ("d", "d1", 2), ("c", "c2", 5)],
        "name string, image_url string, at int",
    )
    grown = get_or_create(dim, met, ["image_url"], ["at"])
    assert rows(grown, "id", "name", "image_url") == [(4, "a", "old"), (9, "b", "old"), (10, "c", "c1"), (11, "d", "d1")]
    assert rows(get_or_create(grown, met, ["image_url"], ["at"]), *grown.columns) == rows(grown, *grown.columns)


def test_resolve_keeps_order_and_empty_lists(spark):
    cards = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None)], "spid int, names array<string>")
    members = spark.createDataFrame([("t", "a", 1), ("t", "b", 2), ("u", "a", 99)], "dim string, name string, id int")
    got = resolve_ids(cards, "spid", {"ids": ("names", "t")}, members)
    assert rows(got, "spid", "ids") == [(1, [2, 1, 2]), (2, []), (3, [])]


def test_new_members(spark):
    used = spark.createDataFrame([(1, "x", 1), (2, "y", 1), (2, "z", 2)], "id int, name string, at int")
    known = spark.createDataFrame([(1,)], "id int")
    assert rows(new_members(used, known, ["at"]), "id", "name") == [(2, "z")]


def test_top_lists(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9), (4, 9)], "spid int, main_ovr int")
    assert [r.spid for r in top_cards(df, 3).collect()] == [3, 4, 1]
    assert top_cards(df, 0).count() == 0
    many = spark.range(5000).select(F.lit("g").alias("g"), "id")
    best = top_per_group(many, ["g"], [F.desc("id")], 2000, tie="id")
    assert rows(best, "rank", "id") == [(i + 1, 4999 - i) for i in range(2000)]
    assert top_per_group(many, ["g"], [F.desc("id")], 0, tie="id").count() == 0


def log(spark, *given):
    names = [c.strip().split(" ")[0] for c in RUN_LOG.split(",")]
    return spark.createDataFrame([tuple(g.get(n) for n in names) for g in given], RUN_LOG)


AT = T(2024, 1, 5, 10)
CARDS = "spid bigint, name string, season_id int, main_ovr int, created_at timestamp_ntz, updated_at timestamp_ntz"


def report_inputs(spark):
    crawl = {"run_id": "run-123456", "phase": "crawl", "created_at": T(2024, 1, 5, 11)}
    rows_ = [
        {"run_id": "run-123456", "phase": "sync", "new_players": 3, "created_at": AT,
         "new_seasons": '[{"season_id":1,"class_name":"SH (Step Higher)"},{"season_id":2}]', "new_spids": "[1,2,8]"},
        {**crawl, "shard": 0, "new_players": 2, "changed": 1, "failures": 0,
         "new_traits": '[{"id":5,"name":"first"},{"id":6,"name":"six"}]'},
        {**crawl, "shard": 2, "new_players": None, "changed": 1, "failures": 3,
         "new_traits": '[{"id":5,"name":"again"}]'},
        {**crawl, "run_id": "quiet", **{c: 0 for c in ("shard", "new_players", "changed", "failures")}, "new_traits": "[]",
         "created_at": T(2024, 1, 6)},
    ]
    old = T(2024, 1, 1)
    cards = spark.createDataFrame([
        (1, "One", 1, 90, AT, AT), (2, "Two", 7, 95, AT, AT), (3, "Three", 1, 80, old, T(2024, 1, 5, 12)),
        (4, "Four", 1, 99, old, old), (5, "Five", None, None, old, T(2024, 1, 5, 10)),
    ], CARDS)
    seasons = spark.createDataFrame([(1, "SH (Step Higher)", None)], SEASON)
    return log(spark, *rows_), cards, seasons


def test_report(spark):
    run_log, cards, seasons = report_inputs(spark)
    summary = run_summary(run_log, cards, seasons, ["created_at", "shard"], expected=1, top_n=2)
    text = {r.run_id: r.message for r in run_message(summary, title="T").collect()}
    assert text["run-123456"].split("\n") == [
        "[T 메타 크롤 #123456]",
        "🔴 크롤 실패 3건",
        "🟢 신규선수 2  🔵 변동 2장",
        "🟡 신규특성 2  🟣 신규시즌 2",
        "• 특성: again, six",
        "• 시즌: SH (Step Higher), ?",
        "• 신규: Two, SH One 외 1명",
        "• 변동: SH Three, Five",
    ]
    assert text["quiet"].split("\n") == ["[T 메타 크롤 #quiet]", "🟢 신규선수 0  🔵 변동 0장", "🟡 신규특성 0  🟣 신규시즌 0", "변동 없음 (정상 동작)"]
    one = {r.run_id: r for r in summary.collect()}["run-123456"]
    assert (one.missing_shards, one.shards_logged, one.new_spid_count) == (-1, 2, 3)
    four = run_message(run_summary(run_log, cards, seasons, ["created_at", "shard"]), max_len=60)
    short = {r.run_id: r.message for r in four.collect()}["run-123456"]
    assert len(short) == 60 and short.endswith("…") and "샤드 누락 2/4" in short


def test_previews_of_one_run(spark):
    run_log, cards, seasons = report_inputs(spark)
    one = run_log.filter("run_id = 'run-123456'")
    assert sorted(r.label for r in top_new(cards, seasons, logged_spids(one), 1).collect()) == ["Two"]
    assert {r.label for r in top_changed(cards, seasons, one, 5).collect()} == {"SH Three", "Five"}
    assert top_changed(cards, seasons, one.withColumn("changed", F.lit(0)), 5).count() == 0
    assert top_changed(cards, seasons, one, 0).count() == 0
    assert top_changed(cards, seasons, one.filter("false"), 5).count() == 0


def test_sync_and_crawl_log(spark, tmp_path):
    state = spark.createDataFrame([(1, "a", True, None)], SPID)
    batch = spark.range(1, 26).select(F.col("id").alias("spid"), F.lit("a").alias("name"))
    catalogue = upsert_catalogue(state, batch)
    seasons = upsert_seasons(
        spark.createDataFrame([(1, "x", None)], SEASON), spark.createDataFrame([(1, "y", None), (2, "z", None)], SEASON)
    )
    assert sync_counts(catalogue, seasons).first().asDict() == {"new_spids": 24, "new_seasons": 1}
    one = sync_log(catalogue, seasons, "r", AT)
    row = one.collect()
    assert len(row) == 1 and row[0].new_players == 24
    assert row[0].new_seasons == '[{"season_id":2,"class_name":"z"}]'
    split = sync_log(catalogue, seasons, "r", AT, items=6)
    assert split.count() == 4
    assert rows(logged_spids(split), "spid") == rows(logged_spids(one), "spid") == [(i,) for i in range(2, 26)]

    quiet = sync_log(catalogue.filter("false"), seasons.filter("false"), "q", AT).collect()
    assert [(r.new_players, r.new_spids, r.new_seasons) for r in quiet] == [(0, "[]", "[]")]

    merged = spark.createDataFrame([(0, "insert"), (0, "skip"), (1, "update")], "shard int, action string")
    rejects = spark.createDataFrame([(1,), (1,)], "shard int")
    traits = spark.createDataFrame([(1, 5, "t")], "shard int, id int, name string")
    shard_rows = crawl_log(shard_counts(merged, rejects), traits, "r", AT, shards=3)
    path = str(tmp_path / "log")
    append_log(one, path)
    append_log(shard_rows, path)
    append_log(sync_log(catalogue, seasons, "other", AT), path)
    logged = read_run_log(spark, path, "r")
    assert "PartitionFilters: [isnotnull(run_id" in logged._jdf.queryExecution().toString()
    assert rows(logged.filter("phase = 'crawl'"), "shard", "new_players", "changed", "failures", "new_traits") == [
        (0, 1, 0, 0, "[]"), (1, 0, 1, 2, '[{"id":5,"name":"t"}]'), (2, 0, 0, 0, "[]"),
    ]
    totals = run_totals(logged, 4).first()
    assert (totals.new_players, totals.changed, totals.failures, totals.missing_shards) == (1, 1, 2, 1)


def test_catalogue_files(spark, tmp_path):
    cards, seasons = tmp_path / "spid.json", tmp_path / "season.json"
    cards.write_text('[{"id": 1,\n "name": "가"}, {"id": 2, "name": null}]', encoding="utf-8")
    seasons.write_text('[{"seasonId": 5, "className": "S (x)", "seasonImg": "u"}]')
    assert rows(read_card_catalogue(spark, str(cards)), "spid", "name") == [(1, "가"), (2, None)]
    assert rows(read_season_catalogue(spark, str(seasons)), "season_id", "class_name", "season_img") == [(5, "S (x)", "u")]


def test_only_new_gate(spark):
    done = spark.createDataFrame([(1, "a", True, None)], SPID)
    same = spark.createDataFrame([(1, "a")], "spid bigint, name string")
    more = spark.createDataFrame([(2, "b")], "spid bigint, name string")
    assert not needs_run(upsert_catalogue(done, same), done)
    gained = upsert_catalogue(done, more)
    assert needs_run(gained, done)
    after = gained.drop("action")
    assert needs_run(upsert_catalogue(after, same), after)  # still undone
    assert rows(target_keys(after, only_new=True), "spid") == [(2,)]
    assert target_keys(after).count() == 2


BATCH = "spid bigint, strong smallint, price bigint, price_date date"


def merge(now):
    return lambda state, batch, keys: upsert_latest(state, batch, now, keys)


def test_commit_rewrites_only_touched_buckets(spark, tmp_path):
    root, keys = str(tmp_path / "t"), ["spid", "strong"]
    first = spark.range(200).selectExpr("id AS spid", "1S AS strong", "id AS price", "CAST(NULL AS date) AS price_date")
    assert snapshots.commit(first, root, PRICE_LATEST, keys, merge(T(2024, 1, 1)), buckets=16) == 1
    assert len({p.bucket for p in snapshots.manifest(spark, root)}) == 16
    one = spark.createDataFrame([(7, 1, 70, None)], BATCH)
    assert snapshots.commit(one, root, PRICE_LATEST, keys, merge(T(2024, 1, 2))) == 2
    moved = [p for p in snapshots.manifest(spark, root) if p.data_version == 2]
    assert len(moved) == 1 and len(snapshots.manifest(spark, root)) == 16
    state = {r.spid: r.price for r in snapshots.read_snapshot(spark, root, PRICE_LATEST).collect()}
    assert state == {**{i: i for i in range(200)}, 7: 70}
    assert [r.spid for r in snapshots.read_changes(spark, root, PRICE_LATEST, 2).collect()] == [7]
    counts = snapshots.commit_counts(spark, root, 2).first().asDict()
    assert counts == {"attempted": 1, "insert": 0, "update": 1, "skip": 0}
    assert snapshots.commit(one.filter("false"), root, PRICE_LATEST, keys, merge(T(2024, 1, 3))) == 2
    assert snapshots.read_snapshot(spark, str(tmp_path / "none"), PRICE_LATEST).count() == 0


def test_commit_ids(spark, tmp_path):
    root, keys = str(tmp_path / "t"), ["spid", "strong"]

    def put(price, commit_id, day):
        rows_of = spark.createDataFrame([(1, 1, price, None), (2, 1, 5, None)], BATCH)
        return snapshots.commit(rows_of, root, PRICE_LATEST, keys, merge(T(2024, 1, day)), 4, commit_id, ("strong",), ("price",))

    assert [put(10, "a", 1), put(20, "b", 2), put(10, "a", 3), put(20, "c", 4)] == [1, 2, 2, 3]
    assert rows(snapshots.read_snapshot(spark, root, PRICE_LATEST), "spid", "price") == [(1, 20), (2, 5)]
    assert rows(snapshots.read_snapshot(spark, root, PRICE_LATEST, 1), "spid", "price") == [(1, 10), (2, 5)]
    # what changes nothing adds no data, and one changed row rewrites its bucket only
    assert {p.data_version for p in snapshots.manifest(spark, root)} <= {1, 2}
    with pytest.raises(ValueError, match="other rows"):
        put(30, "b", 5)
    assert snapshots.commit_counts(spark, root, 3).first().asDict() == {"attempted": 2, "insert": 0, "update": 0, "skip": 2}


def test_search_reads_the_kept_layout(spark, tmp_path):
    root = str(tmp_path / "t")
    prices = spark.range(300).selectExpr("id AS spid", "CAST(id % 13 + 1 AS smallint) AS strong", "id * 10 AS price", "CAST(NULL AS date) AS price_date")
    commit_prices(prices, root, T(2024, 1, 1), "r/0", buckets=2)
    found = snapshots.search(snapshots.read_snapshot(spark, root, PRICE_LATEST), 3, 100, 1000)
    assert rows(found, "spid") == [(i,) for i in range(300) if i % 13 == 2 and 100 <= i * 10 <= 1000]
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(strong" in plan and "GreaterThanOrEqual(price,100)" in plan


def test_commit_leaves_the_session_settings_alone(spark, tmp_path):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key, None)
    one = spark.createDataFrame([(7, 1, 70, None)], BATCH)
    snapshots.commit(one, str(tmp_path / "t"), PRICE_LATEST, ["spid", "strong"], merge(T(2024, 1, 2)))
    assert spark.conf.get(key, None) == before


def test_search_opens_the_files_that_can_meet_it(spark, tmp_path):
    root = str(tmp_path / "t")
    prices = spark.range(400).selectExpr("id AS spid", "CAST(id % 13 + 1 AS smallint) AS strong", "id * 10 AS price", "CAST(NULL AS date) AS price_date")
    commit_prices(prices, root, T(2024, 1, 1), "r/0", buckets=4)
    commit_prices(prices.filter("spid < 30").withColumn("price", F.lit(9_000)), root, T(2024, 1, 2), "r/1", buckets=4)
    live = {p.folder for p in snapshots.manifest(spark, root)}
    whole = spark.read.option("basePath", f"{root}/data").parquet(*[f"{root}/data/w={w}" for w in live])
    for lo, hi in ((100, 400), (0, 5_000), (9_000, 9_000), (3_990, 8_999), (20_000, 30_000)):
        opened = snapshots.files_between(spark, root, lo, hi, strong=3)
        ranges = whole.filter("strong = 3").groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min("price").alias("a"), F.max("price").alias("b"))
        current = {r.file for r in snapshots.zones(spark, root).collect()}
        assert opened == sorted(r.f for r in ranges.collect() if r.a <= hi and r.b >= lo and r.f in current)
        found = snapshots.search_snapshot(spark, root, PRICE_LATEST, 3, lo, hi)
        assert rows(found, "spid", "price") == rows(snapshots.search(snapshots.read_snapshot(spark, root, PRICE_LATEST), 3, lo, hi), "spid", "price")
        assert sorted(f.replace("file:///", "file:/") for f in found.inputFiles()) == opened
    assert snapshots.search_snapshot(spark, str(tmp_path / "none"), PRICE_LATEST, 3, 0, 1).count() == 0


def test_stream_in_bounded_batches(spark, tmp_path):
    landed, root, offsets = (str(tmp_path / d) for d in ("landed", "state", "offsets"))
    for i in range(3):
        spark.createDataFrame([(i, 1, 10 * i, None), (9, 1, i, None)], BATCH).coalesce(1).write.mode("append").parquet(landed)

    def run():
        query = upsert_stream(
            ingest_pages(spark, landed, max_files=1, schema=BATCH), root, PRICE_LATEST, ["spid", "strong"],
            lambda b: b, merge(T(2024, 1, 1)), offsets, buckets=4,
        )
        query.awaitTermination()
        state = snapshots.read_snapshot(spark, root, PRICE_LATEST)
        return snapshots.manifest(spark, root)[0].v, rows(state, "spid", "price")

    version, state = run()
    assert version == 3 and state == [(0, 0), (1, 10), (2, 20), (9, 2)]
    assert run() == (version, state)  # nothing new landed
    spark.createDataFrame([(5, 1, 5, None)], BATCH).write.mode("append").parquet(landed)
    assert run() == (4, [(0, 0), (1, 10), (2, 20), (5, 5), (9, 2)])


def test_pages_stream_schema(spark, tmp_path):
    spark.createDataFrame([(1, "u", "h")], PAGES).write.parquet(str(tmp_path / "p"))
    assert ingest_pages(spark, str(tmp_path / "p")).isStreaming


def test_streamed_pages_are_parsed_by_all_tasks(spark, monkeypatch):
    seen, parse = [], streams.price_batch

    def noted(pages, as_of):
        seen.append(pages.select(F.spark_partition_id()).distinct().count())
        return parse(pages, as_of)

    monkeypatch.setattr(streams, "price_batch", noted)
    assert streams.stream_price_pages(spark, "/root/testdata/sf0.001").count() > 0
    assert seen == [4, 4, 4]  # one landed file each, one row group

"""Catalogue queries: customers and parts as id catalogues, orders as processed keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.functions.scalars import batch_time, utc_text
from snapflow.operators.runlog import logged_spids, sync_counts, sync_log
from snapflow.operators.shard import (
    limit_keys,
    ordered_keys,
    ordinal,
    stride_shard,
    task_grid,
    union_shards,
    with_shard,
)
from snapflow.operators.upsert import ACTION, changes, mark_done, upsert_catalogue, upsert_seasons
from snapflow.plans.catalogue_job import card_targets, leading, run_catalogue_job
from snapflow.plans.price_job import work_list
from snapflow.queries.registry import query, table
from snapflow.session import work_dir
from snapflow.streaming.ingest import pending_work
from snapflow.sources.readers import (
    card_keys,
    read_card_catalogue,
    read_season_catalogue,
    target_keys,
)

BEFORE, NOW = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8)


def _customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("spid"), F.col("c_name").alias("name"))


def _catalogue(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    batch, key = _customers(spark, sf_dir), F.col("spid")
    state = batch.filter(key % 10 != 9).select(
        "spid",
        F.when(key % 7 == 0, F.lower("name")).when(key % 31 == 0, F.lit(None)).otherwise(F.col("name")).alias("name"),
        (key % 2 == 0).alias("crawled"),
        F.when(key % 2 == 0, batch_time(BEFORE)).alias("crawled_at"),
    )
    return state, batch


CATALOGUE_SQL = """
WITH m AS (
  SELECT c_custkey AS spid, c_name AS name, c_custkey % 2 = 0 AS old_crawled,
         CASE WHEN c_custkey % 10 = 9 THEN 'insert'
              WHEN c_custkey % 7 = 0 OR c_custkey % 31 = 0 THEN 'update' ELSE 'skip' END AS action
  FROM customer)
"""


@query(f"""{CATALOGUE_SQL}
SELECT spid, name, CASE WHEN action = 'insert' THEN 0 ELSE CAST(old_crawled AS INTEGER) END AS crawled, action FROM m
""")
def catalogue_upsert(spark, sf_dir):
    """New keys start undone; a rename keeps the done flag."""
    merged = upsert_catalogue(*_catalogue(spark, sf_dir))
    return merged.select("spid", "name", F.col("crawled").cast("int").alias("crawled"), ACTION)


@query(f"{CATALOGUE_SQL} SELECT spid, action = 'insert' AS inserted FROM m WHERE action <> 'skip'")
def catalogue_written(spark, sf_dir):
    """Written rows only, flagged inserted or updated."""
    written = changes(upsert_catalogue(*_catalogue(spark, sf_dir)))
    return written.select("spid", (F.col(ACTION) == "insert").alias("inserted"))


def _season_versions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    batch = part.select(
        key.cast("int").alias("season_id"),
        F.concat("p_type", F.when(key % 13 == 0, " X").otherwise("")).alias("class_name"),
        F.concat(F.lit("/s/"), F.col("p_size") + F.when(key % 7 == 0, 3).otherwise(0), F.lit(".png")).alias("season_img"),
    )
    state = part.filter(key % 10 != 9).select(
        key.cast("int").alias("season_id"),
        F.col("p_type").alias("class_name"),
        F.when(key % 17 != 0, F.concat(F.lit("/s/"), "p_size", F.lit(".png"))).alias("season_img"),
    )
    return state, batch


SEASONS_SQL = """
WITH m AS (
  SELECT p_partkey AS season_id, p_type || CASE WHEN p_partkey % 13 = 0 THEN ' X' ELSE '' END AS class_name,
         '/s/' || (p_size + CASE WHEN p_partkey % 7 = 0 THEN 3 ELSE 0 END) || '.png' AS season_img,
         CASE WHEN p_partkey % 10 = 9 THEN 'insert'
              WHEN p_partkey % 13 = 0 OR p_partkey % 7 = 0 OR p_partkey % 17 = 0 THEN 'update' ELSE 'skip' END AS action
  FROM part)
"""


@query(f"{SEASONS_SQL} SELECT season_id, class_name, season_img, action FROM m")
def season_upsert(spark, sf_dir):
    """Guarded on two columns: either difference updates, a null differs from a value."""
    return upsert_seasons(*_season_versions(spark, sf_dir))


@query(f"""{CATALOGUE_SQL}
SELECT count(*) FILTER (WHERE action = 'insert') AS gained,
       count(*) FILTER (WHERE action = 'insert' OR NOT old_crawled) AS undone FROM m
""")
def card_stage_gate(spark, sf_dir):
    """What the card stage would have to do after a catalogue run."""
    merged = upsert_catalogue(*_catalogue(spark, sf_dir))
    return pending_work(merged, merged.drop(ACTION))


@query("""
SELECT (SELECT count(*) FROM customer WHERE c_custkey % 10 = 9) AS new_spids,
       (SELECT count(*) FROM part WHERE p_partkey % 10 = 9) AS new_seasons
""")
def catalogue_run_counts(spark, sf_dir):
    return sync_counts(
        upsert_catalogue(*_catalogue(spark, sf_dir)), upsert_seasons(*_season_versions(spark, sf_dir))
    )


@query("""
WITH m AS (
  SELECT c_custkey AS spid, c_custkey % 10 = 9 AS inserted, c_custkey % 2 = 0 AS done FROM customer)
SELECT spid FROM m WHERE inserted OR NOT done ORDER BY spid LIMIT 200
""")
def cards_to_run(spark, sf_dir):
    """Catalogue job, then the leading undone keys as targets of the card job."""
    state, batch = _catalogue(spark, sf_dir)
    seasons, season_batch = _season_versions(spark, sf_dir)
    run = run_catalogue_job(batch, season_batch, state, seasons, "20240108", NOW)
    return card_targets(run.spid, only_new=True, limit=200)


@query("SELECT '20240108' AS run_id, c_custkey AS spid FROM customer WHERE c_custkey % 10 = 9")
def catalogue_run_log(spark, sf_dir):
    """New keys logged as JSON lists of bounded size and read back."""
    log = sync_log(
        upsert_catalogue(*_catalogue(spark, sf_dir)), upsert_seasons(*_season_versions(spark, sf_dir)),
        "20240108", NOW, items=50,
    )
    return logged_spids(log)


@query("SELECT c_custkey AS spid, c_name AS name FROM customer")
def card_catalogue_json(spark, sf_dir):
    """Catalogue written and read as JSON lines."""
    path = work_dir(spark, "catalogue")
    _customers(spark, sf_dir).withColumnRenamed("spid", "id").write.json(path)
    return read_card_catalogue(spark, path, lines=True).drop("place")


@query("""
SELECT n_nationkey AS season_id, n_name || ' (Nation ' || n_nationkey || ')' AS class_name,
       CASE WHEN n_nationkey % 5 <> 0 THEN '/s/' || n_regionkey || '.png' END AS season_img FROM nation
""")
def season_catalogue_json(spark, sf_dir):
    path = work_dir(spark, "seasons")
    key = F.col("n_nationkey")
    table(spark, sf_dir, "nation").select(
        key.alias("seasonId"),
        F.concat("n_name", F.lit(" (Nation "), key, F.lit(")")).alias("className"),
        F.when(key % 5 != 0, F.concat(F.lit("/s/"), "n_regionkey", F.lit(".png"))).alias("seasonImg"),
    ).write.json(path)
    return read_season_catalogue(spark, path, lines=True).drop("place")


def _array_file(rows: DataFrame, path: str) -> None:
    """One file with one JSON array, the form the catalogues are published in."""
    rows.agg(F.to_json(F.collect_list(F.struct("*")))).coalesce(1).write.text(path)


@query("SELECT s_suppkey AS spid, s_name AS name FROM supplier")
def card_catalogue_array(spark, sf_dir):
    path = work_dir(spark, "catalogue")
    _array_file(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), path)
    return read_card_catalogue(spark, path).drop("place")


@query("SELECT n_nationkey AS season_id, n_name AS class_name, '/s/' || n_regionkey AS season_img FROM nation")
def season_catalogue_array(spark, sf_dir):
    path = work_dir(spark, "seasons")
    nation = table(spark, sf_dir, "nation")
    _array_file(nation.select(F.col("n_nationkey").alias("seasonId"), F.col("n_name").alias("className"), F.concat(F.lit("/s/"), "n_regionkey").alias("seasonImg")), path)
    return read_season_catalogue(spark, path).drop("place")


@query("SELECT c_custkey AS spid, c_name AS name FROM customer ORDER BY c_custkey LIMIT 90")
def leading_catalogue(spark, sf_dir):
    """First entries in the order of several JSON-lines files."""
    path = work_dir(spark, "catalogue")
    rows = _customers(spark, sf_dir).withColumnRenamed("spid", "id")
    rows.repartitionByRange(3, "id").sortWithinPartitions("id").write.json(path)
    return leading(read_card_catalogue(spark, path, lines=True), 90).select("spid", "name")


@query(f"""{CATALOGUE_SQL}
SELECT spid, name, CASE WHEN action = 'insert' THEN 0 ELSE CAST(old_crawled AS INTEGER) END AS crawled, action FROM m
""")
def catalogue_entries_twice(spark, sf_dir):
    """A catalogue with two entries of every key: the last one counts, and once."""
    state, batch = _catalogue(spark, sf_dir)
    _, season_batch = _season_versions(spark, sf_dir)
    first = batch.withColumn("name", F.concat(F.lit("earlier "), "name")).withColumn("place", F.struct(F.lit(0).alias("n"), "spid"))
    entries = first.unionByName(batch.withColumn("place", F.struct(F.lit(1).alias("n"), "spid")))
    run = run_catalogue_job(entries, season_batch, state, season_batch.limit(0), "20240108", NOW)
    return run.spid.select("spid", "name", F.col("crawled").cast("int").alias("crawled"), ACTION)


@query("""
WITH season AS (
  SELECT CAST(p_partkey AS INTEGER) AS season_id, p_type || CASE WHEN p_partkey % 13 = 0 THEN ' X' ELSE '' END AS class_name,
         (row_number() OVER (ORDER BY p_partkey DESC) - 1) // 10000 AS seq FROM part WHERE p_partkey % 10 = 9),
lists AS (
  SELECT seq, to_json(list({'season_id': season_id, 'class_name': class_name} ORDER BY season_id DESC)) AS new_seasons
  FROM season GROUP BY seq),
size AS (SELECT greatest((SELECT count(*) FROM season), (SELECT count(*) FROM customer WHERE c_custkey % 10 = 9)) AS n)
SELECT CAST(r.seq AS INTEGER) AS seq, coalesce(CAST(new_seasons AS VARCHAR), '[]') AS new_seasons
FROM (SELECT unnest(range(greatest(1, (n + 9999) // 10000))) AS seq FROM size) r LEFT JOIN lists USING (seq)
""")
def logged_seasons_in_order(spark, sf_dir):
    """New seasons are logged in the order of their source, here by falling key, 10,000 to a numbered row."""
    state, batch = _season_versions(spark, sf_dir)
    spid_state, spid_batch = _catalogue(spark, sf_dir)
    entries = batch.withColumn("place", -F.col("season_id"))
    run = run_catalogue_job(spid_batch, entries, spid_state, state, "20240108", NOW)
    return run.log.select(F.col("seq").cast("int").alias("seq"), "new_seasons")


DONE_SQL = """
WITH m AS (
  SELECT c_custkey AS spid, c_custkey % 2 = 0 AS was_done,
         c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS hit FROM customer)
"""


def _marked(spark, sf_dir) -> DataFrame:
    key = F.col("spid")
    state = _customers(spark, sf_dir).select(
        "spid", "name", (key % 2 == 0).alias("crawled"),
        F.when(key % 2 == 0, batch_time(BEFORE)).alias("crawled_at"),
    )
    ok = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return mark_done(state, ok.select(F.col("o_custkey").alias("spid")), NOW)


@query(f"""{DONE_SQL}
SELECT spid, CAST(was_done OR hit AS INTEGER) AS crawled,
       CASE WHEN hit THEN '2024-01-08' WHEN was_done THEN '2024-01-01' END AS crawled_on FROM m
""")
def mark_processed(spark, sf_dir):
    return _marked(spark, sf_dir).select(
        "spid", F.col("crawled").cast("int").alias("crawled"),
        utc_text(F.col("crawled_at")).alias("crawled_on"),
    )


@query(f"{DONE_SQL} SELECT spid FROM m WHERE NOT was_done AND NOT hit")
def undone_keys(spark, sf_dir):
    return target_keys(_marked(spark, sf_dir), only_new=True)


@query("SELECT DISTINCT o_custkey AS spid FROM orders")
def distinct_card_keys(spark, sf_dir):
    return ordered_keys(table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "spid"), "spid")


@query("""
SELECT c_custkey AS spid, unnest(range(1, 14)) AS strong FROM customer
""")
def pair_grid(spark, sf_dir):
    """Every key with every grade."""
    keys = card_keys(_customers(spark, sf_dir))
    return task_grid(keys, list(range(1, 14))).withColumn("strong", F.col("strong").cast("bigint"))


@query("""
WITH k AS (SELECT o_custkey AS spid, row_number() OVER (ORDER BY o_custkey) - 1 AS pos
           FROM (SELECT DISTINCT o_custkey FROM orders))
SELECT spid, strong FROM k, (VALUES (1), (5), (8)) g(strong) WHERE pos < 900 AND pos % 6 = 2
""")
def shard_work_list(spark, sf_dir):
    """Keys limited first, then sharded, then crossed with the grades."""
    players = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "spid")
    return work_list(players, [1, 5, 8], limit=900, index=2, count=6).withColumn(
        "strong", F.col("strong").cast("int")
    )


@query("SELECT c_custkey AS spid, row_number() OVER (ORDER BY c_custkey) - 1 AS position FROM customer")
def key_positions(spark, sf_dir):
    """Position of every key in total order."""
    return ordinal(_customers(spark, sf_dir).select("spid"), "spid")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate_text, l_extendedprice, n,
       row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate_text, l_extendedprice) - 1 AS position
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate_text,
             l_extendedprice, count(*) AS n
      FROM lineitem GROUP BY ALL)
""")
def line_positions(spark, sf_dir):
    """Positions in the order of several columns."""
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate_text", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").withColumn("l_shipdate_text", F.col("l_shipdate").cast("date").cast("string"))
    return ordinal(lines.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")), *cols)


@query("""
SELECT spid FROM (SELECT c_custkey AS spid, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM customer)
WHERE pos % 6 = 2
""")
def stride_shard_keys(spark, sf_dir):
    return stride_shard(_customers(spark, sf_dir).select("spid"), "spid", 2, 6)


@query("""
SELECT CAST((row_number() OVER (ORDER BY c_custkey) - 1) % 4 AS INTEGER) AS shard, c_custkey AS spid FROM customer
""")
def shard_of_key(spark, sf_dir):
    return with_shard(_customers(spark, sf_dir).select("spid"), "spid", 4)


@query("SELECT count(*) AS keys, count(DISTINCT c_custkey) AS distinct_keys, 0 AS missing FROM customer")
def shards_cover(spark, sf_dir):
    """The shards are disjoint and together hold every key."""
    keys = _customers(spark, sf_dir).select("spid")
    together = union_shards([stride_shard(keys, "spid", i, 3) for i in range(3)])
    missing = keys.join(together, "spid", "left_anti").agg(F.count(F.lit(1))).scalar()
    return together.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_distinct("spid").alias("distinct_keys"),
    ).withColumn("missing", missing.cast("int"))


@query("SELECT spid FROM (SELECT DISTINCT o_custkey AS spid FROM orders) ORDER BY spid LIMIT 120")
def first_keys(spark, sf_dir):
    """Leading keys in key order."""
    players = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "spid")
    return limit_keys(card_keys(players), "spid", 120)

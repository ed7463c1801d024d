"""Card queries: pages built from part rows, parsed back and applied to a card table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.functions.hashing import content_hash, content_json
from snapflow.functions.scalars import batch_time
from snapflow.operators.extract import extract_cards, split_valid
from snapflow.operators.latest import previous
from snapflow.operators.runlog import shard_counts
from snapflow.operators.shard import with_shard
from snapflow.operators.upsert import ACTION, apply_card_changes, classify, upsert
from snapflow.plans.card_job import TRAIT, as_members, commit_cards, dimension, member_candidates, run_card_job
from snapflow.plans.kept_tables import (
    add_to_catalogue,
    card_transaction,
    known_cards as known_kept_cards,
    read_kept,
    run_kept_card_job,
    run_kept_catalogue_job,
)
from snapflow.plans.report import run_summary
from snapflow.queries.registry import query, spread, table
from snapflow.schemas import NATIONS, PLAYERS, STAT_COLUMNS, TEAM_COLORS, TRAITS
from snapflow.session import work_dir
from snapflow.sources import snapshots
from snapflow.sources.readers import existing_state, read_run_log

CREATED, NOW = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8)

# What a page built from a part must parse to; `error` is the first defect met.
CARDS_SQL = """
cards AS (
  SELECT p_partkey AS page_id, (100 + p_partkey % 50) * 1000000000 + p_partkey AS spid,
    100 + p_partkey % 50 AS season_id,
    p_name || ' & co' AS name,
    upper(p_brand) AS main_position, 40 + p_size AS main_ovr,
    CASE WHEN p_partkey % 3 = 0 THEN 'CM,' || p_type WHEN p_partkey % 3 = 1 THEN p_type ELSE '' END AS sub_positions,
    CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size % 30 END AS pay,
    150 + p_size AS height, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 50 + p_size END AS weight,
    lower(p_type) || ' (' || p_size || ')' AS body_type,
    1 + p_partkey % 5 AS skill_moves,
    CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN 'L' ELSE 'R' END AS preferred_foot,
    CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE 1 + p_partkey % 5 END AS weak_foot,
    CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE split_part(p_name, ' ', 2) || ' land' END AS nation_name,
    '/n/' || p_size % 10 || '.png?a=1&b=2' AS nation_image,
    split_part(p_name, ' ', 1) || '|' || split_part(p_name, ' ', 2) AS traits,
    p_type || 'FC/club' || CASE WHEN p_partkey % 4 = 0 THEN '|' || p_brand || ' duo/relation' ELSE '' END AS team_colors,
    CASE WHEN p_partkey % 9 = 0 THEN 99 ELSE p_size END AS pace,
    p_size + 5 AS shot_power, p_size + 7 AS gk_reflexes,
    CASE WHEN p_partkey % 17 = 0 THEN 'name not found' WHEN p_partkey % 23 = 0 THEN 'bad rating'
         WHEN p_partkey % 19 = 0 THEN 'positions not found' WHEN p_partkey % 29 = 0 THEN 'bad height'
         WHEN p_partkey % 31 = 0 THEN 'image without src' END AS error
  FROM part)"""


def _text(*parts: str | Column) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def card_pages(spark, sf_dir, size: Column | None = None) -> DataFrame:
    """One card page per part, some defective; ``size`` replaces the part size."""
    key, size = F.col("p_partkey"), F.col("p_size") if size is None else size
    word = F.split("p_name", " ")
    first, second = F.get(word, F.lit(0)), F.get(word, F.lit(1))

    def unless(n: int, c: Column) -> Column:
        return F.when(key % n == 0, "").otherwise(c)

    def position(txt: Column, value: Column) -> Column:
        return _text(
            '<span class="position x"><b class="txt"> ', txt, '\n</b><i class="value">', value, "</i></span>"
        )

    def stat(label: str, value: Column | str) -> Column:
        return _text(
            '<li class="ab"><div class="txt">', label, '</div><div class="value">', value, "<em>+</em></div></li>"
        )

    main_value = F.when(key % 23 == 0, "n/a").otherwise((size + 40).cast("string"))
    main = F.when((key % 19 == 0) & (key % 23 != 0), "").otherwise(position(F.upper("p_brand"), main_value))
    # a later position would take the place of a missing first one
    subs = (
        F.when(key % 19 == 0, "")
        .when(key % 3 == 0, F.concat(position(F.lit("CM"), size), position(F.col("p_type"), size)))
        .when(key % 3 == 1, position(F.col("p_type"), size))
        .otherwise("")
    )
    rating = (key % 5 + 1).cast("string")
    foot = (
        F.when(key % 6 == 0, _text("L5 – R", rating))
        .when(key % 2 == 0, _text("<strong>L 5</strong> – R", rating))
        .otherwise(_text("L", rating, " – <strong> R5</strong>"))
    )
    trait_image = F.when(key % 31 == 0, "<img alt='x'>").otherwise('<img src="/t/1.png">')
    traits = _text(
        "<span>", trait_image, '<em class="desc"> ', first, "</em></span>",
        '<span><img src="/t/2.png"></span><div><span><img src="/t/3.png"><em class="desc">deep</em></span></div>',
        '<span><img src="/t/4.png"/><em class="desc">', second, "</em></span>",
    )
    clubs = _text(
        '<a class="selector_item">소속 팀컬러</a><a class="selector_item"> </a><a class="selector_item on">',
        F.col("p_type"), " <b>FC</b></a>",
    )
    duo = F.when(key % 4 == 0, _text('<a class="selector_item">', F.col("p_brand"), " duo</a>")).otherwise("")
    relations = _text('<a class="selector_item">관계 팀컬러</a>', duo)
    stats = F.concat(
        stat("속력", size), stat("슛​ 파 워", size + 5), stat("ＧＫ 반응속도", size + 7),
        stat("없는 능력", "50"), stat("시야", "-"),
        F.when(key % 9 == 0, stat("속 력", "99")).otherwise(""),
    )
    html = _text(
        "<!DOCTYPE html><html><head><title>card</title><style>.name{x:y}</style>",
        "<script>var s='<div class=\"name\">script</div>';</script></head><body><!-- <p class=\"name\">no</p> -->",
        '<div class="thumb"><p class="name big"> ', unless(17, _text(F.col("p_name"), " &amp; co")), "\t</p></div>",
        '<p class="name">second</p>', unless(7, _text('<div class="pay"><br><span> ', size % 30, "</span></div>")),
        '<div class="info_line info_ab"><ul>', main, '<span class="position"><b class="txt">half</b></span>', subs,
        '</ul></div><div class="info_line"><span class="position"><b class="txt">no</b><i class="value">1</i></span></div>',
        '<span class="etc height">', F.when(key % 29 == 0, "tall").otherwise(_text(size + 150, "cm")), "</span>",
        unless(11, _text('<span class="weight etc">', size + 50, " kg</span>")),
        '<span class="etc physical"> ', F.lower("p_type"), "<b>(", size, ")</b></span>",
        '<span class="etc skill">', F.expr("repeat('★', cast(p_partkey % 5 + 1 as int))"), "☆</span>",
        '<span class="etc foot">', foot, "</span>",
        '<div class="etc nation"><img src="/n/', size % 10, '.png?a=1&amp;b=2">',
        unless(8, _text('<span class="txt">', second, " land, 국가대표</span>")), "</div>",
        '<div class="skill_wrap">', traits, '</div><div class="tdefault_wrap">', clubs, "</div>",
        '<div class="tspecial_wrap"><p>', relations, '</p></div><div class="data_wrap_playerinfo"><ul>', stats,
        "</ul></div></body></html>",
    )
    url = _text("https://cards.example.com/ability?spid=", card_key(key), "&n1Strong=1")
    return spread(table(spark, sf_dir, "part"), "p_partkey").select(
        key.alias("page_id"), url.alias("url"), html.alias("html")
    )


def card_key(part: Column) -> Column:
    return (part % 50 + 100) * 1_000_000_000 + part


def _named(items: str, *fields: str) -> Column:
    return F.array_join(F.transform(items, lambda t: F.concat_ws("/", *[t[f] for f in fields])), "|")


@query(f"""
WITH {CARDS_SQL}
SELECT spid, season_id, name, main_position, main_ovr, sub_positions, pay, height, weight, body_type,
       skill_moves, preferred_foot, weak_foot, nation_name, nation_image, traits, team_colors,
       pace, shot_power, gk_reflexes, CAST(NULL AS INTEGER) AS vision
FROM cards WHERE error IS NULL
""")
def card_records(spark, sf_dir):
    """Every field of a card page, defective pages left out."""
    cards, _ = split_valid(extract_cards(card_pages(spark, sf_dir)))
    return cards.select(
        "spid", "season_id", "name", "main_position", "main_ovr",
        F.array_join("sub_positions", ",").alias("sub_positions"),
        "pay", "height", "weight", "body_type", "skill_moves", "preferred_foot", "weak_foot",
        "nation_name", "nation_image", _named("traits", "name").alias("traits"),
        _named("team_colors", "name", "type").alias("team_colors"),
        "pace", "shot_power", "gk_reflexes", "vision",
    )


@query(f"WITH {CARDS_SQL} SELECT page_id, spid, error FROM cards WHERE error IS NOT NULL")
def card_rejects(spark, sf_dir):
    """Rejected pages with the first reason."""
    _, rejects = split_valid(extract_cards(card_pages(spark, sf_dir)))
    return rejects.select("page_id", "spid", "error")


@query(f"""
WITH {CARDS_SQL}, traits AS (
  SELECT split_part(traits, '|', 1) AS name, '/t/1.png' AS url, page_id, 0 AS pos FROM cards WHERE error IS NULL
  UNION ALL
  SELECT split_part(traits, '|', 2), '/t/4.png', page_id, 1 FROM cards WHERE error IS NULL)
SELECT name, image_url, uses FROM (
  SELECT name, first_value(url) OVER w AS image_url, count(*) OVER (PARTITION BY name) AS uses,
         row_number() OVER w AS rn
  FROM traits WINDOW w AS (PARTITION BY name ORDER BY page_id, pos))
WHERE rn = 1
""")
def card_trait_names(spark, sf_dir):
    """Trait names met on the cards with the image of their first use."""
    cards, _ = split_valid(extract_cards(card_pages(spark, sf_dir)))
    met = member_candidates(cards).filter(F.col("dim") == TRAIT)
    at = F.struct("page_id", "pos")
    return met.groupBy("name").agg(
        F.min_by("attribute", at).alias("image_url"), F.count(F.lit(1)).alias("uses")
    )


# Two versions of the part table as cards: sizes and types moved, some cards absent before.
VERSIONS_SQL = """
v AS (
  SELECT p_partkey AS spid, p_name AS name, p_size AS old_size, p_type AS old_type,
         p_size + CASE WHEN p_partkey % 7 = 0 THEN 3 WHEN p_partkey % 11 = 0 THEN -2 ELSE 0 END AS new_size,
         p_type || CASE WHEN p_partkey % 13 = 0 THEN ' X' ELSE '' END AS new_type,
         p_partkey % 10 = 9 AS absent, p_partkey % 37 = 0 AS no_rating, p_partkey % 41 = 0 AS no_hash
  FROM part),
acted AS (
  SELECT *, CASE WHEN absent THEN 'insert'
                 WHEN no_hash OR old_size <> new_size OR old_type <> new_type THEN 'update' ELSE 'skip' END AS action,
         CASE WHEN absent OR no_rating THEN 0 ELSE new_size - old_size END AS delta
  FROM v)"""


def _players_from_part(df: DataFrame, size: Column, kind: Column) -> DataFrame:
    """Part rows in the layout the content hash reads; fields a part lacks are null."""
    given = {
        "name": F.col("p_name"), "main_position": kind, "main_ovr": size,
        "season_id": F.col("p_partkey") % 50, "pay": F.col("p_size"),
        "sub_positions": F.array("p_brand"), "trait_ids": F.array(F.col("p_partkey") % 100, F.lit(7)),
        "team_color_ids": F.array(F.lit(3)), "pace": F.col("p_size"),
    }
    types = dict(t.strip().split(" ") for t in PLAYERS.split(","))
    skip = {"id", "created_at", "updated_at", "ovr_change", "ovr_changed_at", "content_hash", "spid"}
    rows = df.select(
        F.col("p_partkey").alias("spid"),
        *[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items() if c not in skip],
    )
    return rows.withColumn("content_hash", content_hash())


def card_versions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(players before, cards now)."""
    part = spread(table(spark, sf_dir, "part"), "p_partkey")
    key = F.col("p_partkey")
    size = F.col("p_size") + F.when(key % 7 == 0, 3).when(key % 11 == 0, -2).otherwise(0)
    kind = F.concat("p_type", F.when(key % 13 == 0, " X").otherwise(""))
    now = _players_from_part(part, size, kind)
    before = _players_from_part(part.filter(key % 10 != 9), F.col("p_size"), F.col("p_type"))
    at = batch_time(CREATED, "timestamp_ntz")
    players = (
        before.withColumn("id", F.col("spid") + 1)
        .withColumn("main_ovr", F.when(F.col("spid") % 37 != 0, F.col("main_ovr")))
        .withColumn("content_hash", F.when(F.col("spid") % 41 != 0, F.col("content_hash")))
        .withColumn("created_at", at).withColumn("updated_at", at)
        .withColumn("ovr_change", F.lit(-1)).withColumn("ovr_changed_at", at)
    )
    order = [c.strip().split(" ")[0] for c in PLAYERS.split(",")]
    return players.select(order), now


@query(f"WITH {VERSIONS_SQL} SELECT spid, action FROM acted")
def card_actions(spark, sf_dir):
    """New, changed and same cards by content hash; a null old hash counts as changed."""
    players, cards = card_versions(spark, sf_dir)
    return classify(players, cards, ["spid"], ["content_hash"])


@query(f"""
WITH {VERSIONS_SQL}
SELECT spid, name, CASE WHEN action = 'skip' THEN old_type ELSE new_type END AS main_position,
  CASE WHEN action = 'skip' THEN CASE WHEN no_rating THEN NULL ELSE old_size END ELSE new_size END AS main_ovr,
  CASE WHEN absent THEN '2024-01-08' ELSE '2024-01-01' END AS created_on,
  CASE WHEN action = 'skip' THEN '2024-01-01' ELSE '2024-01-08' END AS updated_on,
  CASE WHEN absent THEN NULL WHEN action = 'update' AND delta <> 0 THEN delta ELSE -1 END AS ovr_change,
  CASE WHEN absent THEN NULL WHEN action = 'update' AND delta <> 0 THEN '2024-01-08' ELSE '2024-01-01' END AS moved_on
FROM acted
""")
def card_state(spark, sf_dir):
    """Card table after the run; the rating move is kept where the rating did not move."""
    merged = apply_card_changes(*card_versions(spark, sf_dir), NOW)

    def day(c):
        return F.date_format(c, "yyyy-MM-dd")

    return merged.select(
        "spid", "name", "main_position", "main_ovr", day("created_at").alias("created_on"),
        day("updated_at").alias("updated_on"), "ovr_change", day("ovr_changed_at").alias("moved_on"),
    )


@query(f"""
WITH {VERSIONS_SQL}
SELECT action, count(*) AS cards,
       count(*) FILTER (WHERE action = 'update' AND delta <> 0) AS rating_moved FROM acted GROUP BY action
""")
def rating_moves(spark, sf_dir):
    merged = apply_card_changes(*card_versions(spark, sf_dir), NOW)
    moved = F.col("ovr_changed_at") == batch_time(NOW, "timestamp_ntz")
    return merged.groupBy(ACTION).agg(
        F.count(F.lit(1)).alias("cards"), F.count_if(moved).alias("rating_moved")
    )


@query("""
SELECT p_partkey + 1 AS id, p_partkey AS spid,
       CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE p_size END AS main_ovr,
       CASE WHEN p_partkey % 41 = 0 THEN 0 ELSE 64 END AS hash_length
FROM part WHERE p_partkey % 10 <> 9 AND p_partkey IN (SELECT l_partkey FROM lineitem)
""")
def known_cards(spark, sf_dir):
    """State of the known cards among the requested keys, four columns only."""
    players, _ = card_versions(spark, sf_dir)
    keys = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("spid"))
    return existing_state(players, keys).select(
        "id", "spid", "main_ovr", F.coalesce(F.length("content_hash"), F.lit(0)).alias("hash_length")
    )


_STATS_JSON = ",".join(f'"{c}":' + ("' || p_size || '" if c == "pace" else "null") for c in STAT_COLUMNS)


@query(f"""
SELECT p_partkey AS spid, sha256(
  '{{"body_type":null,"height":null,"main_ovr":' || p_size || ',"main_position":"' || p_type ||
  '","name":"' || p_name || '","nation_id":null,"pay":' || p_size || ',"preferred_foot":null,"season_id":' ||
  p_partkey % 50 || ',"skill_moves":null,"stats":{{{_STATS_JSON}}},"sub_positions":["' || p_brand ||
  '"],"team_color_ids":[3],"trait_ids":[' || least(7, p_partkey % 100) || ',' || greatest(7, p_partkey % 100) ||
  '],"weak_foot":null,"weight":null}}') AS content_hash
FROM part
""")
def card_content_hash(spark, sf_dir):
    """SHA-256 of the card's compact, key-sorted JSON."""
    part = table(spark, sf_dir, "part")
    return _players_from_part(part, F.col("p_size"), F.col("p_type")).select("spid", "content_hash")


@query("""
SELECT count(*) AS cards, count(DISTINCT p_partkey) AS hashes, 0 AS order_dependent FROM part
""")
def hash_ignores_id_order(spark, sf_dir):
    """Reversed id lists give the same hash; with the key as a rating, hashes differ by card."""
    part = table(spark, sf_dir, "part")
    cards = _players_from_part(part, F.col("p_partkey"), F.col("p_type"))
    turned = cards.withColumn("trait_ids", F.reverse("trait_ids")).withColumn("again", content_hash())
    return turned.agg(
        F.count(F.lit(1)).alias("cards"),
        F.count_distinct("content_hash").alias("hashes"),
        F.count_if(F.col("again") != F.col("content_hash")).cast("int").alias("order_dependent"),
    )


# A whole run: known dimensions and cards from an earlier state of the same pages.
RUN_SQL = f"""
WITH {CARDS_SQL},
run AS (
  SELECT *, row_number() OVER (ORDER BY spid) - 1 AS pos, page_id % 10 = 9 AS absent,
         page_id % 7 = 3 AS moved FROM cards),
acted AS (
  SELECT *, CAST(pos % 4 AS INTEGER) AS shard, CASE WHEN error IS NOT NULL THEN 'reject' WHEN absent THEN 'insert'
            WHEN moved THEN 'update' ELSE 'skip' END AS action FROM run)
"""


def _card_run(spark, sf_dir, landed=lambda pages: pages):
    """Pages applied to the cards of an earlier run over nine tenths of them; ``landed`` adds pages."""
    empty = as_members(*[spark.createDataFrame([], s) for s in (NATIONS, TRAITS, TEAM_COLORS)])
    no_players = spark.createDataFrame([], PLAYERS)
    catalogue = table(spark, sf_dir, "part").select(
        card_key(F.col("p_partkey")).alias("spid"), F.col("p_name").alias("name"),
        F.lit(False).alias("crawled"), F.lit(None).cast("timestamp").alias("crawled_at"),
    )
    size = F.col("p_size") - F.when(F.col("p_partkey") % 7 == 3, 1).otherwise(0)
    earlier = card_pages(spark, sf_dir, size).filter(F.col("page_id") % 10 != 9)
    first = run_card_job(earlier, no_players, catalogue, empty, "20240101", CREATED, shards=4)
    return run_card_job(
        landed(card_pages(spark, sf_dir)), first.players.drop(ACTION), catalogue, first.members,
        "20240108", NOW, shards=4,
    )


@query(f"""{RUN_SQL}
SELECT shard, count(*) FILTER (WHERE action = 'insert') AS new_players,
       count(*) FILTER (WHERE action = 'update') AS changed,
       count(*) FILTER (WHERE action = 'reject') AS failures
FROM acted GROUP BY shard
""")
def card_run_log(spark, sf_dir):
    """Two full runs over the pages; counts per shard of the second."""
    return _card_run(spark, sf_dir).log.select("shard", "new_players", "changed", "failures")


@query(f"""{RUN_SQL}
SELECT shard, count(*) FILTER (WHERE action = 'insert') AS new_players,
       count(*) FILTER (WHERE action = 'update') AS changed,
       count(*) FILTER (WHERE action = 'reject') + CASE WHEN shard = 0 THEN (SELECT count(*) FROM cards WHERE page_id % 50 = 0) ELSE 0 END AS failures
FROM acted GROUP BY shard
""")
def card_run_log_twice_landed(spark, sf_dir):
    """Every page landed twice counts once; pages without a card key are failures of the first shard."""
    def landed(pages):
        lost = pages.filter(F.col("page_id") % 50 == 0).withColumn("url", F.lit("https://cards.example.com/none"))
        return pages.unionByName(pages).unionByName(lost)

    return _card_run(spark, sf_dir, landed).log.select("shard", "new_players", "changed", "failures")


@query(f"""{RUN_SQL}
SELECT spid, count(*) AS n_rows, any_value(main_ovr) AS main_ovr FROM acted WHERE action <> 'reject' GROUP BY spid
""")
def card_run_state_twice_landed(spark, sf_dir):
    """Every page landed twice leaves one row per card."""
    players = _card_run(spark, sf_dir, lambda pages: pages.unionByName(pages)).players
    return players.groupBy("spid").agg(F.count(F.lit(1)).alias("n_rows"), F.any_value("main_ovr").alias("main_ovr"))


@query(f"""{RUN_SQL}
SELECT spid, name, main_ovr, CASE WHEN absent THEN '2024-01-08' ELSE '2024-01-01' END AS created_on,
       CASE WHEN action = 'skip' THEN '2024-01-01' ELSE '2024-01-08' END AS updated_on,
       CASE WHEN action = 'update' THEN 1 END AS ovr_change
FROM acted WHERE action <> 'reject'
""")
def card_run_state(spark, sf_dir):
    return _card_run(spark, sf_dir).players.select(
        "spid", "name", "main_ovr", F.date_format("created_at", "yyyy-MM-dd").alias("created_on"),
        F.date_format("updated_at", "yyyy-MM-dd").alias("updated_on"), "ovr_change",
    )


@query(f"""{RUN_SQL}
SELECT CASE WHEN action = 'reject' THEN 0 ELSE 1 END AS crawled, count(*) AS cards,
       count(*) FILTER (WHERE action <> 'reject') AS stamped
FROM acted GROUP BY 1
""")
def card_run_marks(spark, sf_dir):
    """Processed cards are marked done, unchanged ones too; rejected ones stay undone."""
    return _card_run(spark, sf_dir).spid.groupBy(F.col("crawled").cast("int").alias("crawled")).agg(
        F.count(F.lit(1)).alias("cards"), F.count("crawled_at").alias("stamped")
    )


def _kept_catalogue(spark, sf_dir) -> str:
    """A new store with the catalogue of all parts; its folder."""
    store = work_dir(spark, "store")
    catalogue = table(spark, sf_dir, "part").select(card_key(F.col("p_partkey")).alias("spid"), F.col("p_name").alias("name"))
    add_to_catalogue(catalogue, store, "20240101/sync", buckets=4)
    return store


def _earlier_pages(spark, sf_dir) -> DataFrame:
    size = F.col("p_size") - F.when(F.col("p_partkey") % 7 == 3, 1).otherwise(0)
    return card_pages(spark, sf_dir, size).filter(F.col("page_id") % 10 != 9)


def _kept_runs(spark, sf_dir) -> str:
    """Two runs on kept tables, the second over all pages; the folder of the tables."""
    store = _kept_catalogue(spark, sf_dir)
    run_kept_card_job(_earlier_pages(spark, sf_dir), store, "20240101", CREATED, shards=4, buckets=4)
    run_kept_card_job(card_pages(spark, sf_dir), store, "20240108", NOW, shards=4, buckets=4)
    return store


def _kept_players(spark, store: str) -> DataFrame:
    return read_kept(spark, store, "players").select(
        "spid", "name", "main_ovr", F.date_format("created_at", "yyyy-MM-dd").alias("created_on"),
        F.date_format("updated_at", "yyyy-MM-dd").alias("updated_on"), "ovr_change",
        F.length("content_hash").alias("hash_length"),
    )


KEPT_SQL = f"""{RUN_SQL}
SELECT spid, name, main_ovr, CASE WHEN absent THEN '2024-01-08' ELSE '2024-01-01' END AS created_on,
       CASE WHEN action = 'skip' THEN '2024-01-01' ELSE '2024-01-08' END AS updated_on,
       CASE WHEN action = 'update' THEN 1 END AS ovr_change, 64 AS hash_length
FROM acted WHERE action <> 'reject'
"""


@query(KEPT_SQL)
def kept_players(spark, sf_dir):
    """Players read back after two runs on kept tables."""
    return _kept_players(spark, _kept_runs(spark, sf_dir))


@query(KEPT_SQL)
def kept_players_recovered(spark, sf_dir):
    """The first run dies once its record is there, before any table is written; the second run carries it out first,
    and is then sent twice."""
    store = _kept_catalogue(spark, sf_dir)
    card_transaction(_earlier_pages(spark, sf_dir), store, "20240101", CREATED, shards=4, buckets=4).take()
    for _ in range(2):
        run_kept_card_job(card_pages(spark, sf_dir), store, "20240108", NOW, shards=4, buckets=4)
    return _kept_players(spark, store)


@query(f"""{RUN_SQL}
SELECT '20240108' AS run_id, shard, count(*) FILTER (WHERE action = 'insert') AS new_players,
       count(*) FILTER (WHERE action = 'update') AS changed, count(*) FILTER (WHERE action = 'reject') AS failures
FROM acted GROUP BY shard
UNION ALL
SELECT '20240101', CAST(pos % 4 AS INTEGER), count(*) FILTER (WHERE error IS NULL), 0, count(*) FILTER (WHERE error IS NOT NULL)
FROM (SELECT *, row_number() OVER (ORDER BY spid) - 1 AS pos FROM cards WHERE page_id % 10 <> 9) GROUP BY 2
""")
def kept_run_log(spark, sf_dir):
    """The log of both runs read back from storage."""
    log = read_run_log(spark, f"{_kept_runs(spark, sf_dir)}/log")
    return log.select("run_id", "shard", "new_players", "changed", "failures")


@query(f"""{RUN_SQL}
SELECT '20240108' AS run_id, count(*) FILTER (WHERE action = 'insert') AS new_players,
       (SELECT count(*) FROM part WHERE p_partkey % 10 = 9) AS new_spid_count,
       count(*) FILTER (WHERE action = 'update') AS changed, count(*) FILTER (WHERE action = 'reject') AS failures,
       (SELECT count(*) FROM nation WHERE n_nationkey % 2 = 1) AS new_seasons, 4 AS shards_logged, 0 AS missing_shards
FROM acted
UNION ALL
SELECT '20240101', count(*) FILTER (WHERE error IS NULL), count(*), 0, count(*) FILTER (WHERE error IS NOT NULL),
       (SELECT count(*) FROM nation WHERE n_nationkey % 2 = 0), 4, 0
FROM cards WHERE page_id % 10 <> 9
""")
def kept_run_summaries(spark, sf_dir):
    """Two runs of both jobs on kept tables, catalogue first; sync and crawl rows read back and summed up."""
    store = work_dir(spark, "store")
    parts, nations = table(spark, sf_dir, "part"), table(spark, sf_dir, "nation")
    cards = parts.select(card_key(F.col("p_partkey")).alias("spid"), F.col("p_name").alias("name"))
    seasons = nations.select(F.col("n_nationkey").cast("int").alias("season_id"), F.col("n_name").alias("class_name"), F.lit(None).cast("string").alias("season_img"))
    early_cards, early_seasons = cards.filter(F.col("spid") % 10 != 9), seasons.filter(F.col("season_id") % 2 == 0)
    run_kept_catalogue_job(early_cards, early_seasons, store, "20240101", CREATED, buckets=4)
    run_kept_card_job(_earlier_pages(spark, sf_dir), store, "20240101", CREATED, shards=4, buckets=4)
    run_kept_catalogue_job(cards, seasons, store, "20240108", NOW, buckets=4)
    run_kept_card_job(card_pages(spark, sf_dir), store, "20240108", NOW, shards=4, buckets=4)
    log = read_run_log(spark, f"{store}/log")
    summary = run_summary(log, read_kept(spark, store, "players"), read_kept(spark, store, "seasons"), ["created_at", "phase", "shard", "seq"])
    return summary.select("run_id", "new_players", "new_spid_count", "changed", "failures", "new_seasons", "shards_logged", "missing_shards")


@query("""
SELECT p_partkey + 1 AS id, p_partkey AS spid,
       CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE p_size END AS main_ovr,
       CASE WHEN p_partkey % 41 = 0 THEN 0 ELSE 64 END AS hash_length
FROM part WHERE p_partkey % 10 <> 9 AND p_partkey IN (SELECT l_partkey FROM lineitem)
""")
def known_cards_kept(spark, sf_dir):
    """State of the known cards among the requested keys, from the buckets of these keys in a kept table."""
    players, _ = card_versions(spark, sf_dir)
    store = work_dir(spark, "store")
    snapshots.commit(players, f"{store}/players", PLAYERS, ["spid"], lambda state, batch, keys: upsert(state, batch, keys, ["content_hash"]), 16)
    keys = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("spid"))
    return known_kept_cards(keys, store).select(
        "id", "spid", "main_ovr", F.coalesce(F.length("content_hash"), F.lit(0)).alias("hash_length")
    )


@query("""
WITH p AS (SELECT p_partkey AS spid, p_size AS a,
                  p_size + CASE WHEN p_partkey % 7 = 0 THEN 3 WHEN p_partkey % 11 = 0 THEN -2 ELSE 0 END AS b FROM part),
v AS (SELECT spid, a, b, b + CASE WHEN spid % 5 = 0 THEN 4 ELSE 0 END AS c, spid % 10 = 9 AS late FROM p),
feed AS (
  SELECT spid, 1 AS version, 'insert' AS action, a AS main_ovr FROM v WHERE NOT late
  UNION ALL SELECT spid, 2, CASE WHEN late THEN 'insert' ELSE 'update' END, b FROM v WHERE late OR a <> b
  UNION ALL SELECT spid, 3, 'update', c FROM v WHERE b <> c)
SELECT spid, version, action, main_ovr, lag(main_ovr) OVER w AS previous_ovr, main_ovr - lag(main_ovr) OVER w AS moved
FROM feed WINDOW w AS (PARTITION BY spid ORDER BY version)
""")
def rating_history(spark, sf_dir):
    """The ratings that three runs wrote, each beside the one before it, from the change feed of the table."""
    part, key, root = spread(table(spark, sf_dir, "part"), "p_partkey"), F.col("p_partkey"), work_dir(spark, "players")
    second = F.col("p_size") + F.when(key % 7 == 0, 3).when(key % 11 == 0, -2).otherwise(0)
    third = second + F.when(key % 5 == 0, 4).otherwise(0)
    for rows, size in ((part.filter(key % 10 != 9), F.col("p_size")), (part, second), (part, third)):
        commit_cards(_players_from_part(rows, size, F.col("p_type")), root, NOW, buckets=8)
    feed = snapshots.read_feed(spark, root, PLAYERS)
    return previous(feed, ["spid"], "version", "main_ovr", "previous_ovr").select(
        "spid", "version", ACTION, "main_ovr", "previous_ovr", (F.col("main_ovr") - F.col("previous_ovr")).alias("moved")
    )

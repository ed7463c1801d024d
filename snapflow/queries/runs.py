"""Run-log and report queries: events as log rows, customers as cards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.functions.scalars import default_run_id, from_naive_utc, utc_text
from snapflow.operators.latest import top_cards, top_cards_per_run, top_per_group
from snapflow.operators.runlog import (
    append_log,
    logged_seasons,
    logged_spids,
    logged_traits,
    run_since,
    run_totals,
)
from snapflow.plans import report
from snapflow.queries.registry import query, table
from snapflow.schemas import RUN_LOG
from snapflow.session import work_dir
from snapflow.sources.readers import read_run_log

ORDER = ["created_at", "event_id"]

# one log row per event; runs are hours
LOG_SQL = """
log AS (
  SELECT strftime(ts, '%Y%m%d%H') AS run_id, event_id, ts AS created_at,
    CASE WHEN event_type = 'signup' THEN 'sync' ELSE 'crawl' END AS phase,
    CASE WHEN event_type = 'signup' OR user_id % 19 = 0 THEN NULL ELSE user_id % 4 END AS shard,
    CASE WHEN event_type = 'click' THEN CAST(floor(value) AS BIGINT) WHEN event_type = 'signup' THEN 1000 END AS new_players,
    CASE WHEN event_type = 'view' THEN 1 END AS changed, CASE WHEN event_type = 'error' THEN 1 END AS failures,
    event_type = 'purchase' AS has_traits, event_type = 'signup' AS has_lists,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, user_id
  FROM events)"""


def run_log(spark, sf_dir) -> DataFrame:
    kind, k, user = F.col("event_type"), F.get_json_object("props", "$.k"), F.col("user_id").cast("string")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    traits = text('[{"id":', k, ',"name":"trait ', user, '"},{"id":', k, ',"name":"trait ', user, '+"}]')
    seasons = text('[{"season_id":', k, ',"class_name":"S', k, ' (Season)"},{"season_id":', user, "}]")
    spids = text("[", user, ",", k, ",", user, "]")
    return table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMddHH").alias("run_id"),
        F.when(kind == "signup", "sync").otherwise("crawl").alias("phase"),
        F.when((kind != "signup") & (F.col("user_id") % 19 != 0), F.col("user_id") % 4).cast("int").alias("shard"),
        F.when(kind == "click", F.floor("value")).when(kind == "signup", 1000).alias("new_players"),
        F.when(kind == "view", 1).cast("bigint").alias("changed"),
        F.when(kind == "error", 1).cast("bigint").alias("failures"),
        F.when(kind == "purchase", traits).when(kind == "signup", traits).alias("new_traits"),
        F.when(kind.isin("signup", "click"), seasons).alias("new_seasons"),
        F.when(kind.isin("signup", "view"), spids).alias("new_spids"),
        from_naive_utc(F.col("ts")).alias("created_at"),
        "event_id",
    )


TOTALS_SQL = f"""
WITH {LOG_SQL},
totals AS (
  SELECT run_id, coalesce(sum(new_players) FILTER (WHERE phase = 'crawl'), 0) AS new_players,
    count(*) FILTER (WHERE changed = 1) AS changed, count(*) FILTER (WHERE failures = 1) AS failures,
    count(DISTINCT shard) AS shards_logged, 4 - count(DISTINCT shard) AS missing_shards,
    min(created_at) AS since
  FROM log GROUP BY run_id),
traits AS (
  SELECT run_id, k AS id, 'trait ' || max_by(user_id, (created_at, event_id)) || '+' AS name,
         min((created_at, event_id)) AS first_at
  FROM log WHERE has_traits GROUP BY run_id, k),
seasons AS (
  SELECT run_id, (created_at, event_id, 0) AS spot, k AS season_id, 'S' || k || ' (Season)' AS class_name FROM log WHERE has_lists
  UNION ALL SELECT run_id, (created_at, event_id, 1), user_id, NULL FROM log WHERE has_lists),
spids AS (
  SELECT run_id, user_id AS spid FROM log WHERE has_lists
  UNION ALL SELECT run_id, k FROM log WHERE has_lists UNION ALL SELECT run_id, user_id FROM log WHERE has_lists)
"""


@query(f"""{TOTALS_SQL}
SELECT run_id, new_players, changed, failures, shards_logged, 4 AS shards_expected, missing_shards,
       strftime(since, '%Y-%m-%d %H:%M:%S') AS since FROM totals
""")
def run_totals_all(spark, sf_dir):
    """Sums, shards logged and missing, and start of every run."""
    totals = run_totals(run_log(spark, sf_dir), expected=4)
    return totals.withColumn("since", utc_text(F.col("first_logged"), "yyyy-MM-dd HH:mm:ss")).drop("first_logged")


@query(f"{TOTALS_SQL} SELECT run_id, id, name FROM traits")
def run_new_traits(spark, sf_dir):
    """New traits of each run, one per id, last name wins."""
    return logged_traits(run_log(spark, sf_dir), ORDER).select("run_id", "id", "name")


@query(f"{TOTALS_SQL} SELECT run_id, CAST(season_id AS INTEGER) AS season_id, class_name FROM seasons")
def run_new_seasons(spark, sf_dir):
    return logged_seasons(run_log(spark, sf_dir), ORDER).drop("at")


@query(f"{TOTALS_SQL} SELECT run_id, spid, count(*) AS mentions FROM spids GROUP BY run_id, spid")
def run_new_spids(spark, sf_dir):
    """New keys of each run, duplicates kept."""
    spids = logged_spids(run_log(spark, sf_dir))
    return spids.groupBy("run_id", "spid").agg(F.count(F.lit(1)).alias("mentions"))


@query(f"""
WITH {LOG_SQL}
SELECT left(run_id, 8) AS run_id, phase, shard, failures, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS logged
FROM log WHERE left(run_id, 8) = '20240103'
""")
def run_log_of_one_run(spark, sf_dir):
    """Log appended to a partitioned table; one run reads its own partition."""
    path = work_dir(spark, "log")
    daily = run_log(spark, sf_dir).drop("event_id").withColumn("run_id", default_run_id(F.col("created_at")))
    append_log(daily, path)
    rows = read_run_log(spark, path, "20240103")
    return rows.select(
        "run_id", "phase", "shard", "failures", utc_text(F.col("created_at"), "yyyy-MM-dd HH:mm:ss").alias("logged")
    )


# customers as cards, nations as seasons
CARDS_SQL = """
cards AS (
  SELECT c_custkey AS spid, c_name AS name, c_nationkey + c_custkey % 3 AS season_id,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(floor(c_acctbal) AS INTEGER) % 500 END AS main_ovr,
    TIMESTAMP '2023-12-25' + to_hours(c_custkey * 7 % 700) AS created_at,
    TIMESTAMP '2023-12-25' + to_hours(c_custkey * 7 % 700) + to_minutes(c_custkey * 13 % 20000) AS updated_at
  FROM customer),
seasons_d AS (SELECT n_nationkey AS season_id, n_name || ' (Nation ' || n_regionkey || ')' AS class_name FROM nation),
labelled AS (
  SELECT cards.*, class_name, trim(coalesce(regexp_replace(class_name, ' \\([^(]*$', ''), '') || ' ' || name) AS label
  FROM cards LEFT JOIN seasons_d USING (season_id))""".replace("\\\\", "\\")


def cards(spark, sf_dir) -> DataFrame:
    key = F.col("c_custkey")
    base = F.lit("2023-12-25").cast("timestamp_ntz")
    created = base + F.make_dt_interval(hours=(key * 7 % 700).cast("int"))
    return table(spark, sf_dir, "customer").select(
        key.alias("spid"), F.col("c_name").alias("name"),
        (F.col("c_nationkey") + key % 3).cast("int").alias("season_id"),
        F.when(F.col("c_acctbal") >= 0, F.floor("c_acctbal") % 500).cast("int").alias("main_ovr"),
        created.alias("created_at"),
        (created + F.make_dt_interval(mins=(key * 13 % 20000).cast("int"))).alias("updated_at"),
    )


def seasons(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("season_id"),
        F.concat("n_name", F.lit(" (Nation "), "n_regionkey", F.lit(")")).alias("class_name"),
    )


@query(f"WITH {CARDS_SQL} SELECT spid, season_id, class_name, label FROM labelled")
def cards_with_season(spark, sf_dir):
    """Season name joined on, null where the season is unknown."""
    from snapflow.functions.text import card_label, short_name

    named = report.with_season(cards(spark, sf_dir), seasons(spark, sf_dir))
    label = card_label(short_name(F.col("class_name")), F.col("name"))
    return named.select("spid", "season_id", "class_name", label.alias("label"))


@query(f"WITH {CARDS_SQL} SELECT spid, name, main_ovr FROM cards ORDER BY main_ovr DESC NULLS LAST, spid LIMIT 25")
def best_cards(spark, sf_dir):
    return top_cards(cards(spark, sf_dir), 25).select("spid", "name", "main_ovr")


@query(f"""
WITH {CARDS_SQL}, {LOG_SQL}
SELECT run_id, spid, main_ovr, rank FROM (
  SELECT r.run_id, c.spid, c.main_ovr, row_number() OVER (PARTITION BY r.run_id ORDER BY main_ovr DESC NULLS LAST, c.spid) AS rank
  FROM (SELECT DISTINCT run_id, user_id AS spid FROM log) r JOIN cards c USING (spid))
WHERE rank <= 3
""")
def best_cards_per_run(spark, sf_dir):
    """Top three cards among those each run touched."""
    touched = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMddHH").alias("run_id"), F.col("user_id").alias("spid")
    ).distinct()
    narrow = cards(spark, sf_dir).select("spid", "main_ovr")
    return top_cards_per_run(touched.join(narrow, "spid"), 3)


@query("""
SELECT c_mktsegment, c_custkey, rank FROM (
  SELECT c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rank
  FROM customer) WHERE rank <= 1200
""")
def long_top_lists(spark, sf_dir):
    """Top lists longer than what is pruned by rank before the shuffle."""
    best = top_per_group(
        table(spark, sf_dir, "customer"), ["c_mktsegment"], [F.desc("c_acctbal"), F.asc("c_custkey")], 1200, tie="c_custkey"
    )
    return best.select("c_mktsegment", "c_custkey", "rank")


@query(f"""
WITH {CARDS_SQL}, s AS (SELECT min(ts) AS since FROM events)
SELECT spid FROM cards, s WHERE updated_at >= since AND created_at < since
""")
def changed_cards(spark, sf_dir):
    """Cards known before the first logged run and written since."""
    log = run_log(spark, sf_dir).withColumn("run_id", F.lit("all"))
    since = run_since(log).select("since").scalar()
    return report.changed_since(cards(spark, sf_dir), since).select("spid")


CHANGED_SQL = f"""{TOTALS_SQL}, {CARDS_SQL},
windows AS (SELECT run_id, since, lead(since) OVER (ORDER BY since, run_id) AS until FROM totals),
changed_cards AS (
  SELECT w.run_id, c.* FROM labelled c JOIN windows w
    ON c.updated_at >= w.since AND (w.until IS NULL OR c.updated_at < w.until) AND c.created_at < w.since)
"""


@query(f"{CHANGED_SQL} SELECT run_id, spid FROM changed_cards")
def changed_cards_per_run(spark, sf_dir):
    """Each changed card with the run that wrote it."""
    return report.changed_in_runs(cards(spark, sf_dir), run_log(spark, sf_dir)).select("run_id", "spid")


SUMMARY_SQL = f"""{CHANGED_SQL},
t AS (SELECT run_id, count(*) AS n, string_agg(name, ', ' ORDER BY first_at) FILTER (WHERE r <= 5) AS names
      FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY first_at) AS r FROM traits) GROUP BY run_id),
s AS (SELECT run_id, count(*) AS n, string_agg(coalesce(class_name, '?'), ', ' ORDER BY spot) FILTER (WHERE r <= 3) AS names
      FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY spot) AS r FROM seasons) GROUP BY run_id),
k AS (SELECT run_id, count(*) AS n FROM spids GROUP BY run_id),
fresh AS (SELECT run_id, label, row_number() OVER (PARTITION BY run_id ORDER BY main_ovr DESC NULLS LAST, spid) AS r
          FROM (SELECT DISTINCT run_id, spid FROM spids) JOIN labelled USING (spid)),
f AS (SELECT run_id, count(*) AS n, string_agg(label, ', ' ORDER BY r) AS names FROM fresh WHERE r <= 5 GROUP BY run_id),
old AS (SELECT run_id, label, row_number() OVER (PARTITION BY run_id ORDER BY main_ovr DESC NULLS LAST, spid) AS r FROM changed_cards),
c AS (SELECT run_id, count(*) AS n, string_agg(label, ', ' ORDER BY r) AS names FROM old WHERE r <= 5 GROUP BY run_id),
summary AS (
  SELECT a.run_id, a.new_players, coalesce(k.n, 0) AS new_spid_count, a.changed, a.failures,
    coalesce(t.n, 0) AS new_traits, coalesce(s.n, 0) AS new_seasons,
    coalesce(t.names, '') AS trait_names, coalesce(s.names, '') AS season_names, coalesce(f.names, '') AS top_new,
    CASE WHEN a.changed > 0 THEN coalesce(c.names, '') ELSE '' END AS top_changed,
    coalesce(f.n, 0) AS n_top_new, coalesce(c.n, 0) AS n_top_changed, a.shards_logged, a.missing_shards
  FROM totals a LEFT JOIN t USING (run_id) LEFT JOIN s USING (run_id) LEFT JOIN k USING (run_id)
  LEFT JOIN f USING (run_id) LEFT JOIN c USING (run_id))
"""


def _summary(spark, sf_dir) -> DataFrame:
    return report.run_summary(run_log(spark, sf_dir), cards(spark, sf_dir), seasons(spark, sf_dir), ORDER)


@query(f"""{SUMMARY_SQL}
SELECT run_id, new_players, new_spid_count, changed, failures, new_traits, new_seasons, trait_names, season_names,
       top_new, top_changed, shards_logged, 4 AS shards_expected, missing_shards,
       CAST(missing_shards > 0 AS INTEGER) AS shards_missing, CAST(failures > 0 AS INTEGER) AS has_failures,
       CAST(new_players = 0 AND changed = 0 AND new_traits = 0 AND new_seasons = 0 AND failures = 0
            AND missing_shards = 0 AS INTEGER) AS nothing_happened
FROM summary
""")
def run_summaries(spark, sf_dir):
    """Summary, previews and alert flags of every run."""
    flagged = report.run_flags(_summary(spark, sf_dir))
    lists = ("trait_names", "season_names", "top_new", "top_changed")
    flags = ("shards_missing", "has_failures", "nothing_happened")
    return flagged.select(*[
        F.array_join(c, ", ").alias(c) if c in lists else F.col(c).cast("int").alias(c) if c in flags else F.col(c)
        for c in flagged.columns
    ])


def _message_sql(max_len: int | None) -> str:
    def more(total: str, shown: str, unit: str) -> str:
        return f"CASE WHEN {total} > {shown} THEN ' 외 ' || ({total} - {shown}) || '{unit}' ELSE '' END"

    lines = f"""concat_ws(chr(10),
      '[메타 크롤 #' || right(run_id, 6) || ']',
      CASE WHEN missing_shards > 0 THEN '⚠️ 샤드 누락 ' || missing_shards || '/4 (잡 실패 의심)' END,
      CASE WHEN failures > 0 THEN '🔴 크롤 실패 ' || failures || '건' END,
      '🟢 신규선수 ' || new_players || '  🔵 변동 ' || changed || '장',
      '🟡 신규특성 ' || new_traits || '  🟣 신규시즌 ' || new_seasons,
      CASE WHEN new_traits > 0 THEN '• 특성: ' || trait_names || {more('new_traits', '5', '개')} END,
      CASE WHEN new_seasons > 0 THEN '• 시즌: ' || season_names || {more('new_seasons', '3', '개')} END,
      CASE WHEN top_new <> '' THEN '• 신규: ' || top_new || {more('new_spid_count', 'n_top_new', '명')} END,
      CASE WHEN top_changed <> '' THEN '• 변동: ' || top_changed || {more('changed', 'n_top_changed', '장')} END,
      CASE WHEN new_players = 0 AND changed = 0 AND new_traits = 0 AND new_seasons = 0 AND failures = 0
                AND missing_shards = 0 THEN '변동 없음 (정상 동작)' END)"""
    cut = "m" if max_len is None else f"CASE WHEN length(m) > {max_len} THEN left(m, {max_len - 1}) || '…' ELSE m END"
    return f"{SUMMARY_SQL} SELECT run_id, {cut} AS message FROM (SELECT run_id, {lines} AS m FROM summary)"


@query(_message_sql(None))
def run_messages(spark, sf_dir):
    """Full summary text of every run."""
    return report.run_message(_summary(spark, sf_dir))


@query(_message_sql(report.SHORT_FORM))
def run_messages_short(spark, sf_dir):
    """Summary text cut to the short form, alerts first."""
    return report.run_message(_summary(spark, sf_dir), max_len=report.SHORT_FORM)

"""Scalar functions on whole columns of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapflow.functions import text as tx
from snapflow.functions.grades import grade_spec
from snapflow.functions.scalars import (
    days_before,
    default_run_id,
    from_naive_utc,
    is_distinct,
    series_end,
    utc_text,
)
from snapflow.operators.extract import extract_cards, map_labels, split_valid
from snapflow.queries.registry import query, table
from snapflow.schemas import STAT_LABELS
from snapflow.sources.readers import read_pages


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_name WHEN p_partkey % 5 = 1 THEN p_name || '(x)'
         WHEN p_partkey % 5 = 2 THEN '(' || p_type || ')' WHEN p_partkey % 5 = 3 THEN '' ELSE p_brand END AS short,
       p_name || ' land' AS nation, p_brand || ' ' || p_type AS label, right('run-' || p_partkey || p_type, 6) AS tail,
       CASE WHEN length(p_name || ' / ' || p_type) > 14 THEN left(p_name || ' / ' || p_type, 13) || '…'
            ELSE p_name || ' / ' || p_type END AS cut
FROM part
""")
def name_functions(spark, sf_dir):
    """Season short name, nation clean-up, card label, run tail and truncation."""
    key, name, kind = F.col("p_partkey"), F.col("p_name"), F.col("p_type")
    season = (
        F.when(key % 5 == 0, F.concat(name, F.lit(" ("), kind, F.lit(")")))
        .when(key % 5 == 1, F.concat(name, F.lit("(x) (Long Name)")))
        .when(key % 5 == 2, F.concat(F.lit(" ("), kind, F.lit(") ")))
        .when(key % 5 == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("\t"), "p_brand", F.lit(" ")))
    )
    nation = F.when(key % 2 == 0, F.concat(name, F.lit(" land, 국가대표"))).otherwise(
        F.concat(F.lit("국가대표　"), name, F.lit(" land"))
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", tx.short_name(season).alias("short"), tx.clean_nation(nation).alias("nation"),
        tx.card_label(F.col("p_brand"), kind).alias("label"),
        tx.last6(F.concat(F.lit("run-"), key.cast("string"), kind)).alias("tail"),
        tx.truncate(F.concat_ws(" / ", name, kind), 14).alias("cut"),
    )


@query("""
SELECT doc_id, TRY_CAST(nullif(regexp_extract(text, '[0-9]+', 0), '') AS INTEGER) AS first_number,
       length(text) - length(replace(text, 'e', '')) AS stars,
       regexp_replace(text, '[\\s]+', '', 'g') AS label
FROM documents
""".replace("\\\\", "\\"))
def text_functions(spark, sf_dir):
    """First number, star count and label clean-up over whole documents."""
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", tx.first_int(text).alias("first_number"),
        tx.star_count(F.replace(text, F.lit("e"), F.lit(tx.STAR))).alias("stars"),
        tx.clean_label(text).alias("label"),
    )


@query("""
SELECT o_orderkey,
  CASE WHEN o_orderkey % 5 = 4 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'L' ELSE 'R' END AS side,
  CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE 1 + o_orderkey % 4 END AS weak
FROM orders
""")
def foot_ratings(spark, sf_dir):
    """Preferred side from the emphasis, rating of the other side, last pair per side."""
    key = F.col("o_orderkey")
    rating = (key % 4 + 1).cast("string")
    left = F.concat(F.lit("L5 – R9 – R "), rating)
    right = F.concat(F.lit("L"), rating, F.lit(" – R5"))
    text = F.when(key % 2 == 0, left).otherwise(right)
    strong = F.when(key % 5 == 4, F.lit(None)).when(key % 2 == 0, " L5").otherwise("R5")
    feet = table(spark, sf_dir, "orders").select("o_orderkey", tx.foot(text, strong.cast("string")).alias("f"))
    return feet.select("o_orderkey", F.col("f.side").alias("side"), F.col("f.weak").cast("bigint").alias("weak"))


@query("""
SELECT p_partkey, list_aggregate(list_sort(list_distinct(list_filter(
         list_concat(range(p_size % 15, p_size % 15 + p_partkey % 4), [p_partkey % 20]),
         lambda x: x BETWEEN 1 AND 13))), 'string_agg', ',') AS grades
FROM part
""")
def grade_lists(spark, sf_dir):
    """Grade lists with ranges, blanks, repeats and values outside the domain."""
    key, low = F.col("p_partkey"), F.col("p_size") % 15
    spec = F.concat_ws(
        "", low.cast("string"), F.lit("-"), (low + key % 4 - 1).cast("string"), F.lit(", ,"),
        (key % 20).cast("string"), F.lit(" ,9-4,"),
    )
    # a range ending at -1 is malformed and tested apart; here it is written as empty
    safe = F.when(low + key % 4 - 1 < 0, F.concat((key % 20).cast("string"), F.lit(",,3-1"))).otherwise(spec)
    grades = F.array_join(grade_spec(safe).cast("array<string>"), ",")
    return table(spark, sf_dir, "part").select("p_partkey", F.nullif(grades, F.lit("")).alias("grades"))


@query("""
SELECT event_id, strftime(ts, '%Y%m%d') AS run_id, CAST(CAST(ts AS DATE) - 1 AS VARCHAR) AS series_end,
       CAST(CAST(ts AS DATE) - CAST(user_id % 30 AS INTEGER) AS VARCHAR) AS earlier,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS utc,
       CAST(nullif(user_id % 3, 0) IS DISTINCT FROM nullif(event_id % 3, 0) AS INTEGER) AS differs
FROM events
""")
def date_functions(spark, sf_dir):
    """Run id, series end, back-dating, naive UTC time and null-safe difference."""
    instant = from_naive_utc(F.col("ts"))
    day = F.col("ts").cast("date")
    zero = F.lit(0)
    return table(spark, sf_dir, "events").select(
        "event_id", default_run_id(instant).alias("run_id"), series_end(day).cast("string").alias("series_end"),
        days_before(day, (F.col("user_id") % 30).cast("int")).cast("string").alias("earlier"),
        utc_text(instant, "yyyy-MM-dd HH:mm:ss").alias("utc"),
        is_distinct(F.nullif(F.col("user_id") % 3, zero), F.nullif(F.col("event_id") % 3, zero)).cast("int").alias("differs"),
    )


_COLUMNS_SQL = ", ".join(f"'{c}'" for c in STAT_LABELS.values())


@query(f"""
SELECT doc_id, CASE WHEN doc_id % 35 = 34 THEN NULL ELSE list_extract([{_COLUMNS_SQL}], CAST(doc_id % 35 + 1 AS INTEGER)) END AS stat
FROM documents
""")
def stat_labels(spark, sf_dir):
    """Printed stat labels, some spaced, zero-width or full-width, to columns."""
    noise = F.col("doc_id") % 4
    printed = F.get(F.array(*[F.lit(x) for x in STAT_LABELS], F.lit("키")), (F.col("doc_id") % 35).cast("int"))
    label = (
        F.when(noise == 1, F.concat(F.lit(" "), printed, F.lit("​\n")))
        .when(noise == 2, F.translate(printed, "GK ", "ＧＫ　"))
        .when(noise == 3, F.concat(F.substring(printed, 1, 1), F.lit("‍ "), F.substring(printed, 2, 99)))
        .otherwise(printed)
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", label.alias("label"))
    return map_labels(docs, "label").select("doc_id", "stat")


# the entities that occur in titles; the reader accepts them without the semicolon
TITLE_SQL = (
    "regexp_replace(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), "
    "'&quot;?', '\"', 'g'), '&amp;?', '&', 'g')"
)


def _titled(spark, sf_dir):
    """Pages as card pages: the title is the name, each navigation link is a trait."""
    html = F.regexp_replace("html", "<title>([^<]*)</title>", '<b class="name">$1</b>')
    html = F.when(F.col("page_id") % 17 == 0, F.regexp_replace(html, '(?s)<b class="name">.*?</b>', '<b class="name"> </b>')).otherwise(html)
    html = F.regexp_replace(html, '<nav><ul>', '<nav><ul class="skill_wrap">')
    html = F.regexp_replace(html, '<li><a href="([^"]*)">([^<]*)</a></li>', '<span><img src="$1"><i class="desc">$2</i></span>')
    position = '<p class="info_line info_ab"><u class="position"><u class="txt">P</u><u class="value">1</u></u></p>'
    html = F.regexp_replace(html, "<body>", "<body>" + position)
    url = F.concat(F.lit("https://x.example.com/?spid="), (F.col("page_id") + 100_000_000).cast("string"))
    pages = table(spark, sf_dir, "pages").select("page_id", url.alias("url"), html.alias("html"))
    return extract_cards(pages)


@query(f"SELECT page_id, trim({TITLE_SQL}) AS title FROM pages WHERE page_id % 17 <> 0")
def page_titles(spark, sf_dir):
    """Names of raw pages by element class, entities decoded."""
    ok, _ = split_valid(_titled(spark, sf_dir))
    return ok.select("page_id", F.col("name").alias("title"))


@query("SELECT page_id, 'name not found' AS error FROM pages WHERE page_id % 17 = 0")
def page_rejects(spark, sf_dir):
    """Pages without a name are set apart with the reason."""
    _, rejects = split_valid(_titled(spark, sf_dir))
    return rejects.select("page_id", "error")


@query("""
WITH l AS (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS names,
                  regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1) AS urls
           FROM pages WHERE page_id % 17 <> 0)
SELECT page_id, unnest(names) AS name, unnest(urls) AS url, generate_subscripts(names, 1) - 1 AS pos FROM l
""")
def page_links(spark, sf_dir):
    """Ordered (name, link) lists of raw pages."""
    ok, _ = split_valid(_titled(spark, sf_dir))
    return ok.select("page_id", F.posexplode("traits").alias("pos", "t")).select(
        "page_id", F.col("t.name").alias("name"), F.col("t.image_url").alias("url"), F.col("pos").cast("bigint").alias("pos")
    )


@query("SELECT page_id, url, length(html) AS n_chars FROM pages")
def landed_pages(spark, sf_dir):
    """Raw pages as a table."""
    return read_pages(spark, f"{sf_dir}/pages.parquet").select(
        "page_id", "url", F.length("html").cast("bigint").alias("n_chars")
    )

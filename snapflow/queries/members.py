"""Dimension queries: names on parts, pages and orders to stable ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapflow.operators.dims import created_members, get_or_create, new_members, resolve_ids
from snapflow.queries.registry import query, table
from snapflow.sources.readers import known_ids, with_page_keys

DIM_SQL = """
WITH c AS (SELECT p_brand || ' ' || p_type AS name, p_name AS image_url, p_partkey, p_size FROM part),
known AS (
  SELECT name, min_by(image_url, p_partkey) AS image_url, CAST(min(p_partkey) * 10 + 5 AS INTEGER) AS id
  FROM c WHERE p_size < 20 GROUP BY name),
fresh AS (
  SELECT name, min_by(image_url, p_partkey) AS image_url, min(p_partkey) AS seen
  FROM c WHERE name NOT IN (SELECT name FROM known) GROUP BY name),
created AS (
  SELECT CAST((SELECT max(id) FROM known) + row_number() OVER (ORDER BY seen, name) AS INTEGER) AS id,
         name, image_url FROM fresh)
"""


def _dimension(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(known members, candidates): names are brand and type, some met before."""
    candidates = table(spark, sf_dir, "part").select(
        F.concat_ws(" ", "p_brand", "p_type").alias("name"),
        F.col("p_name").alias("image_url"), "p_partkey", "p_size",
    )
    known = candidates.filter(F.col("p_size") < 20).groupBy("name").agg(
        F.min_by("image_url", "p_partkey").alias("image_url"),
        (F.min("p_partkey") * 10 + 5).cast("int").alias("id"),
    )
    return known, candidates


@query(f"{DIM_SQL} SELECT id, name, image_url FROM known UNION ALL SELECT * FROM created")
def dimension_get_or_create(spark, sf_dir):
    """Known ids stay, new names get the next ones, first-seen attributes win."""
    known, candidates = _dimension(spark, sf_dir)
    return get_or_create(known, candidates, ["image_url"], ["p_partkey"])


@query(f"{DIM_SQL} SELECT id, name FROM created")
def dimension_created(spark, sf_dir):
    known, candidates = _dimension(spark, sf_dir)
    return created_members(known, candidates, ["image_url"], ["p_partkey"]).select("id", "name")


LINKS = '<li><a href="[^"]*">([^<]*)</a></li>'
LINK_IDS_SQL = f"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '{LINKS}', 1) AS names FROM pages),
flat AS (SELECT page_id, unnest(names) AS name, generate_subscripts(names, 1) AS pos FROM l),
dim AS (SELECT name, dense_rank() OVER (ORDER BY md5(name)) AS id FROM (SELECT DISTINCT name FROM flat))
SELECT l.page_id, coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos), '') AS link_ids,
       coalesce(max(CASE WHEN pos = 1 THEN id END), 0) AS first_id
FROM l LEFT JOIN flat USING (page_id) LEFT JOIN dim USING (name) GROUP BY l.page_id
"""


def _links(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract_all("html", F.lit(LINKS), F.lit(1)).alias("names")
    )


@query(LINK_IDS_SQL)
def resolve_link_ids(spark, sf_dir):
    """Ordered name lists of the pages to id lists, order kept, empty lists kept."""
    links = _links(spark, sf_dir)
    names = links.select(F.explode("names").alias("name")).distinct().withColumn("_h", F.md5("name"))
    # ids in hash order, so that the oracle can name them: rank within a hash
    # prefix plus the sizes of the prefixes before it
    prefix = F.substring("_h", 1, 2)
    ranked = names.select(
        "name", prefix.alias("_p"),
        F.row_number().over(Window.partitionBy(prefix).orderBy("_h")).alias("_r"),
    )
    sizes = ranked.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    dim = ranked.join(F.broadcast(offsets), "_p").select("name", (F.col("_r") + F.col("_o")).alias("id"))
    lists = links.withColumn("first", F.slice("names", 1, 1))
    wanted = {"ids": ("names", "link"), "first_ids": ("first", "link")}
    ids = resolve_ids(lists, "page_id", wanted, dim.withColumn("dim", F.lit("link")))
    return ids.select(
        "page_id", F.array_join(F.col("ids").cast("array<string>"), ",").alias("link_ids"),
        F.coalesce(F.try_element_at("first_ids", F.lit(1)), F.lit(0)).alias("first_id"),
    )


@query("""
SELECT o_custkey AS id, max_by(o_orderpriority, o_orderkey) AS name FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01'
  AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')
GROUP BY o_custkey
""")
def first_seen_members(spark, sf_dir):
    """Members used now and not known before the run; the last name counts."""
    orders = table(spark, sf_dir, "orders")
    cutover = F.lit("1996-01-01").cast("timestamp_ntz")
    members = orders.select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("name"), "o_orderkey", "o_orderdate"
    )
    known = known_ids(members.filter(F.col("o_orderdate") < cutover)).distinct()
    return new_members(members.filter(F.col("o_orderdate") >= cutover), known, ["o_orderkey"])


@query(r"""
SELECT page_id, TRY_CAST(nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS BIGINT) AS page_no,
       regexp_extract(url, '[?&]ref=([^&#]*)', 1) AS ref
FROM pages
""")
def page_address_keys(spark, sf_dir):
    """Typed parameters of the page address."""
    from snapflow.functions.text import page_key

    return table(spark, sf_dir, "pages").select(
        "page_id", page_key(F.col("url"), "page").alias("page_no"),
        F.coalesce(page_key(F.col("url"), "ref", "string"), F.lit("")).alias("ref"),
    )


@query("""
SELECT (100 + o_orderkey % 50) * 1000000000 + o_orderkey AS spid, 1 + o_orderkey % 13 AS strong,
       100 + o_orderkey % 50 AS season_id
FROM orders
""")
def page_card_keys(spark, sf_dir):
    """Card key, grade and season read back from page addresses."""
    from snapflow.functions.text import season_id

    key = F.col("o_orderkey")
    url = F.concat(
        F.lit("https://cards.example.com/graph?spid="), ((key % 50 + 100) * 1_000_000_000 + key).cast("string"),
        F.lit("&n1Strong="), (key % 13 + 1).cast("string"),
    )
    pages = with_page_keys(table(spark, sf_dir, "orders").select(url.alias("url")))
    return pages.select(
        "spid", F.col("strong").cast("bigint").alias("strong"),
        season_id(F.col("spid")).cast("bigint").alias("season_id"),
    )

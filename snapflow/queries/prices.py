"""Price queries over events (observed prices) and orders (price pages)."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.functions.scalars import batch_time, utc_text
from snapflow.functions.series import back_date, latest_point, recent, with_series, zip_points
from snapflow.operators.extract import price_series
from snapflow.operators.latest import latest_per_key
from snapflow.operators.upsert import ACTION, changes, classify, load_counts, upsert_latest
from snapflow.plans.price_job import KEYS, commit_prices, price_batch, run_price_job, work_list
from snapflow.queries.registry import query, spread, table
from snapflow.schemas import PRICE_LATEST
from snapflow.session import work_dir
from snapflow.sources import snapshots
from snapflow.sources.readers import with_page_keys

FIRST, SECOND, THIRD = dt.datetime(2024, 1, 16), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)
AS_OF = dt.date(2024, 6, 2)

# each event is one observed price of a (card, grade) pair
POINTS_SQL = """
pts AS (
  SELECT user_id * 10 + CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2
           WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS spid,
         1 + CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 13 AS strong,
         CAST(floor(value / 25) AS BIGINT) AS price, CAST(ts AS DATE) AS price_date, ts, event_id
  FROM events)"""

SLICES_SQL = f"""
WITH {POINTS_SQL},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY spid, strong, ts < TIMESTAMP '2024-01-16'
                               ORDER BY ts DESC, event_id DESC) AS rn FROM pts),
o AS (SELECT * FROM ranked WHERE rn = 1 AND ts < TIMESTAMP '2024-01-16'),
n AS (SELECT * FROM ranked WHERE rn = 1 AND ts >= TIMESTAMP '2024-01-16'),
m AS (
  SELECT coalesce(o.spid, n.spid) AS spid, coalesce(o.strong, n.strong) AS strong,
         CASE WHEN n.spid IS NULL THEN 'keep' WHEN o.spid IS NULL THEN 'insert'
              WHEN o.price IS DISTINCT FROM n.price THEN 'update' ELSE 'skip' END AS action,
         o.price AS old_price, n.price AS new_price, o.price_date AS old_date, n.price_date AS new_date
  FROM o FULL JOIN n ON o.spid = n.spid AND o.strong = n.strong),
state AS (
  SELECT spid, strong, action,
         CASE WHEN action IN ('insert', 'update') THEN new_price ELSE old_price END AS price,
         CAST(CASE WHEN action IN ('insert', 'update') THEN new_date ELSE old_date END AS VARCHAR) AS price_date,
         CASE WHEN action IN ('insert', 'update') THEN '2024-02-01' ELSE '2024-01-16' END AS updated_on
  FROM m)
"""


def points(spark, sf_dir) -> DataFrame:
    kind = F.expr(
        "case event_type when 'click' then 1 when 'error' then 2 "
        "when 'purchase' then 3 when 'signup' then 4 else 5 end"
    )
    grade = F.get_json_object("props", "$.k").cast("int") % 13 + 1
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") * 10 + kind).alias("spid"),
        grade.cast("smallint").alias("strong"),
        F.floor(F.col("value") / 25).alias("price"),
        F.col("ts").cast("date").alias("price_date"),
        "ts",
        "event_id",
    )


def _latest(df: DataFrame) -> DataFrame:
    return latest_per_key(df, KEYS, ["ts", "event_id"]).drop("ts", "event_id")


def state_and_batch(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Prices known before the middle of the month, and the latest ones after it."""
    pts = points(spark, sf_dir)
    old = _latest(pts.filter(F.col("ts") < batch_time(FIRST, "timestamp_ntz")))
    new = _latest(pts.filter(F.col("ts") >= batch_time(FIRST, "timestamp_ntz")))
    return old.withColumn("updated_at", batch_time(FIRST)), new


def merged(spark, sf_dir) -> DataFrame:
    return upsert_latest(*state_and_batch(spark, sf_dir), SECOND)


def _plain(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "spid",
        F.col("strong").cast("int").alias("strong"),
        "price",
        F.col("price_date").cast("string").alias("price_date"),
        utc_text(F.col("updated_at")).alias("updated_on"),
        *more,
    )


@query(f"""
WITH {POINTS_SQL}
SELECT spid, strong, price, CAST(price_date AS VARCHAR) AS price_date
FROM (SELECT *, row_number() OVER (PARTITION BY spid, strong ORDER BY ts DESC, event_id DESC) AS rn FROM pts)
WHERE rn = 1
""")
def latest_price_per_pair(spark, sf_dir):
    df = _latest(points(spark, sf_dir))
    return df.select(
        "spid", F.col("strong").cast("int").alias("strong"), "price",
        F.col("price_date").cast("string").alias("price_date"),
    )


@query(f"{SLICES_SQL} SELECT spid, strong, action FROM m WHERE action <> 'keep'")
def upsert_actions(spark, sf_dir):
    old, new = state_and_batch(spark, sf_dir)
    return classify(old, new, KEYS, ["price"]).withColumn("strong", F.col("strong").cast("int"))


@query(f"{SLICES_SQL} SELECT spid, strong, price, price_date, updated_on FROM state")
def upsert_state(spark, sf_dir):
    return _plain(merged(spark, sf_dir))


@query(f"""{SLICES_SQL}
SELECT spid, strong, price, price_date, updated_on, action FROM state WHERE action IN ('insert', 'update')
""")
def upsert_changes(spark, sf_dir):
    return _plain(changes(merged(spark, sf_dir)), ACTION)


@query(f"""{SLICES_SQL}
SELECT count(*) FILTER (WHERE action <> 'keep') AS attempted,
       count(*) FILTER (WHERE action = 'insert') AS "insert",
       count(*) FILTER (WHERE action = 'update') AS "update",
       count(*) FILTER (WHERE action = 'skip') AS skip
FROM m
""")
def upsert_load_counts(spark, sf_dir):
    return load_counts(merged(spark, sf_dir))


@query(f"{SLICES_SQL} SELECT spid, strong, 'skip' AS action FROM n")
def upsert_replayed(spark, sf_dir):
    """The same batch again: every row is skipped."""
    _, new = state_and_batch(spark, sf_dir)
    after = merged(spark, sf_dir).drop(ACTION)
    return classify(after, new, KEYS, ["price"]).withColumn("strong", F.col("strong").cast("int"))


@query(f"{SLICES_SQL} SELECT spid, strong, price, price_date, updated_on FROM state")
def snapshot_upsert(spark, sf_dir):
    """Both slices committed to a versioned table, then read back."""
    old, new = state_and_batch(spark, sf_dir)
    root = work_dir(spark, "prices")
    for rows, now in ((old.drop("updated_at"), FIRST), (new, SECOND)):
        snapshots.commit(
            rows, root, PRICE_LATEST, KEYS,
            lambda state, batch, keys, now=now: upsert_latest(state, batch, now, keys), buckets=16,
        )
    return _plain(snapshots.read_snapshot(spark, root, PRICE_LATEST))


def _committed(spark, sf_dir, *more) -> str:
    """Both slices committed, then further (batch, time, commit id) steps; the table's folder."""
    old, new = state_and_batch(spark, sf_dir)
    root = work_dir(spark, "prices")
    for rows, now, commit_id in ((old.drop("updated_at"), FIRST, "first"), (new, SECOND, "second"), *more):
        commit_prices(rows, root, now, commit_id, buckets=8)
    return root


@query(f"""{SLICES_SQL}
SELECT spid, strong, price, price_date, updated_on FROM state
WHERE strong = 7 AND price BETWEEN 1 AND 3
""")
def range_search(spark, sf_dir):
    """Grade and price-range search on the maintained table: only files whose range meets it are opened."""
    return _plain(snapshots.search_snapshot(spark, _committed(spark, sf_dir), PRICE_LATEST, 7, 1, 3))


@query(f"{SLICES_SQL} SELECT spid, strong, price, price_date, updated_on FROM state")
def retried_commit(spark, sf_dir):
    """An old commit tried again after a newer one changes nothing."""
    old, _ = state_and_batch(spark, sf_dir)
    root = _committed(spark, sf_dir, (old.drop("updated_at"), THIRD, "first"))
    return _plain(snapshots.read_snapshot(spark, root, PRICE_LATEST))


@query(f"{SLICES_SQL} SELECT spid, strong, price, price_date, updated_on FROM state")
def slices_of_one_day(spark, sf_dir):
    """Six slices of one run, each a commit named by run and shard, are all kept."""
    old, new = state_and_batch(spark, sf_dir)
    root = work_dir(spark, "prices")
    commit_prices(old.drop("updated_at"), root, FIRST, "20240116", buckets=4)
    for shard in range(6):
        commit_prices(new.filter(F.col("spid") % 6 == shard), root, SECOND, f"20240201/{shard}", buckets=4)
    return _plain(snapshots.read_snapshot(spark, root, PRICE_LATEST))


@query(f"{SLICES_SQL} SELECT spid, strong, price, price_date, updated_on FROM state")
def writers_side_by_side(spark, sf_dir):
    """Four shards of a run commit to one table at the same time, each finding the others' commits on its way."""
    old, new = state_and_batch(spark, sf_dir)
    root = work_dir(spark, "prices")
    commit_prices(old.drop("updated_at"), root, FIRST, "20240116", buckets=4)
    with ThreadPoolExecutor(4) as pool:
        jobs = [pool.submit(commit_prices, new.filter(F.col("spid") % 4 == i), root, SECOND, f"20240201/{i}", 4) for i in range(4)]
        for job in jobs:
            job.result()
    return _plain(snapshots.read_snapshot(spark, root, PRICE_LATEST))


@query(f"""{SLICES_SQL}
SELECT 3 AS version, count(*) AS attempted, 0 AS "insert", 0 AS "update", count(*) AS skip, 0 AS new_parts FROM n
""")
def unchanged_commit(spark, sf_dir):
    """The newest batch once more under a new name: all rows are skipped and no data is written."""
    _, new = state_and_batch(spark, sf_dir)
    root = _committed(spark, sf_dir, (new, THIRD, "again"))
    written = sum(p.data_version == 3 for p in snapshots.manifest(spark, root))
    counts = snapshots.commit_counts(spark, root, 3)
    return counts.select(F.lit(3).alias("version"), "*", F.lit(written).alias("new_parts"))


@query(f"""{SLICES_SQL}
SELECT spid, strong, price, price_date, action FROM state WHERE action IN ('insert', 'update')
""")
def committed_changes(spark, sf_dir):
    """The rows that the newest commit inserted or updated, read back from the table."""
    moved = snapshots.read_changes(spark, _committed(spark, sf_dir), PRICE_LATEST, 2)
    return _plain(moved, ACTION).drop("updated_on")


# Price pages: one per order, with a series whose shape follows the order key.
# Some lack an anchor, have fewer values than labels, or are cut off.
SERIES_SQL = """
orders_p AS (
  SELECT o_orderkey AS spid, 1 + o_orderkey % 13 AS strong, 1 + o_orderkey % 6 AS n_times,
         CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 6 ELSE 1 + o_orderkey % 6 END AS n_values,
         CAST(floor(o_totalprice) AS BIGINT) AS base,
         o_orderkey % 29 = 0 AS no_anchor, o_orderkey % 31 = 0 AS cut_off
  FROM orders),
usable AS (
  SELECT *, least(n_times, CASE WHEN cut_off THEN greatest(n_values - 1, 0) ELSE n_values END) AS n_points
  FROM orders_p WHERE NOT no_anchor),
series AS (
  SELECT spid, strong, n_times, n_points, i, base + i * 1000 AS price,
         DATE '2024-06-01' - CAST(n_times - 1 - i AS INTEGER) AS price_date
  FROM (SELECT *, unnest(range(n_points)) AS i FROM usable))"""


def price_pages(spark, sf_dir) -> DataFrame:
    o = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    key = F.col("o_orderkey")
    n_times = key % 6 + 1
    n_values = F.when(key % 5 == 0, key % 6).otherwise(key % 6 + 1)
    base = F.floor("o_totalprice")

    def quoted(n, item):
        items = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit('"'), item(i - 1), F.lit('"')))
        return F.when(n > 0, F.array_join(items, ",")).otherwise("")

    tail = F.when(key % 31 == 0, "").otherwise('], "max":"9"};</script>')
    html = F.concat(
        F.lit('<script>var other = {"value":["1"]}; '),
        F.when(key % 29 == 0, "var json2").otherwise("var json1"),
        F.lit(' = {"time":['), quoted(n_times, lambda i: F.concat(F.lit("6."), (i + 1).cast("string"))),
        F.lit('], "value":['), quoted(n_values, lambda i: (base + i * 1000).cast("string")), tail,
    )
    url = F.concat(
        F.lit("https://cards.example.com/graph?spid="), key.cast("string"),
        F.lit("&n1Strong="), (key % 13 + 1).cast("string"), F.lit("#top"),
    )
    return o.select(key.alias("page_id"), url.alias("url"), html.alias("html"))


def _dated(df: DataFrame, date: str = "date") -> DataFrame:
    return df.select(
        "spid", F.col("strong").cast("int").alias("strong"),
        F.col(date).cast("string").alias("price_date"), "price",
    )


@query(f"WITH {SERIES_SQL} SELECT spid, strong, CAST(price_date AS VARCHAR) AS price_date, price FROM series")
def price_series_rows(spark, sf_dir):
    return _dated(price_series(price_pages(spark, sf_dir), F.lit(AS_OF)))


@query(f"""
WITH {SERIES_SQL}
SELECT spid, strong, CAST(price_date AS VARCHAR) AS price_date, price FROM series WHERE i >= n_points - 3
""")
def price_series_recent(spark, sf_dir):
    """Last three points; a shorter series comes back whole."""
    return _dated(price_series(price_pages(spark, sf_dir), F.lit(AS_OF), 3))


@query(f"""
WITH {SERIES_SQL}
SELECT spid, strong, CAST(price_date AS VARCHAR) AS price_date, price FROM series WHERE i = n_points - 1
""")
def page_price_batch(spark, sf_dir):
    """Price pages to one upsert row per pair; pages without a point are dropped."""
    return _dated(price_batch(price_pages(spark, sf_dir), F.lit(AS_OF)), "price_date")


@query(f"""
WITH {SERIES_SQL}
SELECT p.spid, p.strong, coalesce(u.n_times, 0) AS labels, coalesce(u.n_points, 0) AS points,
       coalesce(CAST(DATE '2024-06-01' - CAST(u.n_times - 1 AS INTEGER) AS VARCHAR), '') AS first_date,
       coalesce(u.base + (u.n_points - 1) * 1000, -1) AS last_price
FROM orders_p p LEFT JOIN (SELECT * FROM usable WHERE n_points > 0) u ON u.spid = p.spid
""")
def series_shape(spark, sf_dir):
    """Per page: labels paired, first date and last price, pages without points included."""
    pages = with_page_keys(price_pages(spark, sf_dir))
    found = F.size("pts") > 0
    days = F.datediff(F.date_sub(F.lit(AS_OF), 1), F.get("pts", F.lit(0))["date"]) + 1
    return with_series(pages, "html", F.date_sub(F.lit(AS_OF), 1), name="pts").select(
        "spid",
        F.col("strong").cast("int").alias("strong"),
        F.when(found, days).otherwise(0).cast("bigint").alias("labels"),
        F.size("pts").cast("bigint").alias("points"),
        F.when(found, F.get("pts", F.lit(0))["date"].cast("string")).otherwise("").alias("first_date"),
        F.when(found, latest_point(F.col("pts"))["price"]).otherwise(-1).alias("last_price"),
    )


@query("""
WITH k AS (SELECT c_custkey, 1 + c_custkey % 9 AS n, 1 + c_custkey % 7 AS m FROM customer),
r AS (SELECT *, unnest(range(least(n, m))) AS i, least(n, m) AS len FROM k)
SELECT c_custkey AS spid, CAST(DATE '2024-03-01' - CAST(n - 1 - i AS INTEGER) AS VARCHAR) AS price_date,
       c_custkey + i AS price
FROM r WHERE i >= len - 4
""")
def paired_series(spark, sf_dir):
    """Back-dating, pairing up to the shorter list and the last four points, on arrays."""
    key = F.col("c_custkey")
    n = (key % 9 + 1).cast("int")
    values = F.transform(F.sequence(F.lit(0), key % 7), lambda i: key + i)
    pts = recent(zip_points(back_date(n, F.lit(dt.date(2024, 3, 1))), values), 4)
    return table(spark, sf_dir, "customer").select(key.alias("spid"), F.inline(pts)).select(
        "spid", F.col("date").cast("string").alias("price_date"), "price"
    )


@query(f"""
WITH {SERIES_SQL},
k AS (SELECT o_orderkey AS spid, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders),
picked AS (SELECT spid FROM k WHERE pos < 900 AND pos % 3 = 1)
SELECT spid, strong, CAST(price_date AS VARCHAR) AS price_date, price
FROM series JOIN picked USING (spid) WHERE i = n_points - 1 AND strong IN (2, 3, 5)
""")
def price_job_work_list(spark, sf_dir):
    """Price pages of one shard's pairs merged into the table, everything else left out."""
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("spid"))
    work = work_list(keys, [2, 3, 5], limit=900, index=1, count=3)
    root = work_dir(spark, "prices")
    run_price_job(price_pages(spark, sf_dir), root, F.lit(AS_OF), SECOND, "20240602/1", work, buckets=4)
    return _dated(snapshots.read_snapshot(spark, root, PRICE_LATEST), "price_date")

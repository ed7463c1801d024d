"""Card pages and price pages to typed records."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from snapflow.functions import text as tx
from snapflow.functions.scalars import main_sub, names_of, series_end
from snapflow.functions.series import with_series
from snapflow.operators import page_text
from snapflow.schemas import RAW_CARD, STAT_COLUMNS
from snapflow.sources.readers import with_page_keys

# the parser travels with the task, so executors need no copy of this package
cloudpickle.register_pickle_by_value(page_text)


def raw_card(html: Column) -> Column:
    """Raw card record of a page, Arrow batch by Arrow batch."""

    record = StructType.fromDDL(RAW_CARD)
    arrow_type = to_arrow_type(record)
    card_text = page_text.card_text

    @F.arrow_udf(record)
    def parse(pages: pa.Array) -> pa.Array:
        return pa.array([card_text(p.as_py()) for p in pages], type=arrow_type)

    # keeps the optimizer from copying the parse into pushed-down filters
    return parse.asNondeterministic()(html)


def nfkc(c: Column) -> Column:
    """NFKC form, which no built-in function gives, for text that does not pass the page parser."""

    @F.arrow_udf("string")
    def normalize(values: pa.Array) -> pa.Array:
        return pa.array(
            [None if v is None else unicodedata.normalize("NFKC", v) for v in values.to_pylist()],
            pa.string(),
        )

    return normalize(c)


def map_labels(df: DataFrame, label: str, name: str = "stat") -> DataFrame:
    """Stat column of each label, null when unmapped.

    Row by row in Arrow batches: a join on distinct labels would send all rows
    of a frequent label to one task.
    """
    return df.withColumn(name, tx.stat_column(nfkc(F.col(label))))


def _reject_reason(raw: Column) -> Column:
    def no_digits(c: Column) -> Column:
        return (c != "") & tx.first_int(c).isNull()

    bad_rating = F.exists(raw["positions"], lambda p: p["value"].try_cast("int").isNull())
    return (
        F.when(raw.isNull(), "page unreadable")
        .when(F.coalesce(raw["name"], F.lit("")) == "", "name not found")
        .when(bad_rating, "bad rating")
        .when(F.size(raw["positions"]) == 0, "positions not found")
        .when(raw["pay"].isNotNull() & raw["pay"].try_cast("int").isNull(), "bad pay")
        .when(no_digits(raw["height"]), "bad height")
        .when(no_digits(raw["weight"]), "bad weight")
        .when(raw["image_without_src"], "image without src")
    )


def _team_colors(raw: Column) -> Column:
    def listed(items: Column, placeholder: str, kind: str) -> Column:
        kept = F.filter(items, lambda t: (t != "") & (t != placeholder))
        return F.transform(kept, lambda t: F.struct(t.alias("name"), F.lit(kind).alias("type")))

    return F.concat(
        listed(raw["clubs"], tx.CLUB_PLACEHOLDER, "club"),
        listed(raw["relations"], tx.RELATION_PLACEHOLDER, "relation"),
    )


def extract_cards(pages: DataFrame) -> DataFrame:
    """One typed record per card page; ``error`` tells why a page is rejected."""
    keyed = with_page_keys(pages)
    raw = F.col("_raw")
    mapped = F.filter(
        F.transform(
            raw["stats"],
            lambda s: F.struct(
                tx.stat_column(s["label"]).alias("stat"), tx.first_int(s["value"]).alias("value")
            ),
        ),
        lambda s: s["stat"].isNotNull() & s["value"].isNotNull(),
    )
    # reversed, so that the first hit is the last value printed for a label
    staged = (
        keyed.select("page_id", "spid", raw_card(F.col("html")).alias("_raw"))
        .withColumn("_stats", F.reverse(mapped))
        .withColumn("_names", F.transform("_stats", lambda s: s["stat"]))
        .withColumn("_foot", tx.foot(raw["foot"], raw["foot_strong"]))
    )
    main, subs = main_sub(raw["positions"])
    nation = raw["nation_name"]

    def stat(name: str) -> Column:
        return F.expr(
            f"try_element_at(_stats, cast(nullif(array_position(_names, '{name}'), 0) as int)).value AS {name}"
        )

    return staged.select(
        "page_id",
        "spid",
        raw["name"].alias("name"),
        tx.season_id(F.col("spid")).alias("season_id"),
        main["position"].alias("main_position"),
        main["value"].try_cast("int").alias("main_ovr"),
        names_of(subs).alias("sub_positions"),
        raw["pay"].try_cast("int").alias("pay"),
        tx.first_int(raw["height"]).alias("height"),
        tx.first_int(raw["weight"]).alias("weight"),
        raw["body_type"].alias("body_type"),
        tx.star_count(raw["skill"]).alias("skill_moves"),
        F.col("_foot.weak").alias("weak_foot"),
        F.col("_foot.side").alias("preferred_foot"),
        F.when(nation != "", tx.clean_nation(nation)).alias("nation_name"),
        raw["nation_image"].alias("nation_image"),
        raw["traits"].alias("traits"),
        _team_colors(raw).alias("team_colors"),
        *[stat(c) for c in STAT_COLUMNS],
        F.when(F.col("spid").isNull(), "no card key").otherwise(_reject_reason(raw)).alias("error"),
    )


def split_valid(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted records, and the rejected ones with their reason."""
    ok = F.col("error").isNull()
    return records.filter(ok).drop("error"), records.filter(~ok)


def _point_rows(pages: DataFrame, as_of: Column, n: int | None) -> DataFrame:
    """One row (page_id, spid, strong, date, price) per point.

    The outer generator matters: for an inner one, or for a filter on the
    points, the optimizer adds a size test that it pushes down to the scan, and
    every page would be parsed again for it.
    """
    points = with_series(with_page_keys(pages), "html", series_end(as_of), n)
    rows = points.select("page_id", "spid", "strong", F.inline_outer("points"))
    return rows.filter(F.col("date").isNotNull())


def price_series(pages: DataFrame, as_of: Column, n: int | None = None) -> DataFrame:
    """Price history rows (spid, strong, date, price) of price pages read on ``as_of``."""
    return _point_rows(pages, as_of, n).select("spid", "strong", "date", "price")


def latest_prices(pages: DataFrame, as_of: Column) -> DataFrame:
    """Latest point of each price page; pages without one are left out. No shuffle."""
    last = _point_rows(pages, as_of, 1).filter(F.col("price").isNotNull())
    return last.select("page_id", "spid", "strong", "price", F.col("date").alias("price_date"))

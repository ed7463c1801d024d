"""Daily series held as paired arrays: parsing, pairing, back-dating, latest point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Anchors around the series in a price page.
SERIES_ANCHOR = "var json1"
VALUE_ANCHOR = '"value"'

_POINTS = "array<struct<date: date, price: bigint>>"


def series_halves(html: Column) -> Column:
    """Text between the two anchors and text after the second; fewer items when one is missing."""
    return F.split(F.get(F.split(html, SERIES_ANCHOR, 2), F.lit(1)), VALUE_ANCHOR, 2)


def value_part(rest: Column) -> Column:
    """Up to the closing bracket.

    An unclosed list loses its last character, so a value whose closing quote
    ends the page is not read.
    """
    return F.when(F.contains(rest, F.lit("]")), F.substring_index(rest, "]", 1)).otherwise(
        F.left(rest, F.length(rest) - 1)
    )


def series_labels(part: Column) -> Column:
    """All quoted day labels, in order."""
    return F.regexp_extract_all(part, F.lit('"([0-9]+\\.[0-9]+)"'), F.lit(1))


def series_values(part: Column) -> Column:
    """All quoted integers as long, in order."""
    return F.regexp_extract_all(part, F.lit('"([0-9]+)"'), F.lit(1)).try_cast("array<bigint>")


def back_date(n: Column, end: Column) -> Column:
    """Dates of ``n`` points, counted back one day at a time from ``end``."""
    ages = F.when(n > 0, F.sequence(n - 1, F.lit(0))).otherwise(F.array().cast("array<int>"))
    return F.transform(ages, lambda k: F.date_sub(end, k))


def zip_points(dates: Column, values: Column) -> Column:
    """Pair by position and stop at the shorter list (``arrays_zip`` would pad with nulls)."""
    shorter = F.least(F.size(dates), F.size(values))
    return F.slice(F.arrays_zip(dates.alias("date"), values.alias("price")), F.lit(1), shorter)


def recent(points: Column, n: int | None) -> Column:
    """Last ``n`` points; all of them for 0 or None."""
    if not n:
        return points
    start = F.greatest(F.size(points) - n, F.lit(0)) + 1
    return F.slice(points, start, F.lit(n))


def latest_point(points: Column) -> Column:
    """Last point, null for an empty series."""
    return F.try_element_at(points, F.lit(-1))


def with_series(
    df: DataFrame, html: str, end: Column, n: int | None = None, name: str = "points"
) -> DataFrame:
    """Add the (date, price) points of each price page; empty when it holds no series.

    Built in steps, so that each regular expression runs once per page.
    """
    parts = df.withColumn("_halves", series_halves(F.col(html)))
    read = parts.withColumns({
        "_n": F.coalesce(F.size(series_labels(F.get("_halves", F.lit(0)))), F.lit(0)),
        "_values": series_values(value_part(F.get("_halves", F.lit(1)))),
    })
    dated = read.withColumn("_dates", back_date(F.col("_n"), end))
    paired = dated.withColumn(
        name, F.coalesce(zip_points(F.col("_dates"), F.col("_values")), F.array().cast(_POINTS))
    )
    return paired.withColumn(name, recent(F.col(name), n)).drop("_halves", "_n", "_values", "_dates")

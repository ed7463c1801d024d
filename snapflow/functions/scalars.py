"""Date, null, numeric and JSON helpers as Column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def batch_time(now: dt.datetime | Column, dtype: str = "timestamp") -> Column:
    """The batch time given by the caller; nothing reads the clock.

    A naive datetime is taken as UTC wall-clock time.
    """
    if isinstance(now, Column):
        return now.cast(dtype)
    if now.tzinfo is not None:
        now = now.astimezone(dt.timezone.utc).replace(tzinfo=None)
    naive = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    return naive if dtype == "timestamp_ntz" else from_naive_utc(naive)


def to_naive_utc(c: Column) -> Column:
    """Instant to UTC wall-clock time, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))


def from_naive_utc(c: Column) -> Column:
    """UTC wall-clock time to an instant, whatever the session zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), c).cast("timestamp")


def utc_text(c: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """An instant as UTC text, whatever the session zone."""
    return F.date_format(to_naive_utc(c), pattern)


def default_run_id(c: Column) -> Column:
    """UTC day of an instant as yyyyMMdd."""
    return utc_text(c, "yyyyMMdd")


def series_end(as_of: Column) -> Column:
    """A series ends the day before the day it is read."""
    return F.date_sub(as_of, 1)


def days_before(end: Column, days: Column | int) -> Column:
    return F.date_sub(end, days)


def is_distinct(a: Column, b: Column) -> Column:
    """Null-safe inequality."""
    return ~a.eqNullSafe(b)


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def or_empty(c: Column, dtype: str) -> Column:
    return F.coalesce(c, F.array().cast(dtype))


def rating_delta(new: Column, old: Column) -> Column:
    """new - old, and 0 when there is no old rating."""
    return F.coalesce(new - old, F.lit(0))


def to_json_list(items: Column) -> Column:
    return F.to_json(items, {"ignoreNullFields": "false"})


def json_rows(text: Column, dtype: str) -> Column:
    """JSON list to an array; null or unreadable text gives an empty one."""
    return or_empty(F.from_json(text, dtype), dtype)


def main_sub(positions: Column) -> tuple[Column, Column]:
    """First item and the rest."""
    return F.get(positions, F.lit(0)), F.slice(positions, F.lit(2), F.greatest(F.size(positions), F.lit(1)))


def names_of(positions: Column) -> Column:
    return F.transform(positions, lambda p: p["position"])

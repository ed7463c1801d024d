"""String functions as Column expressions. Digits are ASCII throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapflow.schemas import STAT_LABELS

# Suffixes and placeholders printed on the pages.
NATION_SUFFIX = ",?\\s*국가대표"
CLUB_PLACEHOLDER = "소속 팀컬러"
RELATION_PLACEHOLDER = "관계 팀컬러"
STAR = "★"

# (?U) makes \s cover no-break and ideographic spaces; 1C-1F are the separator
# controls that also count as whitespace when a string is stripped.
_SPACE = "[\\s\\x1C-\\x1F]"
_LABEL_NOISE = "(?U)[\\s\\x1C-\\x1F\\u00A0\\u200B\\u200C\\u200D]+"


def strip(c: Column) -> Column:
    """Remove surrounding Unicode whitespace (``trim`` removes spaces only)."""
    return F.regexp_replace(F.regexp_replace(c, f"(?U)^{_SPACE}+", ""), f"(?U){_SPACE}+$", "")


def clean_label(c: Column) -> Column:
    """Drop whitespace and zero-width characters of an NFKC-normalised label; null gives ''."""
    return F.coalesce(F.regexp_replace(c, _LABEL_NOISE, ""), F.lit(""))


def clean_nation(c: Column) -> Column:
    """Remove the national-team suffix wherever it stands, then strip."""
    return F.when(c == "", c).otherwise(strip(F.regexp_replace(c, f"(?U){NATION_SUFFIX}", "")))


def short_name(c: Column) -> Column:
    """Text before the last '(', else the whole text; null or empty gives ''."""
    head = F.nullif(strip(F.regexp_replace(c, "\\([^(]*$", "")), F.lit(""))
    return F.coalesce(head, strip(c), F.lit(""))


def first_int(c: Column) -> Column:
    """First run of digits as int; null when there is none."""
    return F.regexp_extract(c, "[0-9]+", 0).try_cast("int")


def star_count(c: Column) -> Column:
    """Number of stars; null for null or empty text."""
    return F.when(c != "", F.length(c) - F.length(F.replace(c, F.lit(STAR), F.lit(""))))


def foot(text: Column, strong_text: Column) -> Column:
    """struct(side, weak): side inside the emphasised element, rating of the other side.

    Both stay null without emphasis or without any rating; the last rating per
    side counts. The side is never inferred from the ratings.
    """
    pattern = "([LR])\\s*([0-9])"
    sides = F.regexp_extract_all(text, F.lit(f"(?U){pattern}"), F.lit(1))
    ratings = F.regexp_extract_all(text, F.lit(f"(?U){pattern}"), F.lit(2))
    marked = F.nullif(F.regexp_extract(strong_text, "(?U)^\\s*([LR])", 1), F.lit(""))
    side = F.when(F.size(sides) > 0, marked)
    other = F.when(side == "L", F.lit("R")).when(side == "R", F.lit("L"))
    pairs = F.filter(F.arrays_zip(sides.alias("s"), ratings.alias("r")), lambda p: p["s"] == other)
    weak = F.try_element_at(pairs, F.lit(-1))["r"].cast("int")
    return F.struct(side.alias("side"), weak.alias("weak"))


def truncate(c: Column, max_len: int) -> Column:
    """At most ``max_len`` characters; a cut text ends in an ellipsis."""
    return F.when(
        F.length(c) > max_len, F.concat(F.substring(c, 1, max_len - 1), F.lit("…"))
    ).otherwise(c)


def preview(items: Column, shown: int, total: Column, unit: str) -> Column:
    """First ``shown`` items, then how many more there are."""
    more = total - F.least(F.lit(shown), F.size(items))
    return F.concat(
        F.array_join(F.slice(items, 1, shown), ", "),
        F.when(more > 0, F.concat(F.lit(" 외 "), more.cast("string"), F.lit(unit))).otherwise(""),
    )


def last6(c: Column) -> Column:
    return F.right(c, F.lit(6))


def card_label(abbr: Column, name: Column) -> Column:
    return strip(F.concat(F.coalesce(abbr, F.lit("")), F.lit(" "), F.coalesce(name, F.lit(""))))


def stat_column(label: Column) -> Column:
    """Column name of a stat label, null when the label is not mapped."""
    pairs = [F.lit(x) for raw, col in STAT_LABELS.items() for x in (raw.replace(" ", ""), col)]
    return F.try_element_at(F.create_map(*pairs), clean_label(label))


def season_id(spid: Column) -> Column:
    """First three digits of the card key."""
    return F.substring(spid.cast("string"), 1, 3).cast("int")


def page_key(url: Column, param: str, dtype: str = "bigint") -> Column:
    """Typed value of a query parameter of the page address; null when absent or malformed."""
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(param)).try_cast(dtype)

"""Content hash of a card record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapflow.schemas import STAT_COLUMNS

# The fields that make up a card's content, besides its stats.
HASHED_FIELDS = [
    "body_type", "height", "main_ovr", "main_position", "name", "nation_id", "pay",
    "preferred_foot", "season_id", "skill_moves", "sub_positions", "team_color_ids",
    "trait_ids", "weak_foot", "weight",
]


def content_json(stats: list[str] | None = None, by_name: bool = False) -> Column:
    """Compact JSON with sorted keys over the card's content columns.

    Id lists are sorted, sub-positions keep page order, missing stats appear as
    null. ``by_name`` hashes member names instead of assigned ids, which makes
    the hash independent of how ids were handed out.
    """
    source = {"nation_id": "nation_name", "trait_ids": "trait_names",
              "team_color_ids": "team_color_names"} if by_name else {}

    def value(field: str) -> Column:
        c = F.col(source.get(field, field))
        return F.sort_array(c) if field in ("trait_ids", "team_color_ids") else c

    fields = {f: value(f) for f in HASHED_FIELDS}
    fields["stats"] = F.struct(*[F.col(s) for s in sorted(stats or STAT_COLUMNS)])
    return F.to_json(
        F.struct(*[fields[f].alias(f) for f in sorted(fields)]), {"ignoreNullFields": "false"}
    )


def content_hash(stats: list[str] | None = None, by_name: bool = False) -> Column:
    return F.sha2(content_json(stats, by_name), 256)

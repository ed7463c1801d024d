"""Fixed schemas of the inputs and the maintained tables."""

from __future__ import annotations

# Stat label as printed on a card page -> column name.
STAT_LABELS = {
    "속력": "pace",
    "가속력": "acceleration",
    "골 결정력": "finishing",
    "슛 파워": "shot_power",
    "중거리 슛": "long_shot",
    "위치 선정": "positioning",
    "발리슛": "volley",
    "페널티 킥": "penalty_kick",
    "짧은 패스": "short_pass",
    "시야": "vision",
    "크로스": "crossing",
    "긴 패스": "long_pass",
    "프리킥": "free_kick",
    "커브": "curve",
    "드리블": "dribble",
    "볼 컨트롤": "ball_control",
    "민첩성": "agility",
    "밸런스": "balance",
    "반응 속도": "reactions",
    "대인 수비": "marking",
    "태클": "tackle",
    "가로채기": "interception",
    "슬라이딩 태클": "sliding_tackle",
    "헤더": "heading",
    "몸싸움": "strength",
    "스태미너": "stamina",
    "적극성": "aggression",
    "점프": "jumping",
    "침착성": "composure",
    "GK 다이빙": "gk_diving",
    "GK 핸들링": "gk_handling",
    "GK 킥": "gk_kick",
    "GK 반응속도": "gk_reflexes",
    "GK 위치 선정": "gk_positioning",
}

STAT_COLUMNS = sorted(STAT_LABELS.values())
_STATS_DDL = ", ".join(f"{c} int" for c in STAT_COLUMNS)

PAGES = "page_id bigint, url string, html string"
CARD_CATALOGUE = "id bigint, name string"
SEASON_CATALOGUE = "seasonId int, className string, seasonImg string"

PRICE_LATEST = (
    "spid bigint not null, strong smallint not null, price bigint not null, "
    "price_date date, updated_at timestamp"
)
SPID = "spid bigint, name string, crawled boolean, crawled_at timestamp"
SEASON = "season_id int, class_name string, season_img string"
NATIONS = "id int, name string, image_url string"
TRAITS = "id int, name string, image_url string"
TEAM_COLORS = "id int, name string, team_color_type string"

PLAYERS = (
    "id bigint, spid bigint, name string, season_id int, nation_id int, main_position string, "
    "sub_positions array<string>, main_ovr int, pay int, height int, weight int, "
    "body_type string, skill_moves int, weak_foot int, preferred_foot string, "
    "trait_ids array<smallint>, team_color_ids array<smallint>, content_hash string, "
    f"{_STATS_DDL}, created_at timestamp_ntz, updated_at timestamp_ntz, "
    "ovr_change int, ovr_changed_at timestamp_ntz"
)

LOG_TRAITS = "array<struct<id: bigint, name: string>>"
LOG_SEASONS = "array<struct<season_id: int, class_name: string>>"
LOG_SPIDS = "array<bigint>"
RUN_LOG = (
    "run_id string, phase string, shard int, new_players bigint, changed bigint, "
    "failures bigint, new_traits string, new_seasons string, new_spids string, "
    "created_at timestamp, seq int"
)

# What the page parser hands to Spark: raw text only, typed by column expressions.
RAW_CARD = (
    "name string, positions array<struct<position: string, value: string>>, pay string, "
    "height string, weight string, body_type string, skill string, foot string, "
    "foot_strong string, nation_name string, nation_image string, "
    "traits array<struct<name: string, image_url: string>>, clubs array<string>, "
    "relations array<string>, stats array<struct<label: string, value: string>>, "
    "image_without_src boolean"
)

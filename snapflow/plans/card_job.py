"""Card job: landed card pages to dimension members, changed cards and log rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapflow.functions.hashing import content_hash
from snapflow.operators.dims import created_members, next_ids, resolve_ids
from snapflow.operators.extract import extract_cards, split_valid
from snapflow.operators.runlog import crawl_log, shard_counts
from snapflow.operators.shard import with_shard
from snapflow.operators.upsert import ACTION, KEEP, apply_card_changes, mark_done
from snapflow.schemas import PLAYERS, STAT_COLUMNS
from snapflow.session import cut
from snapflow.sources import snapshots
from snapflow.sources.readers import for_keys, with_page_keys

NATION, TRAIT, TEAM_COLOR = DIMENSIONS = ("nation", "trait", "team_color")


@dataclass
class CardRun:
    players: DataFrame   # state after the run, with the action per card
    members: DataFrame   # dimension members after the run
    rejects: DataFrame   # pages without a usable card, with the reason
    spid: DataFrame      # catalogue with processed cards marked done
    log: DataFrame       # one row per shard
    landed: DataFrame    # the landed cards only, with the action per card
    created: DataFrame   # the members that the run added


def as_members(nations: DataFrame, traits: DataFrame, team_colors: DataFrame) -> DataFrame:
    """The three dimensions as one table (dim, id, name, attribute), ids apart per dimension."""

    def tag(df: DataFrame, dim: str, attribute: str) -> DataFrame:
        return df.select(
            F.lit(dim).alias("dim"), "id", "name", F.col(attribute).alias("attribute")
        )

    return (
        tag(nations, NATION, "image_url")
        .unionByName(tag(traits, TRAIT, "image_url"))
        .unionByName(tag(team_colors, TEAM_COLOR, "team_color_type"))
    )


def dimension(members: DataFrame, dim: str) -> DataFrame:
    """One dimension in its own layout."""
    attribute = "team_color_type" if dim == TEAM_COLOR else "image_url"
    return members.filter(F.col("dim") == dim).select(
        "id", "name", F.col("attribute").alias(attribute)
    )


def member_candidates(cards: DataFrame) -> DataFrame:
    """Names met on the cards: dimension, attribute and place (page, position).

    A team colour is known by its name only; its kind is an attribute.
    """

    def listed(items: str, dim: str, attribute: str) -> Column:
        return F.transform(
            items,
            lambda m, i: F.struct(
                F.lit(dim).alias("dim"), m["name"].alias("name"),
                m[attribute].alias("attribute"), i.alias("pos"),
            ),
        )

    nation = F.array_compact(F.array(F.when(
        F.col("nation_name").isNotNull(),
        F.struct(
            F.lit(NATION).alias("dim"), F.col("nation_name").alias("name"),
            F.col("nation_image").alias("attribute"), F.lit(0).alias("pos"),
        ),
    )))
    met = F.concat(
        nation, listed("traits", TRAIT, "image_url"), listed("team_colors", TEAM_COLOR, "type")
    )
    return cards.select("page_id", F.inline(met))


def names_of_members(cards: DataFrame) -> DataFrame:
    """Cards with the names of their traits and team colours as lists."""
    return cards.withColumns({
        "trait_names": F.transform("traits", lambda t: t["name"]),
        "team_color_names": F.transform("team_colors", lambda t: t["name"]),
    })


def with_ids(cards: DataFrame, members: DataFrame) -> DataFrame:
    """Cards with their dimension ids, in page order.

    All names travel in one join; the cards are joined back on the key the
    later change detection needs anyway.
    """
    lists = names_of_members(cards).withColumn("nations", F.array_compact(F.array("nation_name")))
    ids = resolve_ids(
        lists.select("spid", "nations", "trait_names", "team_color_names"),
        "spid",
        {
            "_nation": ("nations", NATION),
            "trait_ids": ("trait_names", TRAIT),
            "team_color_ids": ("team_color_names", TEAM_COLOR),
        },
        members,
    )
    return (
        cards.join(ids, "spid")
        .withColumn("nation_id", F.try_element_at("_nation", F.lit(1)))
        .withColumn("trait_ids", F.col("trait_ids").cast("array<smallint>"))
        .withColumn("team_color_ids", F.col("team_color_ids").cast("array<smallint>"))
        .drop("_nation")
    )


def hashed_cards(cards: DataFrame, by_name: bool = False) -> DataFrame:
    """Cards in the layout of the players table, with their content hash."""
    hashed = names_of_members(cards).withColumn("content_hash", content_hash(by_name=by_name))
    return hashed.select(
        "spid", "name", "season_id", "nation_id", "main_position", "sub_positions", "main_ovr",
        "pay", "height", "weight", "body_type", "skill_moves", "weak_foot", "preferred_foot",
        "trait_ids", "team_color_ids", "content_hash", *STAT_COLUMNS,
    )


def with_surrogate_ids(cards: DataFrame, players: DataFrame, highest: int | None = None) -> DataFrame:
    """Ids for cards the table does not hold, in key order after the highest id in use, which
    is looked up unless given; then ``players`` need hold the landed cards only."""
    used = players if highest is None else cards.sparkSession.createDataFrame([(highest,)], "id bigint")
    new = cards.select("spid").join(players.select("spid"), "spid", "left_anti")
    return cards.join(next_ids(new, used, "spid", id_type="bigint"), "spid", "left")


def commit_cards(
    cards: DataFrame, root: str, now, buckets: int = 64, commit_id: str | None = None
) -> int:
    """Write hashed cards to the card snapshot under ``root``; only the buckets of these
    cards are read and rewritten, so a run over few new cards stays small."""
    return snapshots.commit(
        cards, root, PLAYERS, ["spid"],
        lambda state, batch, keys: apply_card_changes(state, batch, now, keys),
        buckets, commit_id,
    )


def card_records(pages: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """Records of the landed pages; with targets, of those cards only, and a reject
    for each target without a page."""
    if targets is None:
        return extract_cards(pages)
    keyed = with_page_keys(pages)
    records = extract_cards(keyed.join(targets.select("spid"), "spid", "left_semi"))
    missing = targets.select("spid").join(keyed.select("spid"), "spid", "left_anti")
    return records.unionByName(
        missing.withColumn("error", F.lit("no page")), allowMissingColumns=True
    )


def _apart(df: DataFrame) -> DataFrame:
    """``df`` with a column that tells rows without a card key apart, so that each is a group of its own."""
    return df.withColumn("_alone", F.when(F.col("spid").isNull(), F.monotonically_increasing_id()))


def last_pages(pages: DataFrame) -> DataFrame:
    """The pages that can be the last of their card, by page id, each once: what another page replaces is not parsed.

    Pages of one card and page id stay if they differ. Pages without a card key all stay.
    """
    last = Window.partitionBy("spid", "_alone").orderBy(F.desc_nulls_last("page_id"))
    same = Window.partitionBy("spid", "_alone", "page_id", "html").orderBy("url")
    newest = _apart(with_page_keys(pages)).withColumn("_n", F.rank().over(last)).filter("_n = 1")
    once = newest.withColumn("_n", F.row_number().over(same)).filter("_n = 1")
    return once.select(*pages.columns)


def one_per_card(records: DataFrame) -> DataFrame:
    """The last landed record of each card, by page id; records without a card key are all kept. The records are read once."""
    last = Window.partitionBy("spid", "_alone").orderBy(F.desc_nulls_last("page_id"), F.xxhash64("name", "error", "main_ovr"))
    return _apart(records).withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n", "_alone")


def parse_cards(pages: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """The record of each landed card, parsed once: it feeds the dimensions, the write and the log."""
    return cut(one_per_card(card_records(last_pages(pages), targets)))


def run_card_job(
    pages: DataFrame,
    players: DataFrame,
    spid: DataFrame,
    members: DataFrame,
    run_id: str,
    now,
    shards: int = 1,
    targets: DataFrame | None = None,
) -> CardRun:
    """One run over the landed pages of the target cards.

    Of several pages of a card the last counts. A bad page becomes a reject and its
    card stays undone; all others are marked done whether they changed or not. A page
    without a card key is a failure of shard 0 and has no place in the shard order.
    Only known cards among the landed ones are read and compared; the others stay as
    they are.
    """
    return apply_cards(parse_cards(pages, targets), players, spid, members, run_id, now, shards)


def apply_cards(
    records: DataFrame,
    players: DataFrame,
    spid: DataFrame,
    members: DataFrame,
    run_id: str,
    now,
    shards: int = 1,
    shard: int | None = None,
    highest: int | None = None,
) -> CardRun:
    """Parsed cards against the tables. ``shard`` says that all of them are one shard's, so
    that only its log row is made; with the ``highest`` id in use, ``players`` need hold the landed cards only."""
    valid, rejects = split_valid(records)
    keys = records.select("spid").filter(F.col("spid").isNotNull()).distinct()
    shard_of = with_shard(keys, "spid", shards) if shard is None else keys.withColumn("shard", F.lit(shard))

    created = created_members(
        members, member_candidates(valid), ["attribute"], ["page_id", "pos"],
        by="dim", spaces=DIMENSIONS,
    )
    grown = members.unionByName(created)
    cards = with_surrogate_ids(hashed_cards(with_ids(valid, grown)), players, highest)
    landed = cut(apply_card_changes(for_keys(players, valid), cards, now))
    others = players.join(landed.select("spid"), "spid", "left_anti").withColumn(ACTION, F.lit(KEEP))

    # one row per shard and name before the join, however many cards share a trait
    used = (
        valid.join(shard_of, "spid")
        .select("shard", F.explode(F.transform("traits", lambda t: t["name"])).alias("name"))
        .distinct()
    )
    by_shard = used.join(dimension(created, TRAIT), "name").select("shard", "id", "name")

    failed = rejects.join(shard_of, "spid", "left").withColumn("shard", F.coalesce("shard", F.lit(shard or 0)))
    counts = shard_counts(landed.join(shard_of, "spid"), failed)
    log = crawl_log(counts, by_shard, run_id, now, shards if shard is None else shard + 1)
    return CardRun(
        players=landed.unionByName(others),
        members=grown,
        rejects=rejects,
        spid=mark_done(spid, valid.select("spid"), now),
        log=log if shard is None else log.filter(F.col("shard") == shard),
        landed=landed,
        created=created,
    )

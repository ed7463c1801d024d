"""Run report: summaries, top cards and summary text, for all logged runs at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.functions import text as tx
from snapflow.functions.scalars import or_empty, or_zero
from snapflow.operators.latest import top_cards, top_cards_per_run, top_per_group
from snapflow.operators.runlog import (
    logged_seasons,
    logged_spids,
    logged_traits,
    run_since,
    run_totals,
)
from snapflow.operators.shard import ordinal
from snapflow.session import cut
from snapflow.sources.readers import for_keys

TRAITS_SHOWN, SEASONS_SHOWN = 5, 3  # fixed values
SHORT_FORM = 196                    # fixed value: length of the short message


def with_season(cards: DataFrame, seasons: DataFrame) -> DataFrame:
    """Cards with their season's class name, null for an unknown season."""
    return cards.join(seasons.select("season_id", "class_name"), "season_id", "left")


def _labelled(cards: DataFrame, seasons: DataFrame) -> DataFrame:
    return with_season(cards, seasons).withColumn(
        "label", tx.card_label(tx.short_name(F.col("class_name")), F.col("name"))
    )


def changed_since(players: DataFrame, since: Column) -> DataFrame:
    """Cards known before ``since`` and written at or after it (naive UTC)."""
    return players.filter((F.col("updated_at") >= since) & (F.col("created_at") < since))


def top_new(players: DataFrame, seasons: DataFrame, new_spids: DataFrame, n: int) -> DataFrame:
    """Best new cards of one run; keys without a card drop out."""
    return _labelled(top_cards(for_keys(players, new_spids), n), seasons)


def top_changed(players: DataFrame, seasons: DataFrame, log: DataFrame, n: int) -> DataFrame:
    """Best changed cards of the one run in ``log``; none without a changed card."""
    since = run_since(log).select("since").scalar()
    changed = log.filter(F.col("phase") == "crawl").agg(F.sum("changed")).scalar()
    return _labelled(top_cards(changed_since(players, since).filter(changed > 0), n), seasons)


def changed_in_runs(players: DataFrame, log: DataFrame) -> DataFrame:
    """(run_id, card) for each card the run changed, all runs at once.

    A card belongs to the last run started at or before its write. The runs are
    spread over the hours they cover, so the match is an equi-join on the hour,
    with few candidates per card, and not a range join. A full run writes all
    its cards within an hour, so cards of one hour are salted over several tasks
    and the few run rows repeated for each.
    """
    salts = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = ordinal(run_since(log), "since", "run_id", name="n")
    following = runs.select((F.col("n") - 1).alias("n"), F.col("since").alias("until"))
    last_write = players.agg(F.max("updated_at")).scalar()
    windows = (
        runs.join(following, "n", "left")
        .withColumn("end", F.coalesce("until", F.greatest(last_write, F.col("since"))))
        .select(
            "run_id", "since", "until",
            F.explode(F.expr(
                "sequence(date_trunc('HOUR', since), date_trunc('HOUR', end), interval 1 hour)"
            )).alias("hour"),
        )
        .withColumn("hour", F.col("hour").cast("timestamp_ntz"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    cards = players.withColumn(
        "hour", F.date_trunc("HOUR", "updated_at").cast("timestamp_ntz")
    ).withColumn("salt", F.pmod(F.xxhash64("spid"), F.lit(salts)).cast("int"))
    inside = (
        (F.col("updated_at") >= F.col("since"))
        & (F.col("until").isNull() | (F.col("updated_at") < F.col("until")))
        & (F.col("created_at") < F.col("since"))
    )
    matched = cards.join(windows, ["hour", "salt"]).filter(inside)
    return matched.drop("hour", "salt", "until", "since")


def _top_labels(cards: DataFrame, seasons: DataFrame, n: int, name: str) -> DataFrame:
    """Labels of each run's first n cards, best first."""
    narrow = cards.select("run_id", "spid", "name", "season_id", "main_ovr")
    best = _labelled(top_cards_per_run(narrow, n), seasons)
    return _in_order(best, F.col("rank"), F.col("label"), name)


def _in_order(rows: DataFrame, place: Column, item: Column, name: str) -> DataFrame:
    pairs = F.sort_array(F.collect_list(F.struct(place.alias("at"), item.alias("item"))))
    return rows.groupBy("run_id").agg(F.transform(pairs, lambda p: p["item"]).alias(name))


def _first_names(rows: DataFrame, at: str, name: Column, n: int, count: str, shown: str) -> DataFrame:
    """Per run, how many rows there are and the names of the first n."""
    rows = cut(rows)  # the lists are parsed once for both
    counts = rows.groupBy("run_id").agg(F.count(F.lit(1)).alias(count))
    first = top_per_group(rows.withColumn("_name", name), ["run_id"], [F.asc(at)], n, tie=at)
    return counts.join(_in_order(first, F.col("rank"), F.col("_name"), shown), "run_id", "left")


def run_summary(
    log: DataFrame,
    players: DataFrame,
    seasons: DataFrame,
    order: list[str],
    expected: int = 4,
    top_n: int = 5,
) -> DataFrame:
    """One row per run: totals, list sizes and previews.

    ``order`` names the log columns that put its rows in sequence.
    """
    traits = _first_names(
        logged_traits(log, order), "first_at", F.col("name"), TRAITS_SHOWN, "new_traits", "trait_names"
    )
    seasons_new = _first_names(
        logged_seasons(log, order), "at", F.coalesce("class_name", F.lit("?")), SEASONS_SHOWN,
        "new_seasons", "season_names",
    )
    spids = cut(logged_spids(log))
    spid_counts = spids.groupBy("run_id").agg(F.count(F.lit(1)).alias("new_spid_count"))
    fresh = spids.distinct().join(
        players.select("spid", "name", "season_id", "main_ovr"), "spid"
    )
    totals = run_totals(log, expected)
    changed = changed_in_runs(players, log)
    joined = totals
    for part in (
        traits,
        seasons_new,
        spid_counts,
        _top_labels(fresh, seasons, top_n, "top_new"),
        _top_labels(changed, seasons, top_n, "_top_changed"),
    ):
        joined = joined.join(part, "run_id", "left")
    text_list = "array<string>"
    return joined.select(
        "run_id", "new_players", or_zero(F.col("new_spid_count")).alias("new_spid_count"),
        "changed", "failures",
        or_zero(F.col("new_traits")).alias("new_traits"),
        or_zero(F.col("new_seasons")).alias("new_seasons"),
        *[or_empty(F.col(c), text_list).alias(c) for c in ("trait_names", "season_names", "top_new")],
        or_empty(F.when(F.col("changed") > 0, F.col("_top_changed")), text_list).alias("top_changed"),
        "shards_logged", "shards_expected", "missing_shards",
    )


def run_flags(summary: DataFrame) -> DataFrame:
    """Alert flags: missing shards, failures, and a run in which nothing happened."""
    counts = ("new_players", "changed", "new_traits", "new_seasons", "failures", "missing_shards")
    quiet = F.lit(True)
    for c in counts:
        quiet = quiet & (F.col(c) == 0)
    return (
        summary.withColumn("shards_missing", F.col("missing_shards") > 0)
        .withColumn("has_failures", F.col("failures") > 0)
        .withColumn("nothing_happened", quiet)
    )


def run_message(
    summary: DataFrame, label: str = "메타 크롤", title: str = "", max_len: int | None = None
) -> DataFrame:
    """Summary text per run: alerts, counts, then previews, cut at ``max_len``."""
    flagged = run_flags(summary)

    def text(*parts: str | Column) -> Column:
        return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])

    def listed(c: str) -> Column:
        return F.size(c) > 0

    col = F.col
    head = f"[{title} {label} #" if title else f"[{label} #"
    # The wording and order of the report lines.
    lines = F.array(
        text(head, tx.last6(col("run_id")), "]"),
        F.when(
            col("shards_missing"),
            text("⚠️ 샤드 누락 ", col("missing_shards"), "/", col("shards_expected"), " (잡 실패 의심)"),
        ),
        F.when(col("has_failures"), text("🔴 크롤 실패 ", col("failures"), "건")),
        text("🟢 신규선수 ", col("new_players"), "  🔵 변동 ", col("changed"), "장"),
        text("🟡 신규특성 ", col("new_traits"), "  🟣 신규시즌 ", col("new_seasons")),
        F.when(
            listed("trait_names"),
            text("• 특성: ", tx.preview(col("trait_names"), TRAITS_SHOWN, col("new_traits"), "개")),
        ),
        F.when(
            listed("season_names"),
            text("• 시즌: ", tx.preview(col("season_names"), SEASONS_SHOWN, col("new_seasons"), "개")),
        ),
        F.when(
            listed("top_new"),
            text("• 신규: ", tx.preview(col("top_new"), 1 << 30, col("new_spid_count"), "명")),
        ),
        F.when(
            listed("top_changed"),
            text("• 변동: ", tx.preview(col("top_changed"), 1 << 30, col("changed"), "장")),
        ),
        F.when(col("nothing_happened"), F.lit("변동 없음 (정상 동작)")),
    )
    message = F.array_join(F.array_compact(lines), "\n")
    if max_len is not None:
        message = tx.truncate(message, max_len)
    return flagged.select("run_id", message.alias("message"))

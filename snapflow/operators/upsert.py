"""Change-aware upsert of a keyed batch into a keyed state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.functions.scalars import batch_time, is_distinct, rating_delta

ACTION = "action"
INSERT, UPDATE, SKIP, KEEP = "insert", "update", "skip", "keep"
WRITTEN = (INSERT, UPDATE)

Value = Column | Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def _old(name: str) -> Column:
    return F.col(f"_old_{name}")


def _new(name: str) -> Column:
    return F.col(f"_new_{name}")


def _side(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    # the literal marks presence: a null value does not mean a missing row
    rest = [f"`{c}` AS `{prefix}{c}`" for c in df.columns if c not in keys]
    return df.selectExpr(*keys, *rest, f"true AS `{prefix}_here`")


def _match(state: DataFrame, batch: DataFrame, keys: list[str], compare: list[str], how: str) -> DataFrame:
    differs = F.lit(False)
    for c in compare:
        differs = differs | is_distinct(_old(c), _new(c))
    action = (
        F.when(F.col("_new__here").isNull(), KEEP)
        .when(F.col("_old__here").isNull(), INSERT)
        .when(differs, UPDATE)
        .otherwise(SKIP)
    )
    joined = _side(state, keys, "_old_").join(_side(batch, keys, "_new_"), keys, how)
    return joined.withColumn(ACTION, action)


def classify(state: DataFrame, batch: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """Action per batch key (insert, update, skip); only keys and ``compare`` are read."""
    cols = [*keys, *compare]
    matched = _match(state.select(cols), batch.select(cols), keys, compare, "right")
    return matched.select(*keys, ACTION)


def upsert(
    state: DataFrame,
    batch: DataFrame,
    keys: list[str],
    compare: list[str],
    *,
    on_insert: dict[str, Value] | None = None,
    on_update: dict[str, Value] | None = None,
    write: list[str] | None = None,
) -> DataFrame:
    """State after the batch, one row per key, with the action taken.

    A key of the batch is inserted when absent, updated when any ``compare``
    column differs (nulls are values), and otherwise left untouched with all its
    old columns. ``write`` names the batch columns taken over (default: all).
    ``on_insert`` / ``on_update`` set further columns, from a Column or from a
    function of accessors to the old and the new row.

    Both sides are unique per key, so the one full outer join has no hot key.
    """
    on_insert, on_update = on_insert or {}, on_update or {}
    write = [c for c in batch.columns if c not in keys] if write is None else write

    def resolve(v: Value) -> Column:
        return v if isinstance(v, Column) else v(_old, _new)

    def column(name: str) -> Column | str:
        kept, taken = f"`_old_{name}`", f"`_new_{name}`"
        dtype = types[name].simpleString()
        if name not in on_insert and name not in on_update:
            if name not in write:
                return f"{kept} AS `{name}`"
            return f"CAST(IF({ACTION} IN ('{INSERT}', '{UPDATE}'), {taken}, {kept}) AS {dtype}) AS `{name}`"
        inserted = on_insert.get(name, _new(name) if name in write else F.lit(None))
        updated = on_update.get(name, _new(name) if name in write else _old(name))
        return (
            F.when(F.col(ACTION) == INSERT, resolve(inserted))
            .when(F.col(ACTION) == UPDATE, resolve(updated))
            .otherwise(_old(name))
            .cast(types[name])
            .alias(name)
        )

    types = {f.name: f.dataType for f in state.schema}
    matched = _match(state, batch, keys, compare, "full_outer")
    built = [c if c in keys else column(c) for c in types]
    return matched.select(*[F.expr(c) if isinstance(c, str) else c for c in built], ACTION)


def new_state(merged: DataFrame) -> DataFrame:
    return merged.drop(ACTION)


def changes(merged: DataFrame) -> DataFrame:
    """Only the rows an upsert writes."""
    return merged.filter(F.col(ACTION).isin(*WRITTEN))


def load_counts(merged: DataFrame) -> DataFrame:
    """Rows per action, and the rows attempted: all of the batch, written or not."""
    return merged.filter(F.col(ACTION) != KEEP).agg(
        F.count(F.lit(1)).alias("attempted"),
        *[F.count_if(F.col(ACTION) == a).alias(a) for a in (INSERT, UPDATE, SKIP)],
    )


def upsert_latest(
    state: DataFrame, batch: DataFrame, now, keys: list[str] | None = None
) -> DataFrame:
    """Latest price per (spid, strong).

    Price, date and stamp change only when the price differs, so both dates mean
    "last change": the same price on a newer date leaves the row untouched.
    """
    keys = keys or ["spid", "strong"]
    stamp = {"updated_at": batch_time(now)}
    priced = batch.filter(F.col("price").isNotNull()).select(*keys, "price", "price_date")
    return upsert(state, priced, keys, ["price"], on_insert=stamp, on_update=stamp)


def upsert_catalogue(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Card catalogue: new keys start undone, a rename changes the name only."""
    return upsert(
        state, batch.select("spid", "name"), ["spid"], ["name"], on_insert={"crawled": F.lit(False)}
    )


def upsert_seasons(state: DataFrame, batch: DataFrame) -> DataFrame:
    return upsert(state, batch, ["season_id"], ["class_name", "season_img"])


def apply_card_changes(
    players: DataFrame, cards: DataFrame, now, keys: list[str] | None = None
) -> DataFrame:
    """Write cards whose content hash is new or differs.

    A rating change is recorded only on an update with a known old rating and a
    non-zero difference; otherwise the two rating columns keep their values.
    """
    keys = keys or ["spid"]
    at = batch_time(now, "timestamp_ntz")
    # a surrogate id is given once
    on_insert = {"created_at": at, "updated_at": at}
    if "id" in cards.columns:
        on_insert["id"] = lambda old, new: new("id")

    def moved(value):
        return lambda old, new: F.when(
            rating_delta(new("main_ovr"), old("main_ovr")) != 0, value(old, new)
        )

    def or_old(name, value):
        return lambda old, new: F.coalesce(moved(value)(old, new), old(name))

    return upsert(
        players,
        cards,
        keys,
        ["content_hash"],
        on_insert=on_insert,
        write=[c for c in cards.columns if c not in keys and c != "id"],
        on_update={
            "updated_at": at,
            "ovr_change": or_old("ovr_change", lambda o, n: rating_delta(n("main_ovr"), o("main_ovr"))),
            "ovr_changed_at": or_old("ovr_changed_at", lambda o, n: at),
        },
    )


def mark_done(spid: DataFrame, ok_keys: DataFrame, now) -> DataFrame:
    """Set crawled and its time for processed keys, changed or not; others stay as they are."""
    done = ok_keys.select("spid").distinct().withColumn("_done", F.lit(True))
    hit = F.col("_done").isNotNull()
    return spid.join(done, "spid", "left").select(
        *[
            F.when(hit, F.lit(True)).otherwise(F.col(c)).alias(c) if c == "crawled"
            else F.when(hit, batch_time(now, dict(spid.dtypes)[c])).otherwise(F.col(c)).alias(c) if c == "crawled_at"
            else F.col(c)
            for c in spid.columns
        ]
    )

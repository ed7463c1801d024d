"""Name dimensions: get-or-create, id resolution, new members."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.operators.shard import ordinal


def first_seen(
    candidates: DataFrame, attrs: list[str], order: list[str], by: list[str] | None = None
) -> DataFrame:
    """One row per name with the attributes of its first occurrence.

    Partial aggregation keeps one row per name and task, so a name on every
    third page costs no more than a rare one.
    """
    seen = F.struct(*order)
    return candidates.groupBy(*(by or []), "name").agg(
        F.min(seen).alias("_seen"), *[F.min_by(a, seen).alias(a) for a in attrs]
    )


def next_ids(
    rows: DataFrame,
    existing: DataFrame,
    *order: str,
    by: str | None = None,
    spaces: tuple[str, ...] = (),
    id_type: str = "int",
) -> DataFrame:
    """Number new rows from the highest existing id on, in the order of ``order``.

    With ``by``, each of the values ``spaces`` of that column has its own ids;
    rows with any other value are not numbered and left out.
    """
    highest = F.coalesce(F.max("id"), F.lit(0)).cast("bigint")
    if by is None:
        numbered = ordinal(rows, *order, name="_pos")
        new_id = existing.agg(highest).scalar() + F.col("_pos") + 1
        return numbered.withColumn("id", new_id.cast(id_type)).drop("_pos")
    numbered = ordinal(rows.filter(F.col(by).isin(*spaces)), by, *order, name="_pos")
    # one row per space, so safe to broadcast; a join on so few keys would put
    # every row of a space into one task
    starts = numbered.groupBy(by).agg(F.min("_pos").alias("_start"))
    tops = existing.filter(F.col(by).isin(*spaces)).groupBy(by).agg(highest.alias("_top"))
    base = F.broadcast(starts.join(tops, by, "left"))
    new_id = F.coalesce("_top", F.lit(0)) + F.col("_pos") - F.col("_start") + 1
    return (
        numbered.join(base, by).withColumn("id", new_id.cast(id_type)).drop("_pos", "_start", "_top")
    )


def created_members(
    dim: DataFrame,
    candidates: DataFrame,
    attrs: list[str],
    order: list[str],
    by: str | None = None,
    spaces: tuple[str, ...] = (),
) -> DataFrame:
    """Rows to add for names the dimension does not hold; ids follow first occurrence."""
    space = [by] if by else []
    seen = first_seen(candidates, attrs, order, space)
    new = seen.join(dim.select(*space, "name"), [*space, "name"], "left_anti")
    id_type = dict(dim.dtypes)["id"]
    numbered = next_ids(new, dim, "_seen", "name", by=by, spaces=spaces, id_type=id_type)
    return numbered.select(*space, "id", "name", *attrs)


def get_or_create(
    dim: DataFrame, candidates: DataFrame, attrs: list[str], order: list[str]
) -> DataFrame:
    """The dimension with every candidate name: known ids and attributes never change."""
    created = created_members(dim, candidates, attrs, order)
    return dim.select("id", "name", *attrs).unionByName(created)


def resolve_ids(
    cards: DataFrame, key: str, lists: dict[str, tuple[str, str]], members: DataFrame
) -> DataFrame:
    """Per card, the ids of each list of names, in list order.

    ``lists`` maps an output column to (array<string> column, dimension);
    ``members`` holds (dim, name, id). All lists travel through one join and one
    regrouping on the card key. Cards come back as (key, output columns); a card
    without names has empty lists.
    """

    def tagged(out: str, src: str, dim: str):
        names = F.coalesce(F.col(src), F.array().cast("array<string>"))
        return F.transform(
            names,
            lambda n, i: F.struct(
                F.lit(out).alias("out"), F.lit(dim).alias("dim"), i.alias("pos"), n.alias("name")
            ),
        )

    all_names = F.concat(*[tagged(out, src, dim) for out, (src, dim) in lists.items()])
    # an outer generator keeps cards without any name
    names = cards.select(key, F.explode_outer(all_names).alias("m")).select(key, "m.*")

    def ordered_ids(out: str):
        # bounded by the names on one card
        pairs = F.collect_list(F.when(F.col("out") == out, F.struct("pos", "id")))
        return F.transform(F.sort_array(pairs), lambda p: p["id"]).alias(out)

    return (
        names.join(members.select("dim", "name", "id"), ["dim", "name"], "left")
        .groupBy(key)
        .agg(*[ordered_ids(out) for out in lists])
    )


def new_members(used: DataFrame, known: DataFrame, order: list[str], id_col: str = "id") -> DataFrame:
    """Members in use but not known before, one row per id, last name wins."""
    fresh = used.join(known.select(id_col), id_col, "left_anti")
    return fresh.groupBy(id_col).agg(F.max_by("name", F.struct(*order)).alias("name"))

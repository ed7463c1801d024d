import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from snapflow.operators.latest import latest_per_key, unique_per_key
from snapflow.operators.upsert import (
    ACTION,
    apply_card_changes,
    changes,
    classify,
    load_counts,
    mark_done,
    new_state,
    upsert_catalogue,
    upsert_latest,
    upsert_seasons,
)
from snapflow.schemas import PLAYERS, PRICE_LATEST, SEASON, SPID

D, T = dt.date, dt.datetime
DAY1, DAY2 = T(2024, 1, 1), T(2024, 1, 2)
BATCH = "spid bigint, strong smallint, price bigint, price_date date"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture
def state(spark):
    return spark.createDataFrame(
        [(1, 1, 100, D(2024, 1, 1), DAY1), (2, 1, 200, D(2024, 1, 1), DAY1), (3, 1, 300, D(2024, 1, 1), DAY1)],
        PRICE_LATEST,
    )


def test_only_a_price_change_writes(spark, state):
    batch = spark.createDataFrame(
        [(1, 1, 100, D(2024, 1, 2)), (2, 1, 250, D(2024, 1, 2)), (4, 1, 1, D(2024, 1, 2)), (3, 1, None, D(2024, 1, 2))],
        BATCH,
    )
    merged = upsert_latest(state, batch, DAY2)
    assert rows(merged, "spid", "price", "price_date", "updated_at", ACTION) == [
        (1, 100, D(2024, 1, 1), DAY1, "skip"),
        (2, 250, D(2024, 1, 2), DAY2, "update"),
        (3, 300, D(2024, 1, 1), DAY1, "keep"),
        (4, 1, D(2024, 1, 2), DAY2, "insert"),
    ]
    assert rows(changes(merged), "spid") == [(2,), (4,)]
    assert load_counts(merged).first().asDict() == {"attempted": 3, "insert": 1, "update": 1, "skip": 1}
    again = upsert_latest(new_state(merged), batch, T(2024, 1, 3))
    assert changes(again).count() == 0
    assert rows(new_state(again), *state.columns) == rows(new_state(merged), *state.columns)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    old=st.dictionaries(st.integers(0, 6), st.integers(0, 2), max_size=6),
    new=st.dictionaries(st.integers(0, 6), st.integers(0, 2), max_size=6),
)
def test_upsert_properties(spark, old, new):
    state = spark.createDataFrame([(k, 1, v, None, DAY1) for k, v in old.items()], PRICE_LATEST)
    batch = spark.createDataFrame([(k, 1, v, None) for k, v in new.items()], BATCH)
    merged = upsert_latest(state, batch, DAY2).collect()
    assert {r.spid: r.price for r in merged} == {**old, **new}
    for r in merged:
        moved = r.spid in new and old.get(r.spid) != new[r.spid]
        assert (r.updated_at == DAY2) == moved
    assert sum(r[ACTION] != "keep" for r in merged) == len(new)


def test_catalogue_rename_keeps_done_flag(spark):
    state = spark.createDataFrame([(1, "a", True, DAY1), (2, None, True, DAY1), (3, "c", False, None)], SPID)
    batch = spark.createDataFrame([(1, "A"), (2, None), (4, "d")], "spid bigint, name string")
    merged = upsert_catalogue(state, batch)
    assert rows(merged, "spid", "name", "crawled", "crawled_at", ACTION) == [
        (1, "A", True, DAY1, "update"), (2, None, True, DAY1, "skip"),
        (3, "c", False, None, "keep"), (4, "d", False, None, "insert"),
    ]


def test_season_guard_on_either_column(spark):
    state = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "c", "z")], SEASON)
    batch = spark.createDataFrame([(1, "a", "y"), (2, "b", None), (3, "C", "z")], SEASON)
    assert rows(upsert_seasons(state, batch), "season_id", ACTION) == [(1, "update"), (2, "skip"), (3, "update")]


def test_card_changes(spark):
    names = [c.strip().split(" ")[0] for c in PLAYERS.split(",")]

    def players(*given):
        return spark.createDataFrame([tuple(g.get(n) for n in names) for g in given], PLAYERS)

    base = {"created_at": DAY1, "updated_at": DAY1, "ovr_change": 9, "ovr_changed_at": DAY1}
    state = players(
        {"id": 1, "spid": 1, "content_hash": "a", "main_ovr": 100, **base},   # same hash
        {"id": 2, "spid": 2, "content_hash": "a", "main_ovr": 100, **base},   # rating moves
        {"id": 3, "spid": 3, "content_hash": "a", "main_ovr": 100, **base},   # rating stays
        {"id": 4, "spid": 4, "content_hash": "a", "main_ovr": None, **base},  # old rating unknown
        {"id": 5, "spid": 5, "content_hash": None, "main_ovr": 100, **base},  # old hash unknown
    )
    cards = players(
        {"spid": 1, "content_hash": "a", "main_ovr": 101}, {"spid": 2, "content_hash": "b", "main_ovr": 98},
        {"spid": 3, "content_hash": "b", "main_ovr": 100}, {"spid": 4, "content_hash": "b", "main_ovr": 50},
        {"spid": 5, "content_hash": "b", "main_ovr": 100}, {"spid": 6, "content_hash": "b", "main_ovr": 70},
    ).drop("created_at", "updated_at", "ovr_change", "ovr_changed_at", "id")
    got = apply_card_changes(state, cards, DAY2)
    assert rows(got, "spid", "id", ACTION, "main_ovr", "created_at", "updated_at", "ovr_change", "ovr_changed_at") == [
        (1, 1, "skip", 100, DAY1, DAY1, 9, DAY1),
        (2, 2, "update", 98, DAY1, DAY2, -2, DAY2),
        (3, 3, "update", 100, DAY1, DAY2, 9, DAY1),
        (4, 4, "update", 50, DAY1, DAY2, 9, DAY1),
        (5, 5, "update", 100, DAY1, DAY2, 9, DAY1),
        (6, None, "insert", 70, DAY2, DAY2, None, None),
    ]
    assert got.drop(ACTION).dtypes == state.dtypes


def test_mark_done(spark):
    state = spark.createDataFrame([(1, "a", False, None), (2, "b", True, DAY1), (3, "c", False, None)], SPID)
    ok = spark.createDataFrame([(1,), (1,), (2,)], "spid bigint")
    assert rows(mark_done(state, ok, DAY2), "spid", "crawled", "crawled_at")[:2] == [(1, True, DAY2), (2, True, DAY2)]
    assert mark_done(state, ok, DAY2).filter("not crawled").count() == 1


def test_presence_is_not_value(spark):
    state = spark.createDataFrame([(1, None)], "k int, v int")
    batch = spark.createDataFrame([(1, 5), (2, None)], "k int, v int")
    assert rows(classify(state, batch, ["k"], ["v"]), "k", ACTION) == [(1, "update"), (2, "insert")]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 10, 1), (1, 20, 3), (1, 30, 2), (2, None, 1)], "k int, v int, at int")
    assert rows(latest_per_key(df, ["k"], ["at"]), "k", "v") == [(1, 20), (2, None)]
    assert rows(latest_per_key(df, ["k"], ["at", "v"]), "k", "v", "at") == [(1, 20, 3), (2, None, 1)]
    with pytest.raises(Exception, match="duplicate key"):
        unique_per_key(df, ["k"]).collect()
    assert unique_per_key(df.filter("at = 1"), ["k"]).count() == 2

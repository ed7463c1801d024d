import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from snapflow.functions import scalars as sc
from snapflow.functions import series as se
from snapflow.functions import text as tx
from snapflow.functions.grades import grade_spec
from snapflow.functions.hashing import content_hash, content_json
from snapflow.operators.extract import map_labels, nfkc
from snapflow.schemas import STAT_COLUMNS, STAT_LABELS

X = F.col("x")
D = dt.date


@pytest.mark.parametrize("text, want", [
    ("SH (Step Higher)", "SH"), ("A(x) (Long)", "A(x)"), ("(x)", "(x)"), (None, ""), ("", ""),
    ("  plain ", "plain"), (" (a) ", "(a)"), ("A (b) c", "A"), ("   ", ""),
])
def test_short_name(one, text, want):
    assert one(tx.short_name(X), "x string", text) == want


@pytest.mark.parametrize("text, want", [
    ("1-5, 8,20", [1, 2, 3, 4, 5, 8]), ("5-3", []), ("1,,2, ", [1, 2]), ("13-99999999999", [13]),
    ("3, 1 - 2 ,3", [1, 2, 3]), ("", []), ("0,14", []), ("+2", [2]), (None, None),
])
def test_grade_spec(one, text, want):
    assert one(grade_spec(X), "x string", text) == want


@pytest.mark.parametrize("text", ["a", "1-", "-3", "1-2-3", "1.5", "1 2"])
def test_malformed_grade_spec(one, text):
    with pytest.raises(Exception, match="bad grade list"):
        one(grade_spec(X), "x string", text)
    assert one(grade_spec(X, strict=False), "x string", text) is None


@pytest.mark.parametrize("text, strong, want", [
    ("L5 – R5", "L5", ("L", 5)), ("L5 – R4", None, (None, None)), ("L5 – R4", "R4", ("R", 5)),
    ("L3 R2 R4", "L3", ("L", 4)), ("none", "L", (None, None)), ("L 2", "L 2", ("L", None)),
    (None, None, (None, None)), ("L5 R4", "x L5", (None, None)),
])
def test_foot(one, text, strong, want):
    got = one(tx.foot(X, F.col("y")), "x string, y string", text, strong)
    assert (got.side, got.weak) == want


@pytest.mark.parametrize("text, want", [
    (" \t a b　\n", "a b"), ("", ""), (None, None), ("\x1fa\x1c", "a"), (" ", ""),
])
def test_strip(one, text, want):
    assert one(tx.strip(X), "x string", text) == want
    if text is not None:
        assert text.strip() == want


def test_small_text_functions(one):
    assert one(tx.star_count(X), "x string", "★★☆★") == 3
    assert one(tx.star_count(X), "x string", "") is None
    assert one(tx.star_count(X), "x string", "no") == 0
    assert one(tx.first_int(X), "x string", "ab 12cm 3") == 12
    assert one(tx.first_int(X), "x string", "tall") is None
    assert one(tx.clean_nation(X), "x string", "한국, 국가대표") == "한국"
    assert one(tx.clean_nation(X), "x string", "국가대표") == ""
    assert one(tx.clean_nation(X), "x string", None) is None
    assert one(tx.truncate(X, 4), "x string", "abcde") == "abc…"
    assert one(tx.truncate(X, 4), "x string", "abcd") == "abcd"
    assert one(tx.last6(X), "x string", "123456789") == "456789"
    assert one(tx.last6(X), "x string", "12") == "12"
    assert one(tx.card_label(X, F.lit("n")), "x string", "") == "n"
    assert one(tx.card_label(X, F.lit("n")), "x string", "SH") == "SH n"
    assert one(tx.season_id(X), "x bigint", 596001234) == 596


def test_page_key(one):
    url = "https://x.example.com/a?spid=12&n1Strong=7&s=#top"
    assert one(tx.page_key(X, "spid"), "x string", url) == 12
    assert one(tx.page_key(X, "n1Strong", "smallint"), "x string", url) == 7
    assert one(tx.page_key(X, "s"), "x string", url) is None
    assert one(tx.page_key(X, "none"), "x string", url) is None
    assert one(tx.page_key(X, "spid"), "x string", "::bad url") is None


def test_preview(one):
    shown = F.split(X, ",")
    assert one(tx.preview(shown, 2, F.lit(5), "개"), "x string", "a,b,c") == "a, b 외 3개"
    assert one(tx.preview(shown, 5, F.lit(3), "개"), "x string", "a,b,c") == "a, b, c"


def test_labels(spark, one):
    assert one(tx.clean_label(X), "x string", None) == ""
    assert one(nfkc(X), "x string", "ＧＫ　①") == "GK 1"
    rows = [("슛 파워",), ("슛​ 파 워 ",), ("ＧＫ 킥",), ("키",), (None,)]
    got = map_labels(spark.createDataFrame(rows, "label string"), "label").collect()
    assert {r.label: r.stat for r in got} == {
        "슛 파워": "shot_power", "슛​ 파 워 ": "shot_power", "ＧＫ 킥": "gk_kick", "키": None, None: None,
    }
    assert len(STAT_LABELS) == len(STAT_COLUMNS) == 34


def points(spark, html, n=None):
    df = spark.createDataFrame([(html,)], "html string")
    row = se.with_series(df, "html", F.lit(D(2024, 6, 10)), n).first()
    return [(p.date.day, p.price) for p in row.points]


def page(times, values, end='"]};'):
    quoted = [",".join(f'"{v}"' for v in vs) for vs in (times, values)]
    return f'<script>"value":["1"] var json1 = {{"time":[{quoted[0]}],"value":[{quoted[1]}{end[1:]}'


def test_series(spark):
    assert points(spark, page(["6.1", "6.2", "6.3"], [5, 6])) == [(8, 5), (9, 6)]
    assert points(spark, page(["6.1"], [5, 6])) == [(10, 5)]
    assert points(spark, page([], [5])) == []
    assert points(spark, page(["6.1", "6.2"], [5, 6], end='"')) == [(9, 5)]
    assert points(spark, page(["6.1", "6.2"], [5, 6], end='" ')) == [(9, 5), (10, 6)]
    assert points(spark, page(["6.1"], [5]).replace("json1", "json2")) == []
    assert points(spark, 'var json1 {"time":["6.1"]}') == []
    assert points(spark, None) == []
    three = page(["1.1", "1.2", "1.3"], [1, 2, 3])
    assert points(spark, three, 2) == [(9, 2), (10, 3)]
    assert points(spark, three, 9) == points(spark, three, 0) == points(spark, three)
    assert points(spark, page(["12.31", "1.1"], [10**18, 10**30])) == [(9, 10**18), (10, None)]


def test_latest_point_of_nothing(one):
    assert one(se.latest_point(F.array().cast("array<int>"))) is None


def test_time_is_zone_free(spark):
    now = dt.datetime(2024, 1, 1, 3, 0, tzinfo=dt.timezone(dt.timedelta(hours=9)))
    df = spark.range(1).select(
        sc.to_naive_utc(sc.batch_time(now)).alias("n"), sc.default_run_id(sc.batch_time(now)).alias("r"),
        sc.batch_time(now, "timestamp_ntz").alias("b"),
    )
    for zone in ("UTC", "Asia/Seoul", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            row = df.first()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert row.n == row.b == dt.datetime(2023, 12, 31, 18) and row.r == "20231231", zone


def test_null_and_json_helpers(one):
    assert one(sc.is_distinct(X, F.lit(None)), "x int", None) is False
    assert one(sc.is_distinct(X, F.lit(1)), "x int", None) is True
    assert one(sc.rating_delta(F.lit(5), X), "x int", None) == 0
    assert one(sc.rating_delta(F.lit(5), X), "x int", 7) == -2
    assert one(sc.or_zero(X), "x int", None) == 0
    assert one(sc.json_rows(X, "array<bigint>"), "x string", None) == []
    assert one(sc.json_rows(X, "array<bigint>"), "x string", "[1,2]") == [1, 2]
    got = one(sc.json_rows(X, "array<struct<id:bigint,name:string>>"), "x string", '[{"id":1}]')
    assert got[0].name is None
    assert one(sc.to_json_list(F.array(F.struct(F.lit(1).alias("id"), X.alias("name")))), "x string", None) == (
        '[{"id":1,"name":null}]'
    )
    assert one(sc.series_end(X), "x date", D(2024, 3, 1)) == D(2024, 2, 29)


CARD = (
    "name string, season_id int, nation_id int, main_position string, main_ovr int, "
    "sub_positions array<string>, pay int, height int, weight int, body_type string, skill_moves int, "
    "weak_foot int, preferred_foot string, trait_ids array<smallint>, team_color_ids array<smallint>"
)


def card(spark, **changed):
    base = {
        "name": '이름 "q" / \\ \u0001', "season_id": 596, "nation_id": None, "main_position": "ST", "main_ovr": 120,
        "sub_positions": ["CF", "LW"], "pay": 20, "height": 180, "weight": 75, "body_type": "보통 (마름)",
        "skill_moves": 5, "weak_foot": 4, "preferred_foot": "R", "trait_ids": [9, 2], "team_color_ids": [],
    }
    base.update(changed)
    df = spark.createDataFrame([tuple(base.values())], CARD)
    for i, c in enumerate(STAT_COLUMNS):
        df = df.withColumn(c, F.lit(None if c == "pace" else i).cast("int"))
    return base, df


def test_content_hash_is_the_hash_of_sorted_compact_json(spark):
    base, df = card(spark)
    base["trait_ids"] = sorted(base["trait_ids"])
    base["stats"] = {c: None if c == "pace" else i for i, c in enumerate(STAT_COLUMNS)}
    blob = json.dumps(base, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    assert df.select(content_json()).first()[0] == blob
    assert df.select(content_hash()).first()[0] == hashlib.sha256(blob.encode()).hexdigest()


def test_what_the_hash_depends_on(spark):
    def h(**changed):
        return card(spark, **changed)[1].select(content_hash()).first()[0]

    assert h(trait_ids=[2, 9]) == h()
    assert h(sub_positions=["LW", "CF"]) != h()
    assert h(weak_foot=None) != h()

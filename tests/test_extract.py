import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from snapflow.operators.extract import extract_cards, split_valid
from snapflow.operators.page_text import Page, card_text
from snapflow.plans.card_job import (
    as_members,
    commit_cards,
    dimension,
    hashed_cards,
    run_card_job,
    with_ids,
)
from snapflow.plans.catalogue_job import card_targets, leading, run_catalogue_job
from snapflow.plans.price_job import price_batch, run_price_job, work_list
from snapflow.schemas import NATIONS, PAGES, PLAYERS, PRICE_LATEST, SEASON, SPID, TEAM_COLORS, TRAITS
from snapflow.sources.readers import read_card_catalogue, target_keys
from snapflow.sources.snapshots import read_changes, read_snapshot

NAME = '<div class="name"> 홍 길동 </div>'
POS = (
    '<div class="info_line info_ab"><span class="position"><b class="txt">ST</b><b class="value">120</b></span>'
    '<span class="position"><b class="txt">CF</b><b class="value">118</b></span></div>'
)
URL = "https://x.example.com/ability?spid=596000001&n1Strong=1"


def extract(spark, html, url=URL):
    return extract_cards(spark.createDataFrame([(1, url, html)], PAGES)).first()


@pytest.mark.parametrize("html, error", [
    ("", "name not found"), (None, "name not found"), ('<p class="name"> </p>' + POS, "name not found"),
    (NAME, "positions not found"), (NAME + POS.replace("txt", "t"), "positions not found"),
    (NAME + POS.replace("118", "x"), "bad rating"), (NAME + POS + '<p class="pay"><span>-</span></p>', "bad pay"),
    (NAME + POS + '<p class="etc height">tall</p>', "bad height"),
    (NAME + POS + '<p class="etc weight">heavy</p>', "bad weight"),
    (NAME + POS + '<p class="etc nation"><img></p>', "image without src"),
    (NAME + POS + '<p class="skill_wrap"><span><img><b class="desc">t</b></span></p>', "image without src"),
    (NAME + POS, None), (NAME + POS + '<p class="etc height"></p>', None),
])
def test_rejects(spark, html, error):
    assert extract(spark, html).error == error


def test_page_without_key_is_a_reject(spark):
    assert extract(spark, NAME + POS, "https://x.example.com/").error == "no card key"


def test_missing_parts_are_null(spark):
    card = extract(spark, NAME + POS)
    assert (card.name, card.main_position, card.main_ovr, card.sub_positions) == ("홍 길동", "ST", 120, ["CF"])
    assert (card.spid, card.season_id) == (596000001, 596)
    for c in ("pay", "height", "weight", "body_type", "skill_moves", "weak_foot", "preferred_foot", "nation_name"):
        assert card[c] is None
    assert card.traits == [] and card.team_colors == []


@pytest.mark.parametrize("foot, want", [
    ("<strong>L5</strong> – R5", ("L", 5)), ("L5 – R4", (None, None)), ("L4 – <strong>R5</strong>", ("R", 4)),
])
def test_two_footed_side_comes_from_the_emphasis(spark, foot, want):
    card = extract(spark, NAME + POS + f'<span class="etc foot">{foot}</span>')
    assert (card.preferred_foot, card.weak_foot) == want


def test_lists_and_stats(spark):
    card = extract(spark, NAME + POS + """
      <div class="skill_wrap"><span><img src="/a.png"><em class="desc"> 예리한 감아차기 </em></span><span>no</span></div>
      <div class="tdefault_wrap"><a class="selector_item">소속 팀컬러</a><a class="selector_item">Club</a></div>
      <div class="tspecial_wrap"><a class="selector_item">Club</a><a class="selector_item">관계 팀컬러</a></div>
      <ul class="data_wrap_playerinfo"><li class="ab"><b class="txt">골 결정력</b><b class="value"> 101 <i>+3</i></b></li>
      <li class="ab"><b class="txt">골결정력</b><b class="value">102</b></li>
      <li class="ab"><b class="txt">골결정력</b><b class="value">-</b></li>
      <li class="cd"><b class="txt">시야</b><b class="value">1</b></li><li class="ab"><b class="txt">?</b><b class="value">1</b></li></ul>
    """)
    assert [tuple(t) for t in card.traits] == [("예리한 감아차기", "/a.png")]
    assert [tuple(t) for t in card.team_colors] == [("Club", "club"), ("Club", "relation")]
    assert (card.finishing, card.vision) == (102, None)


class Standard(Page):
    """Always the standard parser."""

    def _read_regular(self, html):
        return False


def tree(page):
    return page.tags, page.classes, page.parents, page.last, page.text_from, page.text_to, page.texts


@pytest.mark.parametrize("html", [
    "", "a < b", "<p class=x>a<p>b</b></p>c", "<a b='>' class=\"x y\">t</a>", "<!-- a -- b --><i class='x'>1</i>",
    "<!DOCTYPE html><script>if (a<b) '<p class=\"name\">'</script><p class='name'>n</p>", "<br/><p/>x",
    "<title>a &amp; b</title><img class=x src='a&amp;b'>", "<p class='x", "&lt;p class='name'&gt;", "<p\nclass='x'\n>y</p >",
    "<textarea><p class='name'>x</p></textarea>", "<P CLASS='Name'>x</P><style>.a{}</style>", "x<!---->y<b> </b>\n<i>\t\n</i>",
    "<p class='it\"s'>q</p><p class>z</p><p class=''>w</p>", "<script src='x'></script><script>a</script>", "<![CDATA[x]]><p>y</p>",
    "<ul><li class=ab>1<li class=ab>2</ul>tail", "</p></div>lead<div class='a b a'>z",
])
def test_regular_reader_equals_the_standard_parser(html):
    assert tree(Page(html)) == tree(Standard(html))


def test_regular_reader_on_the_test_pages():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist()
    assert pages
    for html in pages:
        assert tree(Page(html)) == tree(Standard(html))


@pytest.mark.parametrize("html", ["1<!doctype x>2<i class=x title='<'>t</i>", "<p class='name'>1<!DOCTYPE x>2</p><textarea></textarea>"])
def test_declarations_part_texts_in_both_readers(html):
    assert tree(Page(html)) == tree(Standard(html))
    assert Page(html).texts[:2] == ["1", "2"]


def test_tags_that_recur_are_read_once():
    """Pages alike in their tags, as the cards of a site are, ask the tag reader for new tags only."""
    from snapflow.operators import page_text

    page_text._tag.cache_clear()
    for n in range(50):
        card_text(f"<html><div class='thumb'><p class='name'>n{n}</p></div><span class='etc height'>{n}cm</span></html>")
    assert page_text._tag.cache_info().misses == 8


def test_unreadable_markup_is_not_fatal():
    for html in ("<![if x", "<!", "<" * 50, "<!-", "<?x", "\x00<p>"):
        card_text(html)


def price_page(page_id, spid, strong, times, values):
    q = [",".join(f'"{v}"' for v in vs) for vs in (times, values)]
    html = f'var json1 = {{"time":[{q[0]}],"value":[{q[1]}]}}'
    return page_id, f"https://x.example.com/g?spid={spid}&n1Strong={strong}", html


def test_price_job_end_to_end(spark, tmp_path):
    as_of, root = F.lit(dt.date(2024, 1, 3)), str(tmp_path / "prices")
    first = spark.createDataFrame([price_page(1, 1, 1, ["1.1", "1.2"], [5, 6]), price_page(2, 2, 1, [], [])], PAGES)
    assert run_price_job(first, root, as_of, dt.datetime(2024, 1, 3), "a") == 1
    assert run_price_job(first, root, as_of, dt.datetime(2024, 1, 4), "a") == 1   # replay
    second = spark.createDataFrame(
        [price_page(3, 1, 1, ["1.3"], [6]), price_page(4, 2, 1, ["1.3"], [9]), price_page(5, 2, 1, ["1.3"], [10])], PAGES
    )
    assert run_price_job(second, root, F.lit(dt.date(2024, 1, 4)), dt.datetime(2024, 1, 4), "b") == 2
    state = {(r.spid, r.strong): (r.price, r.price_date.day, r.updated_at.day) for r in read_snapshot(spark, root, PRICE_LATEST).collect()}
    assert state == {(1, 1): (6, 2, 3), (2, 1): (10, 3, 4)}
    assert [(r.spid, r.action) for r in read_changes(spark, root, PRICE_LATEST, 2).collect()] == [(2, "insert")]
    assert read_snapshot(spark, root, PRICE_LATEST, version=1).count() == 1


def test_price_work_list(spark):
    players = spark.createDataFrame([(k,) for k in (5, 3, 9, 3, 7)], "spid bigint")
    work = work_list(players, [1, 13], limit=3, index=1, count=2)
    assert sorted(tuple(r) for r in work.collect()) == [(5, 1), (5, 13)]
    pages = spark.createDataFrame([price_page(1, 5, 1, ["1.1"], [1]), price_page(2, 7, 1, ["1.1"], [1])], PAGES)
    assert [r.spid for r in price_batch(pages, F.lit(dt.date(2024, 1, 3)), work).collect()] == [5]


def test_card_job_end_to_end(spark, tmp_path):
    def page(i, spid, ovr, traits="", colors=("", "")):
        html = NAME + POS.replace("120", str(ovr)) + f'<div class="skill_wrap">{traits}</div>' + "".join(
            f'<div class="{w}">{c}</div>' for w, c in zip(("tdefault_wrap", "tspecial_wrap"), colors)
        )
        return i, f"https://x.example.com/a?spid={spid}&n1Strong=1", html

    def trait(name):
        return f'<span><img src="/{name}{len(name)}.png"><em class="desc">{name}</em></span>'

    item = '<a class="selector_item">Reds</a>'
    spid = spark.createDataFrame([(100000000 + i, "n", False, None) for i in range(4)], SPID)
    members = as_members(
        spark.createDataFrame([], NATIONS), spark.createDataFrame([(7, "known", "/k.png")], TRAITS),
        spark.createDataFrame([], TEAM_COLORS),
    )
    pages = spark.createDataFrame([
        page(1, 100000000, 100, trait("new") + trait("known"), (item, item)),
        page(2, 100000001, 90, trait("known") + trait("other")),
        (3, "https://x.example.com/a?spid=100000002", "<p>broken</p>"),
    ], PAGES)
    run = run_card_job(pages, spark.createDataFrame([], PLAYERS), spid, members, "1", dt.datetime(2024, 1, 1), shards=2)

    traits = {r.name: (r.id, r.image_url) for r in dimension(run.members, "trait").collect()}
    assert traits == {"known": (7, "/k.png"), "new": (8, "/new3.png"), "other": (9, "/other5.png")}
    assert [tuple(r) for r in dimension(run.members, "team_color").collect()] == [(1, "Reds", "club")]
    cards = {r.spid: r for r in run.players.collect()}
    assert cards[100000000].trait_ids == [8, 7] and cards[100000000].team_color_ids == [1, 1]
    assert (cards[100000000].id, cards[100000001].id) == (1, 2)
    assert {r.spid: r.crawled for r in run.spid.collect()} == {
        100000000: True, 100000001: True, 100000002: False, 100000003: False,
    }
    log = {r.shard: (r.new_players, r.changed, r.failures, r.new_traits) for r in run.log.collect()}
    assert log[0] == (1, 0, 1, '[{"id":8,"name":"new"}]') and log[1] == (1, 0, 0, '[{"id":9,"name":"other"}]')

    # hashed by name, a card's hash does not depend on how ids were handed out
    shifted = run.members.withColumn("id", F.col("id") + 100)
    valid, _ = split_valid(extract_cards(pages))

    def hashes(members, by_name):
        found = hashed_cards(with_ids(valid, members), by_name).select("spid", "content_hash")
        return {tuple(r) for r in found.collect()}

    assert hashes(run.members, True) == hashes(shifted, True)
    assert not hashes(run.members, False) & hashes(shifted, False)

    # written to a snapshot, the second run's unchanged card is not rewritten
    root = str(tmp_path / "cards")
    assert commit_cards(hashed_cards(with_ids(valid, run.members)), root, dt.datetime(2024, 1, 1)) == 1
    assert commit_cards(hashed_cards(with_ids(valid, run.members)), root, dt.datetime(2024, 1, 2)) == 2
    assert read_changes(spark, root, PLAYERS, 2).count() == 0

    # a later run: one rating up, one card only with its traits in another order
    later = spark.createDataFrame([
        page(1, 100000000, 103, trait("known") + trait("new"), (item, item)),
        page(2, 100000001, 90, trait("other") + trait("known")),
    ], PAGES)
    again = run_card_job(later, run.players.drop("action"), run.spid, run.members, "2", dt.datetime(2024, 1, 8))
    got = {r.spid: (r.action, r.main_ovr, r.ovr_change, r.id) for r in again.players.collect()}
    assert got == {100000000: ("update", 103, 3, 1), 100000001: ("skip", 90, None, 2)}
    row = again.log.first()
    assert (row.new_players, row.changed, row.failures, row.new_traits) == (0, 1, 0, "[]")
    ok, bad = split_valid(extract_cards(later))
    assert (ok.count(), bad.count()) == (2, 0)


def test_catalogue_then_only_new_cards(spark, tmp_path):
    path = tmp_path / "spid.json"
    path.write_text('[{"id": 100000009, "name": "z"}, {"id": 100000001, "name": "a"}, {"id": 100000002, "name": "b"}]')
    cards = read_card_catalogue(spark, str(path))
    assert [r.spid for r in leading(cards, 2).collect()] == [100000009, 100000001]
    spid = spark.createDataFrame([(100000002, "b", True, None)], SPID)
    seasons = spark.createDataFrame([(100, "S", "u")], SEASON)
    run = run_catalogue_job(cards, seasons, spid, spark.createDataFrame([], SEASON), "r", dt.datetime(2024, 1, 1))
    row = run.log.first()
    assert (row.new_players, row.new_seasons) == (2, '[{"season_id":100,"class_name":"S"}]')
    catalogue = run.spid.drop("action")
    assert [r.spid for r in card_targets(catalogue, only_new=True, limit=1).collect()] == [100000001]

    # one target page landed, one not; the page of a done card is not worked on
    pages = spark.createDataFrame(
        [(i, f"https://x.example.com/a?spid={k}", NAME + POS) for i, k in enumerate((100000001, 100000002))], PAGES
    )
    members = as_members(*[spark.createDataFrame([], s) for s in (NATIONS, TRAITS, TEAM_COLORS)])
    done = run_card_job(
        pages, spark.createDataFrame([], PLAYERS), catalogue, members, "r", dt.datetime(2024, 1, 1),
        targets=card_targets(catalogue, only_new=True),
    )
    assert [r.spid for r in done.players.collect()] == [100000001]
    assert [(r.spid, r.error) for r in done.rejects.collect()] == [(100000009, "no page")]
    assert {r.spid for r in target_keys(done.spid, only_new=True).collect()} == {100000009}
    log = done.log.first()
    assert (log.new_players, log.failures) == (1, 1)


def test_pages_that_are_replaced_are_not_parsed(spark, monkeypatch):
    """One parse for each card's last pages and for each page without a key; copies and older pages take none."""
    from snapflow.plans import card_job

    url = "https://x.example.com/a?spid={}&n1Strong=1"
    rows = [(1, url.format(101000001), "<p class='name'>a</p>"), (2, url.format(101000001), "<p class='name'>b</p>")]
    rows += [(2, url.format(101000001), "<p class='name'>b</p>"), (None, url.format(101000001), "<p class='name'>c</p>")]
    rows += [(3, url.format(101000002), None)] * 2 + [(4, "https://x.example.com/none", "<p>x</p>")] * 2
    parsed = []
    records = card_job.card_records
    monkeypatch.setattr(card_job, "card_records", lambda pages, targets: parsed.extend(pages.collect()) or records(pages, targets))
    got = card_job.parse_cards(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.html or "") for r in parsed) == [(2, "<p class='name'>b</p>"), (3, ""), (4, "<p>x</p>"), (4, "<p>x</p>")]
    assert sorted((r.page_id, r.name or "") for r in got) == [(2, "b"), (3, ""), (4, ""), (4, "")]


def test_records_are_read_once(spark):
    """Records with and without a card key come from one pass over the parsed pages."""
    from snapflow.plans.card_job import one_per_card

    counted = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            counted.add(len(pdf))
            yield pdf

    rows = [(1, 7, "a", None, 1), (2, 7, "b", None, 1), (3, None, "x", "no card key", None), (3, None, "x", "no card key", None)]
    schema = "page_id long, spid long, name string, error string, main_ovr int"
    got = one_per_card(spark.createDataFrame(rows, schema).coalesce(1).mapInPandas(count, schema)).collect()
    assert sorted(r.name for r in got) == ["b", "x", "x"] and counted.value == len(rows)

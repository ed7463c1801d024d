"""Near-dedup stage of the pipeline against all pairs of shingle sets."""

import itertools
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from snapflow.llm import jaccard, simhash  # noqa: E402


def plain_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(b" ".join(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def plain_groups(texts):
    sets = [plain_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(texts))]


def edited(words, places):
    return " ".join("changed" if i in places else w for i, w in enumerate(words))


def test_copies_beyond_the_contract_radius_are_dropped(spark):
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base), edited(base, {50}), edited(base, {20, 90}), edited(base, {10, 40, 70, 100})]
    far = [(simhash.fingerprint_of(texts[0]) ^ simhash.fingerprint_of(t)).bit_count() for t in texts]
    assert far[2] > simhash.RADIUS and plain_groups(texts) == [0, 0, 0, 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_stage(spark, docs, "").collect()) == [0, 3]


@pytest.mark.parametrize("centres,sample", [(2, 4_096), (0, 4_096), (2, 1 << 40)])
def test_groups_equal_all_pairs(spark, monkeypatch, centres, sample):
    monkeypatch.setattr(jaccard, "CENTRES", centres)
    monkeypatch.setattr(jaccard, "SAMPLE", sample)
    rng = random.Random(7)
    phrase = "this work may be read and copied by all who wish to do so at any time"
    texts = [None, "", "  \n", "one two", "One  TWO", "one two three", phrase, phrase.upper() + " now"]
    for n in (12, 40, 90, 200):
        base = [rng.choice("abcdefghij") + str(rng.randrange(50)) for _ in range(n)]
        texts += [edited(base, set(rng.sample(range(n), k))) for k in (0, 0, 1, 1, 2, 3, 5, 8) for _ in range(3) if k < n]
        texts += [phrase + " " + " ".join(base[:k]) for k in (5, n // 2, n)] + [" ".join(base[i:] + base[:i]) for i in (1, n // 2)]
    texts += [f"{phrase} {i}" for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.root for r in jaccard.copy_groups(docs).collect()}
    least = {}
    for i, r in sorted(found.items()):
        least.setdefault(r, i)
    assert [least[found[i]] for i in range(len(texts))] == plain_groups(texts)


def test_signatures_share_a_shingle():
    rng = np.random.default_rng(3)
    frequent = np.sort(rng.integers(0, 400, 40))
    counts = rng.integers(3, 50, 40)
    for _ in range(2_000):
        a = np.unique(rng.integers(0, 400, rng.integers(1, 60)))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.93], rng.integers(0, 400, rng.integers(0, 6))]))
        if 5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b)):
            x, y = (set(jaccard.in_order(s, frequent, counts)[:jaccard.prefix_size(len(s))].tolist()) for s in (a, b))
            assert x & y


def test_rows_of_repeated_and_null_ids(spark):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [(None, text), (5, text + " end"), (5, text + " end"), (9, text), (None, "alone here"), (None, "alone here"), (7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0), r.text) for r in jaccard.one_of_each(docs).collect())
    assert got == [(0, "alone here"), (5, text + " end"), (7, None)]
    assert jaccard.one_of_each(docs.limit(0)).collect() == []


def test_copies_pass_the_weighing(spark):
    rng = np.random.default_rng(5)
    pairs, sets = [], {}
    for i in range(0, 3_000, 2):
        a = np.unique(rng.integers(0, 300, rng.integers(1, 80)))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.choice([0.85, 0.93, 1])], rng.integers(0, 300, rng.integers(0, 12))]))
        sets[i], sets[i + 1] = a, b
        pairs.append((i, len(a), i + 1, len(b)))
    signatures = [(i, jaccard.in_order(s, np.zeros(0, np.int64), np.zeros(0, np.int64))[:jaccard.prefix_size(len(s))].tolist()) for i, s in sets.items()]
    left = jaccard.likely(spark.createDataFrame(pairs, "a long, na int, b long, nb int"), spark.createDataFrame(signatures, "sid long, hs array<long>"))
    passed = {(r.a, r.b) for r in left.collect()}
    copies = {(a, b) for a, _, b, _ in pairs if 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))}
    assert copies <= passed and 100 < len(copies) and len(passed) < len(pairs)


def test_stage_joins_the_fingerprints_of_all_texts(spark, monkeypatch):
    """The stage asks the operator's shards about every text, and what they link is verified: 4 bits are no copies by themselves."""
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base), edited(base, {200}), "quite another text of some words", "a b c d e", "a b c d f", None]
    prints = [simhash.fingerprint_of(t, 5) for t in texts]
    assert (prints[0] ^ prints[1]).bit_count() <= simhash.RADIUS
    asked, linked, near = [], [], jaccard.near_links

    def seen(fps):
        asked.extend(r.fp for r in fps.collect())
        out = near(fps)
        linked.extend(frozenset((r.a, r.b)) for r in out.collect())
        return out

    monkeypatch.setattr(jaccard, "near_links", seen)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_stage(spark, docs, "").collect()) == [0, 2, 3, 4, 5]
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    assert sorted(asked) == sorted(set(signed)) and frozenset(signed[:2]) in linked


def test_fingerprint_pairs_are_those_of_the_shards(spark):
    points = [(1, 10, 0), (2, 11, 0), (3, 12, 0b111), (4, 13, (1 << 62) - 1), (5, 9, (1 << 62) - 1), (6, 8, 0x5555555555555555)]
    got = {(r.a, r.na, r.b, r.nb) for r in jaccard.fingerprint_pairs(spark.createDataFrame(points, "sid long, n int, fp long")).collect()}
    assert got == {(1, 10, 2, 11), (1, 10, 3, 12), (4, 13, 5, 9)}

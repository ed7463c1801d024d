"""Clustering and prefix trie against plain Python."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapflow.llm import clusters, trie

LONG = 1 << 63


def plain_clusters(rows, k, rounds, dims):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * int(x)) if abs(x) >= 1 << 53 else math.floor(256 * x) for x in v], v))
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[2]))
    cs = [v for _, v, _ in first[:k]]

    def nearest(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cs]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        own = defaultdict(list)
        for _, v, _ in kept:
            own[nearest(v)[0]].append(v)
        for c, vs in own.items():
            cs[c] = [sum(x) // len(vs) for x in zip(*vs)]
    return sorted(((i, *nearest(v)) for i, v, _ in kept), key=str), cs


def compare(spark, rows, k, rounds, dims, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn("cluster", F.lit("x"))
    found, cs = clusters.cluster(df, k, rounds, dims)
    want, wanted = plain_clusters(rows, k, rounds, dims)
    got = sorted(((r.vec_id, r.cluster, r.distance) for r in found.collect()), key=str)
    assert cs == wanted
    assert got == sorted(((i, c, d if d < LONG else None) for i, c, d in want), key=str)
    return clusters.with_inertia(found, cs)


def test_clusters_of_random_vectors(spark):
    rng = random.Random(3)
    for k, dims in ((1, 1), (5, 3), (8, 8)):
        rows = [(i, [float(np.float32(rng.choice([rng.gauss(0, 1), rng.randrange(-2, 3) / 4]))) for _ in range(dims)]) for i in range(300)]
        rows += [(7, rows[7][1]), (None, rows[3][1]), (None, [0.0] * dims)]
        full = compare(spark, rows, k, 4, dims).collect()
        total = sum(r.distance for r in full)
        assert {r.inertia for r in full} == {total}
        for c in {r.cluster for r in full}:
            assert {r.cluster_inertia for r in full if r.cluster == c} == {sum(r.distance for r in full if r.cluster == c)}


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [-inf, 1.0]), (8, [0.5, -0.3]), (9, [0.1, 0.2]), (10, [1.0, 2.0, 3.0])]
    full = compare(spark, rows, 40, 5, 2).collect()
    assert {r.vec_id for r in full} == {8, 9} and {r.distance for r in full} == {0}
    none = spark.createDataFrame(rows[:7], "vec_id long, embedding array<float>")
    assert clusters.with_inertia(*clusters.cluster(none, dims=2)).collect() == []


def test_large_components(spark):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 1.0]), (3, [3e6, 3e6]), (4, [0.1, 0.1]), (5, [1e300, 2.0]), (6, [5e14, 1.5]), (7, [9.1e15, 0.0])]
    for k in (1, 3, 7):
        full = compare(spark, rows, k, 3, 2, "double").collect()
        assert len(full) == 7


def test_ties_go_to_the_smaller_number():
    lists = clusters.Lists(np.array([[4, 0], [0, 0], [2, 2], [2, 2]]))
    number, distance = lists.nearest(np.array([[2, 0], [2, 2], [3, 0]]))
    assert number.tolist() == [0, 2, 0] and distance.tolist() == [4, 0, 1]


def test_walk_equals_all_distances():
    rng = np.random.default_rng(1)
    for k, d in ((40, 64), (40, 2), (3, 1), (1, 5)):
        cs, x = rng.integers(-300, 300, (k, d)), rng.integers(-300, 300, (500, d))
        number, distance = clusters.Lists(cs).nearest(x)
        all_of = ((x[:, None] - cs) ** 2).sum(2)
        assert (number == all_of.argmin(1)).all() and (distance == all_of.min(1)).all()


def plain_trie(rows, heads=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in own.items()}
    built = own
    if heads:
        built = {}
        for c, ts in own.items():
            h = zlib.crc32(str(c).encode()) % 6
            built[c] = own.get(c - c % 100, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    out = []
    for node, cs in members.items():
        below = [m for m in members if m[:len(node)] == node]
        leaf = lambda m: not any(len(x) == len(m) + 1 and x[:len(m)] == m for x in below)
        ends = ",".join(map(str, sorted(c for c in cs if len(built[c]) == len(node))))
        out.append((
            min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), sum(len(m) == len(node) + 1 for m in below), sum(map(leaf, below)),
            sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found_trie(spark, rows, heads=True, **sizes):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"key": F.lit(1), "place": F.lit("x"), "n": F.lit(None).cast("int")})
    turns = trie.numbered_turns(df)
    return sorted((tuple(r) for r in trie.prefix_trie(*(trie.shared_heads(turns) if heads else trie.plain(turns)), **sizes).collect()), key=str)


def conversations(seed, n, longest, words):
    rng, rows = random.Random(seed), []
    for c in range(n):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(words)))
    return rows


@pytest.mark.parametrize("block,shard,least", [(32, 65_536, 256), (2, 65_536, 256), (3, 2, 1), (1, 1, 1)])
def test_trie_equals_plain(spark, block, shard, least):
    rows = conversations(4, 60, 9, ["a", "b", ""]) + [(300, t, "user", "a") for t in range(23)] + [(301, t, "user", "a") for t in range(23)]
    for heads in (True, False):
        assert found_trie(spark, rows, heads, block=block, shard=shard, least=least) == plain_trie(rows, heads)


def test_odd_conversations(spark):
    rows = [
        (1, 1, None, None), (1, None, "user", "x"), (1, None, "user", "x"), (2, 0, "user", "x"), (2, 0, "user", "x"), (None, 1, "user", "x"), (None, 2, "a", "b"),
        (205, 3, "user", "gone"), (5, 0, "", "one"), (-30, 1, "user", "below"), (100, 0, "assistant", "😀é"), (150, 0, "u", "v"), (150, 1, "assistant", "😀é"), (7, 0, "user", "word " * 20_000),
    ]
    assert not {0, -100} & {r[0] for r in rows}  # the base of -30, whichever way the remainder goes
    assert found_trie(spark, rows) == plain_trie(rows)
    assert found_trie(spark, [r for r in rows if r[0] is None]) == []


def test_copies_and_a_common_first_turn(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(400) for t in range(4)]
    rows += [(c, 0, "system", "be kind") for c in range(1000, 1300)] + [(c, 1, "user", f"ask {c % 50}") for c in range(1000, 1300)]
    assert found_trie(spark, rows, False, least=8, shard=16) == plain_trie(rows, False)


def test_turnless_conversations_belong_to_the_root(spark):
    # h of these is at least 1 and their base is absent, so nothing is left of one turn
    lone = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1][:4]
    rows = [(c, 0, "user", "x") for c in lone]
    assert found_trie(spark, rows) == plain_trie(rows)
    assert found_trie(spark, rows)[0][:7] == (lone[0], 0, None, 4, 0, 1, 0)


def test_double_array_holds_its_paths():
    rng = np.random.default_rng(2)
    for labels, width, n in ((3, 5, 200), (500, 3, 400), (1, 6, 10)):
        paths = rng.integers(0, labels, (n, width))
        lengths = rng.integers(1, width + 1, n)
        paths[np.arange(width) >= lengths[:, None]] = -1
        parent, label = trie._edges(paths)
        array = trie.DoubleArray(parent, label)
        assert len(set(array.slot.tolist())) == len(parent) + 1 == len({tuple(p[:d]) for p, m in zip(paths.tolist(), lengths) for d in range(m + 1)})
        at, met = np.zeros(n, np.int64), {}
        for d in range(width):
            rows = np.flatnonzero(paths[:, d] >= 0)
            at[rows] = array.step(at[rows], paths[rows, d])
            for r in rows:
                assert met.setdefault(int(at[r]), tuple(paths[r, :d + 1])) == tuple(paths[r, :d + 1])
    with pytest.raises(KeyError):
        array.step(np.array([0]), np.array([1]))

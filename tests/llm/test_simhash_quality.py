"""SimHash against all pairs; factorisation machine against its definition and on held-out labels."""

import itertools

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from snapflow.llm import quality, simhash
from snapflow.llm.common import components

SF = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks, radius=4):
    """marks: list of (doc_id, fingerprint)."""
    root = list(range(len(marks)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(marks)), 2):
        if (marks[i][1] ^ marks[j][1]).bit_count() <= radius:
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(marks):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [least.get(find(i)) for i in range(len(marks))]


def test_fingerprint_of_a_text():
    for text in ["", None, "One", "a b c d", "A  b\tC\nd E é f", "x " * 70_000, " ".join(map(str, range(500)))]:
        assert simhash.fingerprint_of(text) == plain_fingerprint(text)


@pytest.mark.parametrize("leaf", [8, 40, 10_000])
def test_vantage_shards_miss_no_pair(leaf):
    rng = np.random.default_rng(leaf)
    points = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    near = points[rng.integers(0, 400, 900)]
    for _ in range(3):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, 900, dtype=np.uint64))
    points = np.unique(np.concatenate([points, near]))
    root, shards = simhash.grow(points[::5], leaf)
    shard, row, own = simhash.visits(root, points)
    assert own.sum() == len(points) and shard.max() < shards
    home = dict(zip(row[own], shard[own]))
    seen = set(zip(shard, row))
    for i, j in itertools.combinations(range(len(points)), 2):
        if (int(points[i]) ^ int(points[j])).bit_count() <= 4:
            assert (home[i], j) in seen or (home[j], i) in seen
    linked = simhash.link_near(points, np.ones(len(points), bool))
    want = plain_components([(k, int(p)) for k, p in enumerate(points)])
    assert linked.tolist() == want


def test_near_duplicates_of_documents(spark):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(i, base + f" tail{i % 7}", 1) for i in range(60)]  # a dense group
    rows += [(100, None, 1), (101, "", 1), (None, "  \n", 1), (None, base + " tail1", 1), (200, "one two", 1), (201, "One  TWO", 1), (300, "alone " + "z y " * 40, 1), (300, "alone " + "z y " * 40, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.fp), r.component_id) for r in simhash.near_duplicates(docs).collect())
    marks = [(d, plain_fingerprint(t)) for d, t, _ in rows]
    want = sorted(
        ((d is None, d or 0, fp - (1 << 64) if fp >> 63 else fp), c) for (d, fp), c in zip(marks, plain_components(marks))
    )
    assert got == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c in plain_components(marks)})
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_near_duplicates_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = docs.select("doc_id", "text").collect()
    marks = [(r.doc_id, plain_fingerprint(r.text)) for r in texts[:400]]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs.filter(F.col("doc_id").isin([d for d, _ in marks]))).collect()}
    assert got == {d: c for (d, _), c in zip(marks, plain_components(marks))}


def test_components_of_a_long_path_and_a_hub(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1001 + i) for i in range(80)] + [(5, 5), (None, 3), (7, 2000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 2000: 0, **{1001 + i: 1000 for i in range(80)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    size = quality._WORDS + quality.DENSE
    model = quality.Model(0.3, rng.normal(size=size), rng.normal(size=(size, 4)))
    rows = [quality.features(t, n) for t, n in [("a b c a $$$", 11), ("Long words here, 12 of them", None), ("", float("nan"))]]
    starts = np.cumsum([0, *[len(i) for i, _ in rows]])[:-1]
    got, _ = quality.margins(model, np.concatenate([i for i, _ in rows]), np.concatenate([x for _, x in rows]), starts)
    for (ids, x), z in zip(rows, got):
        pairs = sum(
            model.v[a] @ model.v[b] * p * q for (a, p), (b, q) in itertools.combinations(zip(ids, x), 2)
        )
        assert z == pytest.approx(model.w0 + model.w[ids] @ x + pairs)


def test_features_do_not_depend_on_the_cut(monkeypatch):
    text = "Some words, some signs $$$ " * 500
    ids, x = quality.features(text, 3)
    monkeypatch.setattr(quality, "_PIECE", 100)
    again, y = quality.features(text, 3)
    assert dict(zip(ids, x)) == pytest.approx(dict(zip(again, y)))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality(docs, labels)
    tested = got.join(labels, "doc_id").filter("held_out").select("score", "predicted", "quality").toPandas()
    good, bad = tested.score[tested.quality == 1].to_numpy(), tested.score[tested.quality == 0].to_numpy()
    auc = (good[:, None] > bad).mean()
    assert auc > 0.97 and (tested.predicted == tested.quality).mean() > 0.95


def test_quality_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, 9.0), (1, None, None, 9.0), (None, "", 0, 1.0), (4, "word " * 100_000, -5, None), (5, "a $$$ b", 7, 0.0)],
        "doc_id long, text string, n_chars long, score double",
    )
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.quality(docs, none).collect()
    assert len(rows) == 5 and {(r.score, r.predicted) for r in rows} == {(0.5, 1)}
    some = spark.createDataFrame([(1, 1), (4, 0), (4, None), (None, 1), (99, 1), (5, 0)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.quality(docs, some).collect())
    assert quality.quality(docs.limit(0), some).collect() == []
    # zlib.crc32(b"1") % 3 and so on
    import zlib

    assert {r.doc_id: r.held_out for r in rows if r.doc_id} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in (1, 4, 5)}

"""Top-k against all products; archives against what was written."""

import base64
import hashlib
import math

import numpy as np
import pytest

from snapflow.llm import topk, warc
from snapflow.session import work_dir


def plain_top(rows, k, is_query):
    use = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    use = list({(i, tuple(v)) for i, v in use})
    out = {}
    for i, v in use:
        if is_query(i):
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in use if j != i)
            out[i] = [(r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("slices,dims,blocks", [(2, 8, 1 << 14), (3, 8, 7), (5, 3, 50), (2, 1, 20)])
def test_top_k_is_exact(spark, monkeypatch, slices, dims, blocks):
    monkeypatch.setattr(topk, "BLOCK", blocks)
    monkeypatch.setattr(topk, "QUERY_BLOCK", max(2, blocks // 4))
    rng = np.random.default_rng(dims * slices)
    rows = [(int(i), rng.normal(0, 0.2, dims).astype("f4").tolist()) for i in range(90)]
    rows += [(int(100 + i), rows[3][1]) for i in range(40)]  # equal vectors, ties across ids
    rows += [(200 + i, [0.0] * dims) for i in range(12)]
    rows += [rows[5], (300, None), (301, [float("nan")] * dims), (302, [float("inf")] + [0.0] * (dims - 1)), (303, [None] * dims), (None, [0.1] * dims)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = {}
    for r in topk.top_k(df, 5, lambda i: i % 10 == 0, slices=slices).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {q: sorted(v) for q, v in got.items()} == plain_top(rows, 5, lambda i: i % 10 == 0)


def test_top_k_of_few_and_of_unequal_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    every = lambda i: i >= 0
    assert topk.top_k(spark.createDataFrame([], schema), 5, every).collect() == []
    assert topk.top_k(spark.createDataFrame([(1, [1.0])], schema), 5, every).collect() == []
    two = topk.top_k(spark.createDataFrame([(1, [1.0]), (2, [-1.0])], schema), 5, every).collect()
    assert sorted(tuple(r) for r in two) == [(1, 1, 2, -65536), (2, 1, 1, -65536)]
    with pytest.raises(ValueError):
        topk.top_k(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema), 5, every)


def test_large_values_are_exact_or_refused():
    q, c = np.array([[1 << 30, 3]]), np.array([[1 << 30, 7], [-(1 << 31), 1]])
    (_, s), = topk.slice_scores(q, c)
    assert s.tolist() == [[(1 << 60) + 21, -(1 << 61) + 3]]
    with pytest.raises(OverflowError):
        list(topk.slice_scores(q << 20, c))


def test_empty_and_large_vectors(spark):
    schema, every = "vec_id long, embedding array<double>", lambda i: i >= 0
    none = spark.createDataFrame([(i, []) for i in range(8)] + [(9, None)], schema)
    got = sorted(tuple(r) for r in topk.top_k(none, 5, every).collect())
    assert got == [(q, r + 1, c, 0) for q in range(8) for r, c in enumerate([c for c in range(8) if c != q][:5])]
    # the products that are asked for fit a long, those of a vector with itself do not
    rows = [(0, [3e6] * 64), (1, [1.0] * 64), (2, [-1.0] * 64), (3, [0.5] * 64)]
    df = spark.createDataFrame(rows, schema)
    got = {}
    for r in topk.top_k(df, 5, every).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {q: sorted(v) for q, v in got.items()} == plain_top(rows, 5, every)
    with pytest.raises(Exception, match="fit|overflow"):
        topk.top_k(spark.createDataFrame([*rows, (4, [3e6] * 64)], schema), 5, every).collect()


PAGES = [
    (1, "http://a/", "same"), (2, "http://a b/\n", "same"), (3, None, "same"), (4, "u", None), (5, "u", ""), (6, "u", "é" * 300_000),
    (7, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"), (None, "u", "same"), (None, "v", "only"), (8, "u", "twice"), (8, "u", "twice"), (9, "w", "alone"),
]


@pytest.mark.parametrize("least", [0, 1, 5])
def test_archives(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "FRAME_BYTES", 300)
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, record_type string")
    root = warc.as_uri(work_dir(spark, "warc"))
    index = warc.write_archives(pages, root, least)
    got = sorted(((r.page_id is None, r.page_id or 0, r.url or "", r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(index, root).collect()), key=str)
    want = []
    for page_id, url, html in PAGES:
        data = (html or "").encode()
        ids = [p for p, _, h in PAGES if (h or "").encode() == data and p is not None]
        keeper = max(ids, default=None) if len(data) >= least else None
        revisit = keeper is not None and keeper != page_id
        seen = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
        want.append((page_id is None, page_id or 0, seen, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", keeper if revisit else None))
    assert got == sorted(want, key=str)
    payloads = {r.page_id: r.payload for r in warc.read_archives(index, root, payloads=True).collect() if r.record_type == "response" and r.page_id}
    assert all(bytes(payloads[p]) == (h or "").encode() for p, _, h in PAGES if p in payloads)
    one = warc.read_record(spark, index, root, 6)
    assert one[0] == 6 and one[6] == ("é" * 300_000).encode()
    assert warc.read_record(spark, index, root, 12345) is None


def test_empty_archives(spark):
    root = warc.as_uri(work_dir(spark, "warc"))
    index = warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), root)
    assert warc.read_archives(index, root).collect() == []


def test_frames_are_plain_zstandard(tmp_path):
    import zstandard

    w = warc.BundleWriter(f"file://{tmp_path}")
    records = [warc.warc_record(i, "u", b"p" * i, warc.payload_digest(b"p" * i), None, False, "1970-01-01T00:00:00Z") for i in range(50)]
    for r in records:
        w.add(r)
    w.close()
    raw = (tmp_path / w.name).read_bytes()
    # any reader of the format passes over the seek table
    assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read() == b"".join(records)

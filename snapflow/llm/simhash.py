"""SimHash near-duplicates: 64-bit fingerprints joined exactly through vantage-point trees."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapflow.llm.common import components, small_batches
from snapflow.session import cut

WORDS = 4
SEED = 42  # of the shingle hash
RADIUS = 4
#: Fingerprints a shard should own; the tree over a sample is cut to such shards.
SHARD = 65_536
#: At most so many fingerprints, of the smallest hashes, are gathered to grow the tree.
SAMPLE = 16_384
_PART = 1 << 16
_FULL = 1 << 22  # pairs compared at once without splitting further


def bits_set(hashes) -> np.ndarray:
    """How many of some 64-bit hashes have each bit set, the highest bit first."""
    return np.unpackbits(np.asarray(hashes, ">u8").view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def majority(total: np.ndarray, n: int) -> int:
    """The number whose bits are those set in over half of ``n`` hashes."""
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def fingerprint_of(text: str | None, k: int = WORDS) -> int:
    """SimHash of a text as unsigned number; texts without words give 0.

    Words are runs of anything but ASCII white space, A-Z in lower case, and
    shingles count as often as they occur.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    k = min(k, len(words))
    line = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    hash_of = xxhash.xxh64_intdigest
    total, n = np.zeros(64, np.int64), len(words) - k + 1
    for at in range(0, n, _PART):
        total += bits_set(
            [hash_of(line[a:b - 1], SEED) for a, b in zip(starts[at:at + _PART], ends[at + k - 1:at + k - 1 + _PART])]
        )
    return majority(total, n)


def fingerprint(text: Column | str) -> Column:
    """Signed 64-bit SimHash of a text column; null counts as empty (0)."""

    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t) for t in texts], np.uint64).view(np.int64))

    return fingerprints(text)


def as_hex(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@dataclass
class Node:
    """Inside: fingerprints up to ``limit`` bits from ``point``; outside: the others."""

    point: int
    limit: int
    inside: "Node | int"  # a shard number, or a further node
    outside: "Node | int"


def distance(points: np.ndarray, point) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(point)).astype(np.int64)


def _split(points: np.ndarray):
    """The vantage point, of a few, whose median splits best with least overlap; None if none splits."""
    best = None
    for point in points[np.linspace(0, len(points) - 1, min(8, len(points))).astype(int)]:
        d = distance(points, point)
        limit = int(np.median(d))
        inside = int((d <= limit).sum())
        if inside == len(points):
            limit -= 1
            inside = int((d <= limit).sum())
        if not 0 < inside < len(points):
            continue
        overlap = int(((d > limit - RADIUS) & (d <= limit + RADIUS)).sum())
        cost = max(inside, len(points) - inside) + overlap
        if best is None or cost < best[0]:
            best = cost, int(point), limit
    return best and best[1:]


def grow(sample: np.ndarray, leaf: int) -> tuple["Node | int", int]:
    """Tree over a bounded sample with leaves of about ``leaf`` of its points, and the number of leaves."""
    count = itertools.count()

    def build(points: np.ndarray):
        found = _split(points) if len(points) > max(leaf, 8) else None
        if not found:
            return next(count)
        point, limit = found
        d = distance(points, point)
        return Node(point, limit, build(points[d <= limit]), build(points[d > limit]))

    root = build(sample)
    return root, next(count)


def visits(root: "Node | int", points: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, row, own): each point's own shard, and the later shards whose points may lie within ``radius``.

    A branch is left out when the triangle bound puts all of it beyond the
    radius. Shards before a point's own are left out too, as there the other
    point of the pair makes the visit.
    """
    out: list[tuple[int, np.ndarray, np.ndarray]] = []

    def walk(node, rows, own):
        if not len(rows):
            return
        if not isinstance(node, Node):
            out.append((node, rows, own))
            return
        d = distance(points[rows], node.point)
        home = d <= node.limit
        inside, outside = d <= node.limit + radius, d > node.limit - radius
        # inside shards have the smaller numbers: whoever lives outside need not visit them
        keep = inside & (home | ~own)
        walk(node.inside, rows[keep], (own & home)[keep])
        walk(node.outside, rows[outside], (own & ~home)[outside])

    walk(root, np.arange(len(points)), np.ones(len(points), bool))
    if not out:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool)
    shard = np.concatenate([np.full(len(r), s, np.int32) for s, r, _ in out])
    return shard, np.concatenate([r for _, r, _ in out]), np.concatenate([o for *_, o in out])


class Forest:
    """Union of numbered points, many pairs at a time."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        x = self.parent[x]
        while True:
            up = self.parent[x]
            if (up == x).all():
                return x
            x = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            apart = a != b
            a, b = a[apart], b[apart]
            if len(a):  # of several links of a root the smallest wins, the others come again
                np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def link_near(points: np.ndarray, own: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Root of every point of a shard, pairs of own points with any point within ``radius`` linked.

    A local vantage-point tree: splits go on while both sides get smaller, then
    all pairs of a leaf are compared.
    """
    forest = Forest(len(points))

    def leaf(a, b):
        step = max(1, (1 << 18) // max(len(b), 1))
        for i in range(0, len(a), step):
            near = np.bitwise_count(points[a[i:i + step], None] ^ points[None, b]) <= radius
            x, y = np.nonzero(near)
            x, y = a[i:i + step][x], b[y]
            forest.link(x[x != y], y[x != y])

    def walk(a, b):
        if not len(a) or not len(b):
            return
        found = _split(points[a[np.linspace(0, len(a) - 1, min(len(a), 512)).astype(int)]]) if len(a) * len(b) > _FULL else None
        if not found:
            return leaf(a, b)
        point, limit = found
        da, db = distance(points[a], point), distance(points[b], point)
        parts = (a[da <= limit], b[db <= limit + radius]), (a[da > limit], b[db > limit - radius])
        if sum(len(x) * len(y) for x, y in parts) > 0.95 * len(a) * len(b):
            return leaf(a, b)
        for part in parts:
            walk(*part)

    walk(np.flatnonzero(own), np.arange(len(points)))
    return forest.find(np.arange(len(points)))


def near_links(fps: DataFrame, radius: int = RADIUS, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """Links (a, b) between distinct fingerprints that join all within ``radius`` bits.

    ``fps`` has one row a fingerprint. The tree comes from a bounded sample; all
    fingerprints go to the shard of their own leaf, and to those later ones that
    the triangle bound cannot rule out. A shard returns a spanning forest of its
    pairs, at most one row a point, never the pairs themselves: distinct
    fingerprints within 4 bits of one another are bounded in number, and so is
    what a shard holds of a dense group.
    """
    spark = fps.sparkSession
    n = fps.count()
    picked = [r[0] for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()]
    points = np.array(picked, np.int64).view(np.uint64)
    root, shards = grow(points, max(8, round(len(points) * shard / max(n, 1))))
    tree = spark.sparkContext.broadcast(root)  # fewer nodes than the sample

    def deal(batches):
        def out(part):
            fp = np.concatenate(part)
            to, row, own = visits(tree.value, fp.view(np.uint64), radius)
            return pd.DataFrame({"shard": to, "fp": fp[row], "own": own})

        part, size = [], 0
        for pdf in batches:
            part.append(pdf["fp"].to_numpy(np.int64))
            size += len(pdf)
            if size >= _PART:
                yield out(part)
                part, size = [], 0
        if part:
            yield out(part)

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        points = pdf["fp"].to_numpy(np.int64)
        roots = link_near(points.view(np.uint64), pdf["own"].to_numpy(), radius)
        linked = roots != np.arange(len(points))
        return pd.DataFrame({"a": points[linked], "b": points[roots[linked]]})

    dealt = fps.select("fp").mapInPandas(deal, "shard int, fp long, own boolean")
    return dealt.groupBy("shard").applyInPandas(join, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, tkey, fp, root and component_id (smallest doc_id reachable) of every document.

    ``tkey`` is a hash of the text, which tells rows of one id apart, and ``root`` the
    component's smallest fingerprint.

    Documents without words, null texts among them, have fingerprint 0 and are
    linked like any other. Repeated rows are copies. A null doc_id is never the
    smallest; a component of null ids only has a null component. Equal
    fingerprints are one point, so copies are never compared.
    """
    small_batches(docs.sparkSession)
    marks = cut(docs.select("doc_id", F.xxhash64("text").alias("tkey"), fingerprint("text").alias("fp")))
    points = cut(marks.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(near_links(points, radius))
    labelled = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    groups = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    # a fingerprint of very many copies is one key of this join, which adaptive execution splits
    by_fp = labelled.select("fp", "root").join(groups, "root").select("fp", "root", "component_id")
    return marks.join(cut(by_fp), "fp").select("doc_id", "tkey", "fp", "root", "component_id")


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with one row of each root of ``found`` (doc_id, tkey, root): the smallest id, given ones before null, then the smallest text hash."""
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tkey"))
    # a struct compares null ids as equal
    stay = found.groupBy("root").agg(best.alias("b")).select(F.struct("b.doc_id", "b.tkey").alias("_key"))
    rows = docs.select(F.struct("*").alias("_row"), F.struct("doc_id", F.xxhash64("text").alias("tkey")).alias("_key"))
    first = Window.partitionBy("_key").orderBy(F.col("_key.tkey"))
    kept = rows.join(stay, "_key", "left_semi").withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, see ``first_of_each``."""
    return first_of_each(docs, near_duplicates(docs, radius))

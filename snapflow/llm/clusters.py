"""Clustering of integer vectors around centroids, the nearest found by the threshold algorithm."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.session import cut

DIMS, CENTROIDS, ROUNDS, SALT = 64, 40, 5, 2
#: Components up to here have squared distances that fit a long; beyond, Python's integers count.
SMALL = 1 << 26
_LIMB = 40  # bits of the parts in which sums are added up
_LONG = 1 << 63


def whole_vectors(rows: DataFrame, dims: int = DIMS) -> DataFrame:
    """vec_id and embedding of the vectors with ``dims`` components, none null, NaN or infinite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select("vec_id", "embedding").filter((F.size("embedding") == dims) & F.coalesce(finite, F.lit(False)))


def as_integers(rows) -> np.ndarray:
    """floor(256 * x) of every component: longs, or Python's integers where one is beyond ``SMALL``."""
    x = np.stack([np.asarray(r, np.float64) for r in rows])
    if np.abs(x).max(initial=0) < SMALL / 256:
        return np.floor(x * 256).astype(np.int64)
    # 256 * x may be beyond a double; a double from 2^53 on is a whole number
    return np.array([[int(v) * 256 if abs(v) >= 1 << 53 else int(np.floor(v * 256)) for v in r.tolist()] for r in x], object)


def as_array(centroids: list[list[int]]) -> np.ndarray:
    large = max((abs(v) for c in centroids for v in c), default=0) >= SMALL
    return np.array(centroids, object if large else np.int64)


class Lists:
    """The centroids of every dimension in the order of their values."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, x: np.ndarray, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """``walk`` over some rows at a time, so that what they meet stays near the processor."""
        parts = [self.walk(x[i:i + rows]) for i in range(0, len(x), rows)]
        return np.concatenate([n for n, _ in parts]), np.concatenate([d for _, d in parts])

    def walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of each row of ``x``, the smaller number of equally near ones, and the squared distance.

        Each dimension's list is walked outward from the row's value, one centroid a step. Centroids met get
        their exact distance. What no list has shown is at least as far as the squares of the frontier
        distances add up to, so a row stops once that sum is beyond its best distance.
        """
        if self.centroids.dtype == object or x.dtype == object:
            x, centroids, values = x.astype(object), self.centroids.astype(object), self.values.astype(object)
        else:
            centroids, values = self.centroids, self.values
        (n, dims), k = x.shape, len(centroids)
        none = _LONG - 1 if x.dtype == np.int64 else 1 << 5000  # farther than any distance
        right = np.stack([np.searchsorted(values[:, d], x[:, d]) for d in range(dims)], axis=1)
        left = right - 1
        exact = np.full((n, k), none, x.dtype)
        met, walking, dim = np.zeros((n, k), bool), np.arange(n), np.arange(dims)
        for _ in range(k):
            at, lo, hi = x[walking], left[walking], right[walking]
            below = np.where(lo >= 0, at - values[np.maximum(lo, 0), dim], none)
            above = np.where(hi < k, values[np.minimum(hi, k - 1), dim] - at, none)
            down = below <= above
            shown = self.order[np.where(down, lo, hi), dim]
            left[walking], right[walking] = lo - down, hi + ~down
            new = np.zeros((len(walking), k), bool)
            new[np.arange(len(walking))[:, None], shown] = True
            row, c = np.nonzero(new & ~met[walking])
            met[walking] |= new
            apart = at[row] - centroids[c]
            exact[walking[row], c] = np.einsum("ij,ij->i", apart, apart) if x.dtype != object else (apart**2).sum(axis=1)
            frontier = (np.where(down, below, above) ** 2).sum(axis=1)
            walking = walking[~(frontier > exact[walking].min(axis=1)).astype(bool)]
            if not len(walking):
                break
        number = np.argmin(exact, axis=1)
        return number, exact[np.arange(n), number]


def _sums(vectors: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum of every non-empty cluster.

    A task adds up its own vectors and hands out one row for each cluster, dimension and 40 bits of the sum;
    those rows are added up by the aggregate. As many reach the driver as the centroids have components.
    """
    given, dims = centroids, len(centroids[0])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lists, total = Lists(as_array(given)), {}
        for pdf in batches:
            if not len(pdf):
                continue
            x = as_integers(pdf["embedding"])
            number, _ = lists.nearest(x)
            for c in np.unique(number):
                own = x[number == c]
                n, old = total.get(int(c), (0, [0] * dims))
                total[int(c)] = n + len(own), [a + int(b) for a, b in zip(old, own.sum(axis=0))]
        rows = []
        for c, (n, sums) in total.items():
            for d, value in [(-1, n), *enumerate(sums)]:
                limb = 0
                while True:
                    top = -1 << _LIMB <= value < 1 << _LIMB
                    rows.append((c, d, limb, value if top else value & (1 << _LIMB) - 1))
                    if top:
                        break
                    value, limb = value >> _LIMB, limb + 1
        yield pd.DataFrame(rows, columns=["cluster", "dim", "limb", "part"])

    parts = vectors.select("embedding").mapInPandas(partial, "cluster int, dim int, limb int, part long")
    found: dict[int, list[int]] = {}
    for r in parts.groupBy("cluster", "dim", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s")).collect():
        found.setdefault(r.cluster, [0] * (dims + 1))[r.dim] += int(r.s) << _LIMB * r.limb  # dim -1 is the last place
    return {c: (sums[-1], sums[:-1]) for c, sums in found.items()}


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, salt: int = SALT) -> list[list[int]]:
    """The k vectors with the smallest SHA-256 of ``salt:vec_id``, in that order; of one id in the order of their components."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(key.asc_nulls_last(), "embedding").limit(k).collect()
    return [[int(v) for v in as_integers([r.embedding])[0]] for r in rows]


def cluster(rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, salt: int = SALT) -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster and squared distance of every whole vector, and the final centroids.

    Components x count as floor(256 * x). Each round assigns every vector to its nearest centroid and
    replaces every non-empty centroid by the componentwise floor of the mean; then vectors are assigned
    once more. All numbers are exact. k centroids and their sums are all that reaches the driver.

    Vectors that are null, of another length, or hold a null or a non-finite component are left out. Repeated
    rows are vectors of their own; those without an id come last in the choice of the first centroids. With fewer
    than k vectors each is a centroid; without any there are no rows. A squared distance beyond a long is null.
    """
    vectors = whole_vectors(rows, dims)
    centroids = first_centroids(vectors, k, salt)
    kind = rows.schema["vec_id"].dataType.simpleString()
    if not centroids:
        return vectors.select("vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")), []
    for _ in range(rounds):
        for c, (n, sums) in _sums(vectors, centroids).items():
            centroids[c] = [s // n for s in sums]
    final = centroids

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lists = Lists(as_array(final))
        for pdf in batches:
            if not len(pdf):
                continue
            number, distance = lists.nearest(as_integers(pdf["embedding"]))
            yield pd.DataFrame({
                "vec_id": pdf["vec_id"], "cluster": number,
                "distance": pd.array([int(d) if d < _LONG else None for d in distance], "Int64"),
            })

    # ids as they are: pandas would make floats of integers beside nulls
    plain = vectors.select(F.col("vec_id").cast("string").alias("vec_id"), "embedding")
    found = plain.mapInPandas(assign, "vec_id string, cluster int, distance long")
    return found.withColumn("vec_id", F.col("vec_id").cast(kind)), final


def with_inertia(found: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``found`` with the inertia of its cluster and of all, and its centroid's digest; a sum beyond a long, or of a null, is null."""
    spark, found = found.sparkSession, cut(found)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    known = spark.createDataFrame([(c, d) for c, d in enumerate(digests)], "cluster int, centroid_sha256 string")
    none = F.count_if(F.col("distance").isNull())
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), none.alias("none"))
    total = sums.agg(F.when(F.sum("none") == 0, F.sum("s")).alias("t"))
    per = sums.withColumn("t", total.scalar()).select(
        "cluster", F.when(F.col("none") == 0, F.col("s")).try_cast("long").alias("cluster_inertia"), F.col("t").try_cast("long").alias("inertia"),
    )
    # as many rows as centroids
    return found.join(F.broadcast(per.join(known, "cluster")), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

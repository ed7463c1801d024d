"""Exact top-k inner products by a three-phase uniform threshold over slices of the vectors.

A vector is cut into slices of dimensions, each held by nodes of its own; a score
is the sum of its slice scores. Phase 1 gathers each slice's best entries of a
query, whose exact sums give a lower bound of the k-th score, and that bound
split evenly over the slices is a cutoff no winner can miss in all of them. Phase 2
collects every entry at or above the cutoff. Phase 3 drops candidates whose upper
bound is too low and resolves the missing slice scores of the rest exactly.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapflow.session import cut

SLICES = 2
#: Vectors and queries a node works on at once.
BLOCK = 16_384
QUERY_BLOCK = 4_096
_CHUNK = 1 << 21  # scores in memory at once
_EXACT = 1 << 53
_LONG = 1 << 63
_NONE = np.zeros(0, np.int64)


def whole_numbers(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, v) with v = floor(scale * x) of each component as array<long>.

    Rows with a null id, a null vector, or a component that is null or not finite
    are left out.
    """
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return vectors.filter(F.col(key).isNotNull() & x.isNotNull() & ~bad).select(
        F.col(key).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long")).alias("v"),
    )


def classes(points: DataFrame, members: int) -> DataFrame:
    """Equal vectors as one: (cls, v, ids), cls the smallest id, ids the ``members`` smallest ids.

    Ranks are pruned before the shuffle, so a vector that very many rows share
    sends a few rows a task.
    """
    order = Window.partitionBy("v").orderBy("id")
    few = points.distinct().withColumn("r", F.row_number().over(order)).filter(F.col("r") <= members)
    grouped = few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return grouped.select(F.element_at("ids", 1).alias("cls"), "v", "ids")


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _largest(rows: np.ndarray) -> np.ndarray:
    return np.abs(rows.astype(np.float64)).max(axis=1, initial=0)


def slice_scores(q: np.ndarray, c: np.ndarray, own: tuple[np.ndarray, np.ndarray] = (_NONE, _NONE)):
    """Blocks (first query, scores): exact integer scores of some queries with all candidates.

    ``own`` are pairs (row, column) that nobody asks for; their score is the row's lowest other one, whatever their
    product. A product beyond a long raises only for another pair.
    """
    per_q, per_c = _largest(q), _largest(c)
    bound = float(per_q.max(initial=0)) * float(per_c.max(initial=0)) * max(q.shape[1], 1)
    if bound < _EXACT:  # all sums are whole doubles
        q, c = q.astype(np.float64), c.astype(np.float64)
    ct = c.T
    step = max(1, _CHUNK // max(len(c), 1))
    for at in range(0, len(q), step):
        here = q[at:at + step]
        scores = (here @ ct).astype(np.int64)
        mine = (own[0] >= at) & (own[0] < at + len(here))
        rows, columns = own[0][mine] - at, own[1][mine]
        if bound >= 2.0**62:  # int64 sums may have gone round for large vectors: those pairs again, by Python's integers
            large = per_q[at:at + step, None] * per_c * max(q.shape[1], 1) >= 2.0**62
            large[rows, columns] = False
            for x, y in zip(*np.nonzero(large)):
                exact = sum(a * b for a, b in zip(here[x].tolist(), c[y].tolist()))
                if not -_LONG <= exact < _LONG:
                    raise OverflowError("an inner product does not fit in 64 bits")
                scores[x, y] = exact
        if len(rows) and scores.shape[1] > 1:
            scores[rows, columns] = np.iinfo(np.int64).max
            scores[rows, columns] = scores[rows].min(axis=1)
        elif len(rows):
            scores[rows, columns] = 0
        yield at, scores


def _own(q: np.ndarray, alone: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the queries that meet themselves among the candidates and have no equal."""
    order = np.argsort(c, kind="stable")
    at = np.minimum(np.searchsorted(c, q, sorter=order), len(c) - 1)
    rows = np.flatnonzero(alone & (c[order[at]] == q))
    return rows, order[at[rows]]


def _nodes(points: DataFrame, queries: DataFrame, width: int, slices: int):
    """Both sides dealt to nodes (slice, query block, block); a vector's slice goes once to each query block."""
    def blocks(n: int, size: int) -> int:
        return max(1, -(-n // size))

    n_blocks, q_blocks = blocks(points.count(), BLOCK), blocks(queries.count(), QUERY_BLOCK)
    cuts = np.linspace(0, width, slices + 1).astype(int)
    parts = F.array(*[
        F.struct(F.lit(s).alias("slice"), F.slice("v", int(lo) + 1, int(hi - lo)).alias("part"))
        for s, (lo, hi) in enumerate(zip(cuts, cuts[1:]))
    ])

    def deal(df: DataFrame, own: str, n: int, other: str, m: int, *more: str) -> DataFrame:
        return (
            df.select("cls", *more, F.explode(parts).alias("p"), F.pmod(F.xxhash64("cls"), F.lit(n)).cast("int").alias(own))
            .select("cls", *more, "p.*", own, F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))
        )

    def nodes(more: DataFrame | None = None, *names: str):
        asked = queries if more is None else queries.join(more, "cls")
        return (
            deal(points.select("cls", "v"), "block", n_blocks, "q_block", q_blocks),
            deal(asked, "q_block", q_blocks, "block", n_blocks, "alone", *names),
        )

    return nodes


_KEY = ["slice", "q_block", "block"]


def _lists(nodes, keep: int) -> DataFrame:
    """Phase 1: of each node and query the ``keep`` best entries, and the lowest score met."""
    points, queries = nodes()
    schema = pa.schema([("slice", pa.int32()), ("q", pa.int64()), ("c", pa.int64()), ("s", pa.int64()), ("low", pa.int64())])

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            slice_no = key[0].as_py()
            c, q = left["cls"].to_numpy(), right["cls"].to_numpy()
            width = len(right["part"][0])
            own = _own(q, right["alone"].to_numpy(), c)
            for at, scores in slice_scores(_matrix(right["part"], width), _matrix(left["part"], width), own):
                k = min(keep, scores.shape[1])
                best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                rows = np.arange(len(scores))
                qs = np.repeat(q[at:at + len(scores)], k)
                low = np.repeat(scores.min(axis=1), k)
                s = scores[rows[:, None], best].ravel()
                out.append(pa.table([np.full(len(qs), slice_no, np.int32), qs, c[best].ravel(), s, low], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return queries_of(points, queries, run, "slice int, q long, c long, s long, low long")


def queries_of(points: DataFrame, queries: DataFrame, run, schema: str) -> DataFrame:
    return points.groupBy(*_KEY).cogroup(queries.groupBy(*_KEY)).applyInArrow(run, schema)


def _collected(nodes, cutoffs: DataFrame) -> DataFrame:
    """Phase 2: all entries at or above the query's cutoff in their slice."""
    points, queries = nodes(cutoffs, "cutoffs")
    schema = pa.schema([("slice", pa.int32()), ("q", pa.int64()), ("c", pa.int64()), ("s", pa.int64())])

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            slice_no = key[0].as_py()
            c, q = left["cls"].to_numpy(), right["cls"].to_numpy()
            width = len(right["part"][0])
            least = np.array([row[slice_no] for row in right["cutoffs"].to_pylist()], np.int64)
            own = _own(q, right["alone"].to_numpy(), c)
            for at, scores in slice_scores(_matrix(right["part"], width), _matrix(left["part"], width), own):
                x, y = np.nonzero(scores >= least[at:at + len(scores), None])
                out.append(pa.table([np.full(len(x), slice_no, np.int32), q[at + x], c[y], scores[x, y]], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return queries_of(points, queries, run, "slice int, q long, c long, s long")


def _resolved(pairs: DataFrame, cls: DataFrame) -> DataFrame:
    """Exact scores of pairs of classes (q, c); a vector without an equal is no candidate of its own."""
    product = F.aggregate(F.zip_with("vq", "vc", lambda x, y: x * y), F.lit(0).cast("long"), lambda t, x: t + x)
    return (
        pairs.join(cls.select(F.col("cls").alias("q"), F.col("v").alias("vq"), (F.size("ids") == 1).alias("alone")), "q")
        .filter(~(F.col("alone") & (F.col("q") == F.col("c"))))
        .join(cls.select(F.col("cls").alias("c"), F.col("v").alias("vc")), "c")
        .select("q", "c", product.alias("score"))
    )


def top_k(vectors: DataFrame, k: int, is_query, key: str = "vec_id", vector: str = "embedding", slices: int = SLICES) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each query, its own row left out.

    ``is_query`` is a condition on the id. Scores are inner products of whole
    numbers; ties go to the smaller id, and fewer than k candidates give fewer
    rows. Vectors that cannot take part (see ``whole_numbers``) are left out, as
    are repeated rows; vectors of several lengths raise. Empty vectors score 0 with each other. A score
    that does not fit a long raises if it is asked for; a query's product with itself is not. Equal vectors are scored
    once: of a class of equals at most k + 1 ids can appear in a list, since all
    but the query's own tie and the smallest win.
    """
    points = cut(whole_numbers(vectors, key, vector))
    widths = [r[0] for r in points.select(F.size("v").alias("w")).distinct().limit(2).collect()]
    result = "query_id long, rank int, vec_id long, score long"
    if not widths:
        return vectors.sparkSession.createDataFrame([], result)
    if len(widths) > 1:
        raise ValueError("vectors of several lengths")
    width, slices = widths[0], max(1, min(slices, widths[0]))
    cls = cut(classes(points, k + 1))
    # every query with the class of its vector; equal queries are asked once
    asked = cut(points.filter(is_query(F.col("id"))).distinct().join(cls.select("cls", "v"), "v").select(F.col("id").alias("query_id"), "cls"))
    queries = cut(asked.select("cls").distinct().join(cls.select("cls", "v", (F.size("ids") == 1).alias("alone")), "cls"))
    nodes = _nodes(cls, queries, width, slices)
    keep = k + 1

    # phase 1: the entries met are resolved at once, as the bound of a sum with unknown, possibly negative parts is loose
    lists = cut(_lists(nodes, keep + 1))  # one of them may be the query itself
    lows = lists.groupBy("q").pivot("slice", list(range(slices))).agg(F.min("low"))
    met = _resolved(lists.select("q", "c").distinct(), cls)
    rank = Window.partitionBy("q").orderBy(F.desc("score"))
    bound = met.withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= keep).groupBy("q").agg(
        F.min("score").alias("least"), F.count(F.lit(1)).alias("n")
    )
    # above the slices' lowest scores, an entry under 1/slices of the rest everywhere sums to less than ``least``
    low = [F.col(str(s)) for s in range(slices)]
    rest = F.col("least") - reduce(add, low)
    share = F.when(F.col("n") >= keep, F.floor((rest + (slices - 1)) / slices)).otherwise(F.lit(0)).cast("long")
    cutoffs = cut(
        lows.join(bound, "q").select(
            F.col("q").alias("cls"), F.array(*[share + x for x in low]).alias("cutoffs"), F.array(*low).alias("lows")
        )
    )

    # phase 2
    entries = cut(_collected(nodes, cutoffs.select("cls", "cutoffs")))

    # phase 3: what is known plus, for missing slices, the lowest and the cutoff bound the score
    seen = entries.groupBy("q", "c").agg(F.map_from_entries(F.collect_list(F.struct("slice", "s"))).alias("have"))
    seen = seen.join(cutoffs.withColumnRenamed("cls", "q"), "q")
    known_sum = sum(F.coalesce(F.col("have")[s], F.lit(0)) for s in range(slices))
    lower = known_sum + sum(F.when(F.col("have")[s].isNull(), F.col("lows")[s]).otherwise(0) for s in range(slices))
    upper = known_sum + sum(F.when(F.col("have")[s].isNull(), F.col("cutoffs")[s]).otherwise(0) for s in range(slices))
    bounds = seen.select("q", "c", "have", lower.alias("lower"), upper.alias("upper"))
    by_lower = Window.partitionBy("q").orderBy(F.desc("lower"))
    safe = bounds.withColumn("r", F.row_number().over(by_lower)).filter(F.col("r") == keep).select("q", F.col("lower").alias("safe"))
    alive = bounds.join(safe, "q", "left").filter(F.col("safe").isNull() | (F.col("upper") >= F.col("safe")))
    whole = F.size("have") == slices
    alive = alive.select("q", "c", whole.alias("whole"), "lower")
    missing = _resolved(alive.filter(~F.col("whole")).select("q", "c"), cls)
    scored = alive.filter("whole").select("q", "c", F.col("lower").alias("score")).unionByName(missing)

    # classes to ids: ties of classes are settled by id, so all classes that reach the list are kept
    by_score = Window.partitionBy("q").orderBy(F.desc("score"))
    short = cut(scored.withColumn("r", F.rank().over(by_score)).filter(F.col("r") <= keep).select("q", "c", "score"))
    ids = cls.select(F.col("cls").alias("c"), "ids")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    lists = (
        short.join(ids, "c").select("q", "score", F.explode("ids").alias("vec_id"))
        .withColumn("r", F.row_number().over(best)).filter(F.col("r") <= keep)
        .groupBy("q").agg(F.collect_list(F.struct("r", "vec_id", "score")).alias("list"))
    )
    # the k + 1 best of a query's vector, then the query's own row goes
    own = asked.join(lists.withColumnRenamed("q", "cls"), "cls").select(
        "query_id", F.array_sort(F.filter("list", lambda e: e["vec_id"] != F.col("query_id"))).alias("list")
    )
    return own.select("query_id", F.posexplode(F.slice("list", 1, k)).alias("rank", "e")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("e.vec_id").alias("vec_id"), F.col("e.score").alias("score")
    )

"""Quality scores from a factorisation machine over hashed words, structure and length.

    score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2])

The bracket is the sum-of-squares identity: all pairwise interactions in time
linear in the number of distinct words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import small_batches

BITS = 15
RANK = 8
#: At most so many labelled rows are gathered for training, chosen by a hash of their id.
SAMPLE = 4000
EPOCHS = 8
BATCH = 64
_WORDS = 1 << BITS
_TOKEN = re.compile(r"\w+|[^\w\s]")
_PIECE = 1 << 20
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
#: Number of dense features, see ``structure``.
DENSE = 9


@dataclass
class Model:
    w0: float
    w: np.ndarray  # one weight a feature
    v: np.ndarray  # features x rank


def structure(words: Counter, chars: int, upper: int, lines: int, n_chars: float) -> list[float]:
    """Shape of a text, each value about 0 to 1; ``n_chars`` is the table's own column (0 if null)."""
    n = sum(words.values())
    signs = sum(c for w, c in words.items() if not (w[0].isalnum() or w[0] == "_"))
    digits = sum(c for w, c in words.items() if w[0].isdigit())
    longest = max(words.values(), default=0)
    letters = sum(len(w) * c for w, c in words.items())
    return [
        signs / max(n, 1),
        digits / max(n, 1),
        upper / max(chars, 1),
        len(words) / max(n, 1),
        longest / max(n, 1),
        min(letters / max(n, 1) / 20, 1.0),
        min(np.log1p(n) / 12, 1.0),
        min(np.log1p(n / max(lines, 1)) / 8, 1.0),
        min(np.log1p(max(n_chars, 0.0)) / 16, 1.0),
    ]


def features(text: str | None, n_chars) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and values of a whole text: log counts of hashed words at unit length, then structure."""
    text = text or ""
    words: Counter = Counter()
    upper = 0
    at = 0
    while at < len(text):  # by parts that end at white space, so that long texts stay bounded
        end = at + _PIECE
        while end < len(text) and not text[end].isspace():
            end += 1
        part = text[at:end]
        words.update(_TOKEN.findall(part.lower()))
        upper += len(_UPPER.findall(part))
        at = end
    hashed: dict[int, int] = {}
    for word, count in words.items():
        key = zlib.crc32(word.encode("utf-8", "replace")) & (_WORDS - 1)
        hashed[key] = hashed.get(key, 0) + count
    ids = np.fromiter(hashed.keys(), np.int64, len(hashed))
    x = np.log1p(np.fromiter(hashed.values(), np.float64, len(hashed)))
    if len(x):
        x /= np.sqrt((x * x).sum())
    given = 0.0 if n_chars is None or n_chars != n_chars else float(n_chars)
    dense = structure(words, len(text), upper, text.count("\n") + 1, given)
    return np.concatenate([ids, _WORDS + np.arange(DENSE)]), np.concatenate([x, dense])


def margins(model: Model, ids: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Raw scores of the rows whose features begin at ``starts``, and their factor sums."""
    vx = model.v[ids] * x[:, None]
    total = np.add.reduceat(vx, starts, axis=0)
    pairs = (total**2 - np.add.reduceat(vx**2, starts, axis=0)).sum(axis=1) / 2
    return model.w0 + np.add.reduceat(model.w[ids] * x, starts) + pairs, total


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Adagrad on log loss over a bounded list of (ids, values, label).

    No rows give the score 0.5 to every text; rows of one label give its share.
    """
    rng = np.random.default_rng(seed)
    size = _WORDS + DENSE
    good = sum(label for *_, label in rows)
    w0 = float(np.log((good + 1) / (len(rows) - good + 1)))
    model = Model(w0, np.zeros(size), rng.normal(0, 0.02, (size, RANK)))
    if not 0 < good < len(rows):
        model.v[:] = 0
        return model
    grad0, grads_w, grads_v = 1.0, np.full(size, 1e-2), np.full((size, RANK), 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for b in range(0, len(order), BATCH):
            part = [rows[i] for i in order[b:b + BATCH]]
            ids, x = np.concatenate([r[0] for r in part]), np.concatenate([r[1] for r in part])
            lengths = np.array([len(r[0]) for r in part])
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            z, total = margins(model, ids, x, starts)
            miss = (sigmoid(z) - np.array([r[2] for r in part])) / len(part)
            at, each = np.repeat(np.arange(len(part)), lengths), np.repeat(miss, lengths)
            used, where = np.unique(ids, return_inverse=True)
            dw = np.bincount(where, each * x, len(used)) + 1e-6 * model.w[used]
            per = (each * x)[:, None] * (total[at] - model.v[ids] * x[:, None])
            dv = np.stack([np.bincount(where, per[:, f], len(used)) for f in range(RANK)], 1)
            dv += 1e-6 * model.v[used]
            grad0 += miss.sum() ** 2
            grads_w[used] += dw**2
            grads_v[used] += dv**2
            model.w0 -= 0.1 * miss.sum() / np.sqrt(grad0)
            model.w[used] -= 0.2 * dw / np.sqrt(grads_w[used])
            model.v[used] -= 0.05 * dv / np.sqrt(grads_v[used])
    return model


def held_out(doc_id: Column | str) -> Column:
    """Whether a row is kept from training: crc32 of the id as text leaves 1 when divided by 3."""
    key = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit(""))
    return (F.crc32(key.cast("binary")) % 3) == 1


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents outside the held-out fold.

    The sample is the labelled ids with the smallest hash, so it does not depend
    on the layout. Null labels and ids take no part; of several labels of a
    document the smallest counts.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("struct<ids:array<int>, x:array<float>>")
    def vector(texts: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        found = [features(t, n) for t, n in zip(texts, n_chars)]
        return pd.DataFrame({"ids": [i.astype("i4") for i, _ in found], "x": [x.astype("f4") for _, x in found]})

    chosen = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id").agg(F.min("quality").alias("label"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = (
        docs.select("doc_id", "text", "n_chars")
        .join(F.broadcast(chosen), "doc_id")  # at most ``sample`` ids
        .select("doc_id", "label", vector("text", "n_chars").alias("f"))
        .dropDuplicates(["doc_id"]).orderBy("doc_id").limit(sample)
        .select("label", "f.ids", "f.x").toArrow()  # arrays, not objects, on the driver
    )
    found = zip(*(rows[c].to_numpy() for c in ("ids", "x", "label")))
    return fit([(np.asarray(i, np.int64), np.asarray(x, np.float64), int(label)) for i, x, label in found])


def score(docs: DataFrame, model: Model, text: str = "text", n_chars: str = "n_chars") -> Column:
    """Column with the score of each row's whole text; null texts score as empty ones.

    The model goes out once an executor; its size is fixed by ``BITS`` and ``RANK``.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def value(texts: pd.Series, lengths: pd.Series) -> pd.Series:
        found = [features(t, n) for t, n in zip(texts, lengths)]
        if not found:
            return pd.Series([], dtype="float64")
        starts = np.concatenate([[0], np.cumsum([len(i) for i, _ in found])[:-1]]).astype(np.int64)
        z, _ = margins(shared.value, np.concatenate([i for i, _ in found]), np.concatenate([x for _, x in found]), starts)
        return pd.Series(sigmoid(z))

    return value(docs[text], docs[n_chars].cast("double"))


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from 0.5 on) of every document, empty ones too."""
    model = train(docs, labels, sample)
    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), score(docs, model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))

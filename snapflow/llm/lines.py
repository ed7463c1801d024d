"""Removal of repeated runs of lines, by prefix doubling over line ids.

A place is a line with words in the collection. The name of a run of 2^h lines is
the first place it occurs at, so equal names mean equal runs, and the names of runs
twice as long come from pairs of names: a round joins places with themselves and
aggregates. Places of one name are an interval of the suffix array with a common
prefix of 2^h lines or more; as names are first occurrences, its later members are
the copies. Only places of repeated runs go on to the next round. Two overlapping
runs of 2^h lines name any run of up to 2^(h+1) lines.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import small_batches
from snapflow.operators.shard import ordinal
from snapflow.session import cut

#: A repeated run counts from so many words on.
MIN_WORDS = 50
_LINE_BITS = 28  # low bits of a place: the line in its document
_WORD = re.compile(r"\S+", re.ASCII)


def text_lines(text: str) -> tuple[list[str], np.ndarray]:
    """All lines, and the words of each."""
    lines = text.split("\n")
    return lines, np.array([len(_WORD.findall(line)) for line in lines], np.int64)


def least_runs(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For the run from each line on, and for the run up to each line, the fewest lines with ``least`` words; 0: none.

    Every line of a run with ``least`` words lies in one of these inside the run.
    """
    total = np.concatenate([[0], np.cumsum(words)])
    n = len(words)
    end = np.searchsorted(total, total[:-1] + least, side="left")  # total[end] - total[i] >= least
    on = np.where(end <= n, end - np.arange(n), 0)
    start = np.searchsorted(total, total[1:] - least, side="right") - 1  # total[i + 1] - total[start] >= least
    upto = np.where(start >= 0, np.arange(n) + 1 - start, 0)
    return on, upto


_LINES = pa.schema([
    ("did", pa.int64()), ("tkey", pa.int64()), ("line", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()),
    ("run_on", pa.int32()), ("run_upto", pa.int32()),
])


def _line_rows(min_words: int):
    def run(batches):
        for batch in batches:
            out = [[] for _ in _LINES]
            for did, tkey, text in zip(*(c.to_pylist() for c in batch.columns)):
                lines, words = text_lines(text)
                kept = np.flatnonzero(words)
                on, upto = least_runs(words[kept], min_words)
                hashes = np.frombuffer(b"".join(xxhash.xxh3_128_digest(lines[i].encode("utf-8")) for i in kept), "<i8")
                for column, values in zip(out, (
                    np.full(len(kept), did), np.full(len(kept), tkey), np.arange(len(kept)), hashes[::2], hashes[1::2], on, upto,
                )):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).astype(f.type.to_pandas_dtype())) for c, f in zip(out, _LINES)], schema=_LINES
                )

    return run


def _named(rows: DataFrame, *key: str) -> DataFrame:
    """Rows whose key is met again, with ``name``, the first place of the key.

    Copies are combined before the shuffle; a very common key is one key of an
    equi-join, which adaptive execution splits. The rows are written, as both sides
    read them, and so that no plan holds the rounds before.
    """
    rows = cut(rows)
    names = rows.groupBy(*key).agg(F.min("at").alias("name"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return rows.join(names.select(*key, "name"), list(key))


def repeated_runs(texts: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(did, tkey, lo, hi): spans of lines with words, [lo, hi), that copy an earlier run of ``min_words`` words or more.

    ``texts`` has did, tkey and text without nulls; rows equal in did and tkey are
    one document.
    """
    docs = texts.select("did", "tkey").distinct()
    numbers = cut(ordinal(docs, "did", "tkey", name="doc"))
    rows = texts.select("did", "tkey", "text").mapInArrow(
        _line_rows(min_words), "did long, tkey long, line int, h1 long, h2 long, run_on int, run_upto int"
    )
    place = F.shiftleft(F.col("doc"), _LINE_BITS) + F.col("line")
    # distinct, as repeated rows must not copy each other
    places = rows.join(numbers, ["did", "tkey"]).select(place.alias("at"), "h1", "h2", "run_on", "run_upto").distinct()

    repeated = cut(_named(places, "h1", "h2").select("at", "name", "run_on", "run_upto"))
    runs = cut(
        repeated.select("at", F.col("run_on").alias("n")).unionByName(
            repeated.select((F.col("at") - F.col("run_upto") + 1).alias("at"), F.col("run_upto").alias("n"))
        ).filter("n > 0").distinct()
    )
    longest = runs.agg(F.max("n")).first()[0] or 0
    level, copies, h = repeated.select("at", "name"), [], 1
    while h <= longest:
        here = runs.filter((F.col("n") >= h) & (F.col("n") < 2 * h))
        head = level.select("at", F.col("name").alias("a"))
        tail = level.select((F.col("at") + h).alias("end"), F.col("name").alias("b"))
        ends = here.join(head, "at").withColumn("end", F.col("at") + F.col("n")).join(tail, "end")
        # written, so that the last plan does not hold the rounds again
        copies.append(cut(_named(ends.select("at", "n", "a", "b"), "n", "a", "b").filter(F.col("at") > F.col("name")).select("at", "n")))
        h *= 2
        if h > longest:
            break
        pairs = head.join(tail.select((F.col("end") - h).alias("at"), "b"), "at")
        level = cut(_named(pairs, "a", "b").select("at", "name"))
    found = copies[0] if copies else runs.filter("n < 0")
    for more in copies[1:]:
        found = found.unionByName(more)
    spans = found.select(
        F.shiftright("at", _LINE_BITS).alias("doc"),
        F.col("at").bitwiseAND(F.lit((1 << _LINE_BITS) - 1)).cast("int").alias("lo"), "n",
    )
    return spans.join(numbers, "doc").select("did", "tkey", "lo", (F.col("lo") + F.col("n")).cast("int").alias("hi"))


def without_lines(text: str, spans: list[tuple[int, int]]) -> tuple[str, int]:
    """Text without the spans of lines with words, and the number of those lines; an empty line goes with the line before it."""
    lines, words = text_lines(text)
    gone = np.zeros(int((words > 0).sum()) + 1, bool)
    for lo, hi in spans:
        gone[lo + 1:hi + 1] = True
    number = np.cumsum(words > 0)  # 0: before the first line with words
    return "\n".join(line for line, k in zip(lines, number) if not gone[k]), int(gone.sum())


def remove_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, kept, n_lines, n_removed) per row of ``docs``: the row itself as a struct, and the text left.

    Lines go when they lie in a run of lines, of ``min_words`` words or more, that
    occurs before: in a smaller doc_id, or earlier in the document. The first copy
    stays whole. Lines are compared exactly; lines without words are passed over, and
    each goes with the line before it. A null text counts as empty, a null doc_id as
    smaller than all others; of rows of one id that differ in text the smaller text
    hash comes first, and repeated rows are one document.
    """
    small_batches(docs.sparkSession)
    body = F.coalesce("text", F.lit(""))
    texts = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("did"), F.xxhash64(body).alias("tkey"), body.alias("text"))
    spans = repeated_runs(texts, min_words).groupBy("did", "tkey").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))

    @F.pandas_udf("struct<kept:string, n_lines:long, n_removed:long>")
    def keep(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for text, spans in zip(texts, found):
            cut_out = [] if spans is None else [(s["lo"], s["hi"]) for s in spans]
            kept, removed = without_lines(text, cut_out) if cut_out else (text, 0)
            out.append((kept, text.count("\n") + 1, removed))
        return pd.DataFrame(out, columns=["kept", "n_lines", "n_removed"])

    joined = texts.join(spans.hint("shuffle_hash"), ["did", "tkey"], "left")
    return joined.select("row", keep("text", "found").alias("o")).select("row", "o.*")


def dedupe_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the texts left, ``n_chars`` to match; documents that lost all their words are dropped."""
    done = remove_repeated_lines(docs, min_words)
    text = {"text": F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text")), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("row.n_chars"))}
    left = done.filter((F.col("n_removed") == 0) | F.col("kept").rlike(r"\S"))
    return left.select(*[text.get(c, F.col("row")[c]).alias(c) for c in docs.columns])

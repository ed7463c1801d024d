"""Byte-level BPE: whole texts to token ids by a rank file, and ids back to bytes."""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import small_batches

#: Texts longer than this are cut where a match of the pattern certainly ends.
CHUNK = 1 << 16
#: Runs of white space from here on are cut out before the pattern sees them: its
#: look-ahead backtracks over the whole run.
LONG_RUN = 1 << 12


@lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The encoder of a rank file that every node holds under the same path; loaded once a worker."""
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


_RUN = regex.compile(rf"\p{{White_Space}}{{{LONG_RUN},}}")
# `\s` of this module also takes U+001C to U+001F, which the pattern does not: those are no cuts
_LAST_BREAK = regex.compile(r"(?<=\S)[ \n]", regex.REVERSE)
_NEXT_BREAK = regex.compile(r"(?<=\S)[ \n]")


def safe_pieces(text: str, chunk: int = CHUNK):
    """Consecutive parts of a text, with a flag for parts that are one match as they stand.

    No match of the pattern goes on from other characters into white space, so a
    cut between the two changes no match. A long run of white space is one match
    up to its last character, which may belong to the next match.
    """
    if len(text) <= min(chunk, LONG_RUN):
        yield text, False
        return
    at = 0
    for run in _RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield from ((part, False) for part in _cut(text, at, run.start(), chunk))
        yield text[run.start():end], True
        at = end
    yield from ((part, False) for part in _cut(text, at, len(text), chunk))


def _cut(text: str, at: int, end: int, chunk: int):
    while end - at > chunk:
        found = _LAST_BREAK.search(text, at + 1, at + chunk) or _NEXT_BREAK.search(text, at + chunk, end)
        if not found:
            break
        yield text[at:found.start()]
        at = found.start()
    if at < end:
        yield text[at:end]


def encode_text(text: str, ranks: str, pattern: str) -> np.ndarray:
    """Token ids of a whole text, no special tokens."""
    enc, ids = encoding(ranks, pattern), []
    for part, single in safe_pieces(text):
        ids += enc._encode_single_piece(part) if single else enc.encode_ordinary(part)
    return np.asarray(ids, "<u4")


def encode(text: Column | str, ranks: str, pattern: str) -> Column:
    """Token ids of a text column as array<int>; null is encoded as the empty text (no ids)."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series([encode_text(t or "", ranks, pattern).astype("i4") for t in texts], dtype=object)

    return ids(text)


def decode(ids: Column | str, ranks: str, pattern: str) -> Column:
    """The bytes of a column of token ids; null ids give no bytes."""

    @F.pandas_udf("binary")
    def raw(rows: pd.Series) -> pd.Series:
        enc = encoding(ranks, pattern)
        return pd.Series([b"" if x is None else enc.decode_bytes(np.asarray(x).tolist()) for x in rows], dtype=object)

    return raw(ids)


def digest(ids: Column | str) -> Column:
    """SHA-256 of token ids as little-endian unsigned 32-bit integers."""

    @F.pandas_udf("string")
    def hexes(rows: pd.Series) -> pd.Series:
        return pd.Series([hashlib.sha256(np.asarray(x, "<u4").tobytes()).hexdigest() for x in rows])

    return hexes(ids)


def tokenize(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, token_ids, n_tokens, ids_sha256 and decoded_sha256 of every document.

    Row-local: no shuffle, and repeated rows give repeated results. A null text
    counts as empty: no tokens, digests of nothing. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    encoded = docs.select("doc_id", encode("text", ranks, pattern).alias("token_ids"))
    return encoded.select(
        "doc_id",
        "token_ids",
        F.size("token_ids").cast("long").alias("n_tokens"),
        digest("token_ids").alias("ids_sha256"),
        F.sha2(decode("token_ids", ranks, pattern), 256).alias("decoded_sha256"),
    )

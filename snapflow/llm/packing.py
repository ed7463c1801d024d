"""Packing of token ids into sequences: shortest pack first over the histogram of lengths."""

from __future__ import annotations

import heapq
import json
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapflow.llm.bpe import safe_pieces
from snapflow.llm.common import small_batches
from snapflow.operators.shard import ordinal
from snapflow.session import work_dir

WIDTH = 2048
END = 1  # the id that ends each document
#: Chunks of text whose ids a worker keeps, half of them words after a space, and the longest chunk kept.
KNOWN, KNOWN_CHARS = 1 << 20, 32

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r"!-&(-/:-@\[-`{-~"  # ASCII punctuation without the apostrophe, which can go with letters
# A chunk starts at the start of the text, before white space that follows something else, or at a mark
# after a letter: at none of these places does a match of the byte-level pattern go on.
_CHUNK = re.compile(rf" ?[{_LETTERS}]+(?=[ \n{_MARKS}])|\n(?=[{_LETTERS}])|[ \n]*[^ \n]+|[ \n]+")
_WORD = re.compile(rf" ?[{_LETTERS}]+")
# runs of white space, which a cut at each space would take apart
_RUNS = ("  ", " \n", "\n ")
# white space other than the two above, by the widest meaning of the word
_OTHER_SPACE = re.compile(r"[^\S \n]")
# the pattern of the byte-level pre-tokenizer, and characters that engines or their Unicode tables might class otherwise
_MATCH = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_UNSURE = re.compile(r"[\x1c-\x1f\x85\u0250-\U0010ffff]")


def _byte_chars() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 characters stand for themselves, the rest follow from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def raw(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    made = array("I", ids)
    if sys.byteorder == "big":
        made.byteswap()
    return made.tobytes()


def ranked(path: str, tokenizer: Tokenizer) -> tiktoken.Encoding | None:
    """The merges of a tokenizer file as ranks, if these give the same ids; None if the file is of another kind.

    A listed merge makes the token of its rank. A pair that is not listed is merged by ranks too if its text is a
    token, but such a pair never stands side by side where each token's own text becomes that token by the listed merges:
    these would meet the pair there as well, as no merge crosses its ends, and stop.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, split, kept = file["model"], file["pre_tokenizer"] or {}, {t["content"] for t in file["added_tokens"]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ())]
    made = [model["vocab"].get("".join(m), -1) for m in merges]
    if (
        model.get("type") != "BPE" or file["normalizer"] or any(not t["special"] for t in file["added_tokens"])
        or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
        or split.get("type") != "ByteLevel" or split.get("add_prefix_space", True) or not split.get("use_regex", True)
        or any(a >= b for a, b in zip(made, made[1:]))
    ):
        return None
    chars = {c: b for b, c in _byte_chars().items()}
    tokens = {t: i for t, i in model["vocab"].items() if t not in kept}
    if not chars.keys() <= tokens.keys() or len(tokens) != len(made) + len(chars):
        return None
    if any(not chars.keys() >= set(t) or [x.id for x in tokenizer.model.tokenize(t)] != [i] for t, i in tokens.items()):
        return None
    ranks = {bytes(map(chars.__getitem__, t)): i for t, i in tokens.items()}
    return tiktoken.Encoding("merges", pat_str=_MATCH, mergeable_ranks=ranks, special_tokens={})


class Words(dict):
    """Ids of chunks as little-endian unsigned 32-bit integers; chunks met are kept up to a bound.

    Whole texts of usual characters go by the ranks of the file's merges, several times as fast; all others by chunks.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # control strings in a text are ordinary text
        self.model, self.chars = self.tokenizer.model, _byte_chars()
        self.spaced, self.ranked = Spaced(self), ranked(path, self.tokenizer)

    def __missing__(self, chunk: str) -> bytes:
        if _WORD.fullmatch(chunk):  # one match of the pattern, so the model takes it as it is
            found = self.model.tokenize(chunk.encode().decode("latin-1").translate(self.chars))
            ids = raw([t.id for t in found])
        else:
            ids = self.whole(chunk)
        if len(chunk) <= KNOWN_CHARS:
            if len(self) >= KNOWN // 2:
                self.clear()
            self[chunk] = ids
        return ids

    def whole(self, text: str) -> bytes:
        return raw(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        if self.ranked and (text.isascii() and text.isprintable() or not _UNSURE.search(text)):
            whole, single = self.ranked.encode_ordinary, self.ranked._encode_single_piece
            return b"".join(raw(single(part) if one else whole(part)) for part, one in safe_pieces(text))
        if _OTHER_SPACE.search(text):
            return b"".join(self.whole(part) for part, _ in safe_pieces(text))
        if any(run in text for run in _RUNS):
            return b"".join(map(self.__getitem__, _CHUNK.findall(text)))
        first, *pieces = text.split(" ")  # each single space starts a chunk
        return b"".join(map(self.__getitem__, _CHUNK.findall(first))) + self.spaced.encode(pieces)


class Spaced(dict):
    """Ids of pieces of text that follow a space, with that space; pieces met are kept up to a bound.

    New words of a text go through the tokenizer's model together; only their first tokens begin with a space.
    """

    def __init__(self, words: Words):
        super().__init__()
        self.words, self.space = words, words.chars[ord(" ")]
        self.bare = Tokenizer(words.model)  # the model alone, for words that are one match of the pattern each
        vocab = words.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocab.values()) + 1, bool)
        self.begins[[i for token, i in vocab.items() if token.startswith(self.space)]] = True

    def __missing__(self, piece: str) -> bytes:
        ids = b"".join(map(self.words.__getitem__, _CHUNK.findall(" " + piece)))
        if len(piece) <= KNOWN_CHARS and "\n" not in piece:
            if len(self) >= KNOWN // 2:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, pieces: list[str]) -> bytes:
        new = [p for p in filterfalse(self.__contains__, set(pieces)) if len(p) <= KNOWN_CHARS and (p.isascii() and p.isalpha() or _WORD.fullmatch(p))]
        if new and len(new) <= KNOWN // 2:
            self.learn(new)
        return b"".join(map(self.__getitem__, pieces))

    def learn(self, new: list[str]) -> None:
        shown = [self.space + (p if p.isascii() else p.encode().decode("latin-1").translate(self.words.chars)) for p in new]
        ids = np.array(self.bare.encode_batch_fast([shown], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
        whole, at = ids.tobytes(), (np.flatnonzero(self.begins[ids]) * 4).tolist()
        if len(self) + len(new) > KNOWN // 2:
            self.clear()
        self.update(zip(new, map(whole.__getitem__, map(slice, at, [*at[1:], len(whole)])), strict=True))


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)


def token_runs(text: Column | str, path: str, width: int = WIDTH) -> Column:
    """Ids of a text and the end id, cut into runs of ``width`` ids, the last one shorter; as array<binary>.

    Ids are those of the byte-level tokenizer file at ``path``, without special tokens. A null
    text is empty and has the end id only.
    """
    step, end = 4 * width, raw([END])

    @F.arrow_udf("array<binary>")
    def runs(texts: pa.Array) -> pa.Array:
        known = words(path)
        whole = (known.encode(t or "") + end for t in texts.to_pylist())
        return pa.array([[ids[i:i + step] for i in range(0, len(ids), step)] for ids in whole], pa.list_(pa.binary()))

    return runs(text)


def pack(counts: dict[int, int], width: int = WIDTH) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Packing patterns for runs of these lengths: (ids in a pack, packs, parts), a part (position, length).

    Runs are numbered by length and then in any fixed order; the part (p, m) of a pattern of n packs says
    that its i-th pack holds run p + i, of length m. Lengths are placed longest first, all runs of a length together,
    each into the shortest pack if that has room and else into a new one, so a step moves as many packs as
    agree. Every step uses up a pattern or a length, so the work depends on the number of lengths and
    not on that of the documents.
    """
    first, at = {}, 0
    for length in sorted(counts):
        first[length] = at
        at += counts[length]
    patterns: list[tuple[int, int, int, list]] = []  # filled, a number of its own, packs, parts
    number = 0
    for length in sorted(counts, reverse=True):
        position, n = first[length], counts[length]
        while n:
            if patterns and patterns[0][0] + length <= width:
                filled, _, packs, parts = heapq.heappop(patterns)
                if packs > n:
                    number += 1
                    heapq.heappush(patterns, (filled, number, packs - n, [(p + n, m) for p, m in parts]))
                    packs = n
            else:
                filled, packs, parts = 0, -(-n // (width // length)), []
            number += 1
            heapq.heappush(patterns, (filled + length, number, packs, [*parts, (position, length)]))
            position, n = position + packs, n - packs
    return [(filled, packs, parts) for filled, _, packs, parts in patterns]


class Places:
    """Where each run goes, by its position: arrays as large as the patterns, looked up by binary search.

    The fullest packs stay, as many as the ids fill whole sequences. All others are taken apart: their runs,
    one after the other, are a line of ids, and the room in the packs that stay, one after the other, is another
    of at least that length; laid side by side, the one fills the other. The rest, less than a sequence, goes into
    sequences whose sizes are powers of two, so that nothing is padded.
    """

    def __init__(self, patterns: list[tuple[int, int, list[tuple[int, int]]]], width: int = WIDTH):
        total = sum(filled * packs for filled, packs, _ in patterns)
        whole, left = divmod(total, width)
        runs, rooms, sequence, line, free = [], [], 0, 0, 0
        for filled, packs, parts in sorted(patterns, key=lambda x: (-x[0], x[1], x[2])):
            keep, offset = min(packs, whole - sequence), 0
            for p, m in parts:
                if keep:
                    runs.append((p, m, sequence, offset, -1))
                if packs > keep:
                    runs.append((p + keep, m, 0, 0, line))
                    line += m * (packs - keep)
                offset += m
            if keep and filled < width:
                rooms.append((free, width - filled, sequence, filled))
                free += keep * (width - filled)
            sequence += keep
        for size in (1 << b for b in reversed(range(left.bit_length())) if left >> b & 1):
            rooms.append((free, size, sequence, 0))
            free, sequence = free + size, sequence + 1
        self.position, self.length, self.sequence, self.offset, self.line = np.array(sorted(runs), np.int64).reshape(-1, 5).T
        self.free, self.room, self.room_sequence, self.room_offset = np.array(rooms, np.int64).reshape(-1, 4).T

    def of(self, position: np.ndarray) -> tuple[np.ndarray, ...]:
        """For runs at these positions: index of the run, begin and length of a part, its sequence and offset."""
        at = np.searchsorted(self.position, position, "right") - 1
        nth, length = position - self.position[at], self.length[at]
        run = np.flatnonzero(self.line[at] < 0)
        found = [(run, np.zeros(len(run), np.int64), length[run], self.sequence[at[run]] + nth[run], self.offset[at[run]])]
        run = np.flatnonzero(self.line[at] >= 0)
        begin, here = np.zeros(len(run), np.int64), self.line[at[run]] + nth[run] * length[run]
        end = here + length[run]
        while len(run):  # each turn fills the room that the next id of the line stands before
            r = np.searchsorted(self.free, here, "right") - 1
            pack, inside = np.divmod(here - self.free[r], self.room[r])
            used = np.minimum(end - here, self.room[r] - inside)
            found.append((run, begin, used, self.room_sequence[r] + pack, self.room_offset[r] + inside))
            more = here + used < end
            run, begin, here, end = run[more], (begin + used)[more], (here + used)[more], end[more]
        return tuple(np.concatenate(x) for x in zip(*found))


def pack_documents(docs: DataFrame, path: str, width: int = WIDTH) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id and offset of every piece of every document.

    ``ids`` are little-endian unsigned 32-bit integers, of which ``start`` ids of the document come
    before. Texts are encoded once and written as runs of at most ``width`` ids; only the
    lengths, at most ``width`` of them, reach the driver, which makes the patterns. Runs
    get their rank among those of their length by ranged positions, never by a window
    over a length, so equal texts of a third of the rows cost no more than others. Patterns meet the
    runs by rank, and the ids are joined back by row number.

    A null text is empty, an empty text is its end id alone, repeated rows and null ids are documents
    of their own, and an empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    runs = docs.select("doc_id", token_runs("text", path, width).alias("runs"))
    last = F.octet_length(F.element_at("runs", -1)) / 4
    counted = runs.withColumn("doc_tokens", ((F.size("runs") - 1).cast("long") * width + last).cast("long"))
    pieces = counted.select("doc_id", "doc_tokens", F.posexplode("runs").alias("at", "ids")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", (F.col("at").cast("long") * width).alias("begin"),
        (F.octet_length("ids") / 4).cast("int").alias("length"), "ids", "doc_tokens",
    )
    kept = work_dir(spark, "runs")
    pieces.write.option("compression", "zstd").parquet(kept)  # ids take twice the room in the default one
    pieces = spark.read.schema(pieces.schema).parquet(kept)

    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.sparkContext.broadcast(Places(pack(counts, width), width))  # grows with the lengths, not with the rows

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            run, begin, length, sequence, offset = places.value.of(pdf["position"].to_numpy())
            yield pd.DataFrame({
                "row": pdf["row"].to_numpy()[run], "from": begin, "length": length, "sequence_id": sequence, "offset": offset,
            })

    numbered = ordinal(pieces.select("length", "row"), "length", "row")
    placed = numbered.select("row", "position").mapInPandas(place, "row long, from long, length long, sequence_id long, offset long")
    part = F.substring("ids", (F.col("from") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int"))
    return pieces.drop("length").join(placed.alias("p"), "row").select(
        "doc_id", (F.col("begin") + F.col("from")).alias("start"), F.col("p.length").alias("length"), part.alias("ids"),
        "doc_tokens", "sequence_id", "offset",
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id and ids (array<int>) of every sequence, without padding; a group holds one sequence."""
    found = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    whole = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))

    @F.pandas_udf("array<int>")
    def numbers(rows: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(x, "<u4").astype("i4") for x in rows], dtype=object)

    return found.select("sequence_id", numbers(whole).alias("ids"))

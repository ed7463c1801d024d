"""Removal of byte strings that occur earlier in the collection, by column-wise suffix sorting.

Every 100-byte string has one anchor, the place of the least hash among its
32-byte grams, so equal strings agree in the bytes around their anchor. Documents
are cut into fragments, an anchor with the 68 bytes on either side that its strings
can reach. Fragments of anchors met once hold nothing repeated, and of fragments
alike in all bytes only the first is needed. The rest form bounded collections whose
suffixes are sorted column by column: each round inserts one symbol of every
fragment before the suffixes of the round before, and updates their order and common
prefixes by one stable pass. Suffixes that share 100 bytes stand side by side, and
all but the first occurrence are removed.

A construction over whole documents would need as many rounds, each over everything,
as the longest document has bytes; fragments need 168 whatever the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapflow.llm.common import small_batches
from snapflow.session import cut

LENGTH = 100
GRAM = 32
REACH = LENGTH - GRAM  # bytes a string can reach to either side of its anchor
WIDTH = REACH + LENGTH  # of a fragment
#: Fragments sorted together, and how many of one anchor go to strings of their own instead.
COLLECTION = 32_768
HOT = 65_536
_PIECE = 1 << 21  # bytes hashed at once
_FLUSH = 1 << 20  # anchors combined before they leave a task

_rng = np.random.default_rng(20_240_601)
_SYMBOL = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_MIX = [np.uint64(x | 1) for x in _rng.integers(1, 1 << 63, 6, dtype=np.uint64)]


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest of each ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return pick(x[:-rest], x[rest:]) if rest else x


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each position on."""
    h, done = _SYMBOL[data], 1
    for level in range(5):
        h = h[:-done] * _MIX[level] + h[done:]
        done *= 2
    h ^= h >> np.uint64(31)
    h *= _MIX[5]
    h ^= h >> np.uint64(29)
    return h | np.uint64(1)


def anchors_in(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the anchors of all 100-byte strings inside the documents of a buffer.

    Documents are [start, end) with at least 100 bytes between them and behind
    the last. Ties are all anchors. Works in pieces, so a long document needs no more memory.
    """
    total = int(ends[-1]) if len(ends) else 0
    at, found = 0, []
    grams = LENGTH - GRAM + 1
    while at < total:
        to = min(at + _PIECE, total)  # strings that begin in [at, to)
        h = gram_hashes(data[at:to + LENGTH - 1])
        least = _slide(h, grams, np.minimum)  # of the string that begins at each position
        inside = np.zeros(len(least) + 1, np.int64)
        lo, hi = np.clip(starts - at, 0, len(least)), np.clip(ends - LENGTH + 1 - at, 0, len(least))
        some = lo < hi
        np.add.at(inside, lo[some], 1)
        np.add.at(inside, hi[some], -1)
        least = np.where(np.cumsum(inside[:-1]) > 0, least, np.uint64(0))
        edge = np.zeros(grams - 1, np.uint64)
        chosen = _slide(np.concatenate([edge, least, edge]), grams, np.maximum)[:len(h)]
        where = np.flatnonzero(chosen == h)
        found.append((at + where, h[where]))
        at = to
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, value = (np.concatenate(x) for x in zip(*found))
    place, first = np.unique(place, return_index=True)  # pieces overlap
    return place, value[first]


def padded(texts: list[bytes]) -> tuple[np.ndarray, bytes, np.ndarray, np.ndarray]:
    """Texts in one buffer, 100 zero bytes before and behind each."""
    gap = bytes(LENGTH)
    buffer = gap + gap.join(texts) + gap * 2
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = LENGTH + np.concatenate([[0], np.cumsum(sizes + LENGTH)[:-1]]) if len(texts) else np.zeros(0, np.int64)
    return np.frombuffer(buffer, np.uint8), buffer, starts, starts + sizes


def _fragment_hashes(buffer: bytes, place: np.ndarray, before: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Hash of each fragment's bytes and of how much of it lies outside its document."""
    cut_off = np.maximum(REACH - before, 0) * 256 + np.maximum(LENGTH - behind, 0)
    digest = xxhash.xxh3_64_intdigest
    return np.array(
        [digest(buffer[p - REACH:p + LENGTH], s) for p, s in zip(place.tolist(), cut_off.tolist())], np.uint64
    ).view(np.int64)


_ANCHORS = pa.schema([
    ("anchor", pa.int64()), ("f", pa.int64()), ("did", pa.int64()), ("tkey", pa.int32()), ("pos", pa.int32()), ("done", pa.bool_()),
])


def _combine(parts: list[np.ndarray]) -> pa.RecordBatch:
    """Fragments alike within a task: the first goes on, the others are repeated whatever else there is."""
    anchor, f, did, tkey, pos = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((pos, tkey, did, f, anchor))
    anchor, f, did, tkey, pos = (c[order] for c in (anchor, f, did, tkey, pos))
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (f[1:] != f[:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    done = (did != did[first]) | (tkey != tkey[first]) | (pos != pos[first])
    # what is settled only passes by: any key will do, if it spreads
    anchor = np.where(done, did * np.int64(0x9E3779B97F4A7C1 | 1) + pos * np.int64(0x5851F42D4C957F2D), anchor)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (anchor, f, did, tkey, pos, done)], schema=_ANCHORS)


def fragments(texts: DataFrame) -> DataFrame:
    """(anchor, f, did, tkey, pos, done): one row per anchor, alike fragments of a task combined.

    ``texts`` has did, tkey and raw, the text as bytes. ``done`` marks fragments known to be repeated.
    """

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            did, tkey = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, buffer, starts, ends = padded(batch.column(2).to_pylist())
            place, value = anchors_in(data, starts, ends)
            doc = np.searchsorted(starts, place, side="right") - 1
            f = _fragment_hashes(buffer, place, place - starts[doc], ends[doc] - place)
            parts.append((value.view(np.int64), f, did[doc], tkey[doc], (place - starts[doc]).astype(np.int32)))
            size += len(place)
            if size >= _FLUSH:
                yield _combine(parts)
                parts, size = [], 0
        if size:
            yield _combine(parts)

    return texts.select("did", "tkey", "raw").mapInArrow(
        run, "anchor long, f long, did long, tkey int, pos int, done boolean"
    )


def repeated_strings(symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last column from which 100 bytes of each fragment are met in one of lower rank; -1: none.

    ``symbols`` has a row per fragment; its document covers columns lo to hi, and
    ``rank`` is the order of occurrence. Columns are added from the last to the
    first. ``order`` lists the fragments by their suffix from the current column on,
    ``common[i]`` is what suffixes i - 1 and i share, up to 100 bytes; the symbols in
    this order are the round's piece of the transform. A stable sort by the new
    symbol keeps the order behind it, and neighbours that share the symbol share one
    byte more than the least of what stood between them.
    """
    m, width = symbols.shape
    order, common = np.arange(m), np.full(m + 1, LENGTH, np.uint8)
    common[0] = 0
    first, last = np.full(m, -1, np.int32), np.full(m, -1, np.int32)
    columns = np.ascontiguousarray(symbols.T)
    for j in range(width - 1, -1, -1):
        piece = columns[j][order]
        by = np.argsort(piece, kind="stable")
        between = np.minimum.reduceat(common, by + 1)  # of by[i] + 1 up to by[i + 1]; ``common`` has a spare end
        sorted_piece = piece[by]
        same = sorted_piece[1:] == sorted_piece[:-1]
        order = order[by]
        common[1:m] = np.where(same, np.minimum(between[:-1] + 1, LENGTH), 0)
        if j > width - LENGTH:
            continue
        heads = np.flatnonzero(np.concatenate([[True], common[1:m] < LENGTH]))
        if len(heads) == m:
            continue
        valid = (lo[order] <= j) & (hi[order] >= j + LENGTH)
        ranks = np.where(valid, rank[order], np.iinfo(np.int64).max)
        least = np.repeat(np.minimum.reduceat(ranks, heads), np.diff(np.append(heads, m)))
        hit = order[valid & (ranks > least)]
        first[hit] = j
        last[hit] = np.maximum(last[hit], j)
    return first, last


_FOUND = "did long, tkey int, lo int, hi int"
_SPANS = pa.schema([("did", pa.int64()), ("tkey", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())])


def _sort_collection(table: pa.Table) -> pa.Table:
    did, tkey, pos = (table[c].to_numpy() for c in ("did", "tkey", "pos"))
    n = table["n_bytes"].to_numpy()
    symbols = np.frombuffer(b"".join(table["bytes"].to_pylist()), np.uint8).reshape(-1, WIDTH)
    by = np.lexsort((pos, tkey, did))
    new = np.zeros(len(by), np.int64)
    new[1:] = (did[by][1:] != did[by][:-1]) | (tkey[by][1:] != tkey[by][:-1]) | (pos[by][1:] != pos[by][:-1])
    rank = np.empty(len(by), np.int64)
    rank[by] = np.cumsum(new)  # the same place twice has one rank
    lo = np.maximum(REACH - pos, 0)
    hi = np.minimum(REACH + (n - pos), WIDTH)
    first, last = repeated_strings(symbols, lo, hi, rank)
    hit = first >= 0
    at = (pos - REACH)[hit]
    spans = did[hit], tkey[hit], (at + first[hit]).astype(np.int32), (at + last[hit] + LENGTH).astype(np.int32)
    return pa.table([pa.array(c) for c in spans], schema=_SPANS)


def _extract(batches):
    schema = pa.schema([
        ("anchor", pa.int64()), ("did", pa.int64()), ("tkey", pa.int32()), ("pos", pa.int32()), ("n_bytes", pa.int32()), ("bytes", pa.binary()),
    ])
    gap = bytes(LENGTH)
    for batch in batches:
        rows = []
        for did, tkey, raw, wanted in zip(*(c.to_pylist() for c in batch.columns)):
            buffer = gap + raw + gap
            for w in wanted:
                p = w["pos"] + LENGTH
                rows.append((w["anchor"], did, tkey, w["pos"], len(raw), buffer[p - REACH:p + LENGTH]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _strings(batches):
    """All strings of fragments as 128-bit hashes, for anchors with too many fragments to sort at once."""
    schema = pa.schema([("h", pa.binary()), ("did", pa.int64()), ("tkey", pa.int32()), ("at", pa.int32())])
    for batch in batches:
        rows = []
        for _, did, tkey, pos, n, data in zip(*(c.to_pylist() for c in batch.columns)):
            for j in range(max(REACH - pos, 0), min(REACH, REACH + n - pos - LENGTH) + 1):
                rows.append((xxhash.xxh3_128_digest(data[j:j + LENGTH]), did, tkey, pos - REACH + j))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _remove(batches):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))), ("kept", pa.binary()),
    ])
    for batch in batches:
        rows = []
        for doc_id, raw, found in zip(*(c.to_pylist() for c in batch.columns)):
            spans: list[dict] = []
            for lo, hi in sorted((max(x["lo"], 0), min(x["hi"], len(raw))) for x in found or ()):
                if spans and lo <= spans[-1]["hi"]:
                    spans[-1]["hi"] = max(spans[-1]["hi"], hi)
                else:
                    spans.append({"lo": lo, "hi": hi})
            edges = [0, *(x for s in spans for x in (s["lo"], s["hi"])), len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
            rows.append((doc_id, len(raw), spans, kept))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def remove_repeats(docs: DataFrame, hot: int = HOT, collection: int = COLLECTION) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every document: removed byte spans and the bytes left.

    A byte goes if a 100-byte string over it also starts earlier, in a smaller
    doc_id or before it in its own document; strings are taken from the input and
    may overlap. A null text is empty, a null doc_id is smaller than all others, and
    of rows with the same id that differ in text the one of the smaller text hash
    comes first; repeated rows are one document. Other columns are not read.

    Documents with nothing but strings met once cost their anchors' hashes only.
    Anchors of more than ``hot`` different fragments are not sorted together: their
    strings are compared by their own hashes, combined before the shuffle.
    """
    spark = docs.sparkSession
    small_batches(spark)
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    texts = docs.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("did"),
        F.hash(raw).alias("tkey"), raw.alias("raw"),
    )

    alike = Window.partitionBy("anchor", "f").orderBy("did", "tkey", "pos")
    group = Window.partitionBy("anchor")
    seen = (
        fragments(texts).repartition("anchor")
        .withColumn("again", F.col("done") | (F.rank().over(alike) > 1))
        .withColumn("mixed", F.min("f").over(group) != F.max("f").over(group))
        .withColumn("n", F.sum(F.when(F.col("again"), 0).otherwise(1)).over(group))
        .filter("again OR mixed")
    )
    found = cut(seen.select("did", "tkey", "pos", F.when(~F.col("again"), F.col("anchor")).alias("anchor"), (F.col("n") > hot).alias("hot")))
    alone = found.filter(F.col("anchor").isNull()).select(
        "did", "tkey", (F.col("pos") - REACH).alias("lo"), (F.col("pos") + LENGTH).alias("hi")
    )
    asked = found.filter(F.col("anchor").isNotNull())
    n_cold, n_hot = asked.agg(F.count(F.when(~F.col("hot"), 1)), F.count(F.when(F.col("hot"), 1))).first()

    # the same shuffle of the texts serves the fragments and the removal
    placed = texts.repartition("did", "tkey")

    def contents(rows: DataFrame) -> DataFrame:
        by_doc = rows.groupBy("did", "tkey").agg(F.collect_list(F.struct("anchor", "pos")).alias("wanted"))
        joined = placed.join(by_doc.hint("shuffle_hash"), ["did", "tkey"])
        return joined.select("did", "tkey", "raw", "wanted").mapInArrow(
            _extract, "anchor long, did long, tkey int, pos int, n_bytes int, bytes binary"
        )

    spans = [alone]
    if n_cold:
        dealt = contents(asked.filter(~F.col("hot"))).withColumn(
            "part", F.pmod(F.xxhash64("anchor"), F.lit(-(-n_cold // collection)))
        )
        spans.append(dealt.groupBy("part").applyInArrow(_sort_collection, _FOUND))
    if n_hot:
        strings = cut(contents(asked.filter("hot")).mapInArrow(_strings, "h binary, did long, tkey int, at int"))
        place = F.struct("did", "tkey", "at")
        firsts = strings.groupBy("h").agg(F.min(place).alias("first"))
        later = strings.join(firsts, "h").filter(place > F.col("first"))
        spans.append(later.select("did", "tkey", F.col("at").alias("lo"), (F.col("at") + LENGTH).alias("hi")))

    every = spans[0]
    for more in spans[1:]:
        every = every.unionByName(more)
    by_doc = every.groupBy("did", "tkey").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    joined = placed.join(by_doc.hint("shuffle_hash"), ["did", "tkey"], "left")
    return joined.select("doc_id", "raw", "found").mapInArrow(
        _remove, "doc_id long, n_bytes long, spans array<struct<lo:int,hi:int>>, kept binary"
    )

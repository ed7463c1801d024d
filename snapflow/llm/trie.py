"""Prefix trie of conversations: double-array tries of prefix shards, shared nodes merged globally."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.operators.shard import ordinal
from snapflow.session import cut

#: Turns of a segment. Longer conversations hang one segment below the other.
BLOCK = 32
#: Different segments that a shard should not exceed, whatever the table.
SHARD = 65_536
#: Shards of small tables are not cut below this many segments.
LEAST = 256
ROOT = ""
_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = (
    "key string, parent_key string, conv_id long, parent_conv_id long, depth long, n_convs long, chars long, "
    "n_children long, n_leaves long, saved_tokens long, open boolean"
)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), turn_key and chars of every turn, and the number of turns of its conversation.

    Turns are ordered by ``turn``, null first, equal ones by their key, the digest of role and text. Places
    come from ranged positions, so a conversation of any length is spread over tasks. A null role or text is empty.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", key.alias("turn_key"), F.char_length(text).cast("long").alias("chars"),
    )
    placed = ordinal(turns, "conv_id", "turn", "turn_key", name="at")
    starts = placed.groupBy("conv_id").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n_turns"))
    return placed.join(starts, "conv_id").select("conv_id", (F.col("at") - F.col("start") + 1).alias("place"), "turn_key", "chars", "n_turns")


def shared_heads(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (conv_id, depth, turn_key, chars), and (conv_id, n_turns) of all of them.

    Conversation c takes the first h turns of conversation c - c % group, h = crc32(decimal c) % most, in place of its own.
    """
    h = F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % most
    convs = turns.select("conv_id", F.col("n_turns").alias("own")).distinct().select(
        "conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base")
    )
    there = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_turns"))
    convs = convs.join(there, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_turns", F.lit(0))))
    convs = cut(convs.select("conv_id", "base", "own", "h", "taken"))
    heads = convs.filter("taken > 0").select("conv_id", F.col("base").alias("b"), F.explode(F.sequence(F.lit(1).cast("long"), "taken")).alias("place"))
    first = turns.filter(F.col("place") < most).select(F.col("conv_id").alias("b"), "place", "turn_key", "chars")
    taken = heads.join(first, ["b", "place"]).select("conv_id", F.col("place").alias("depth"), "turn_key", "chars")
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").filter(F.col("place") > F.col("h"))
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "turn_key", "chars")
    lengths = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns"))
    return taken.unionByName(own), lengths


def plain(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are, in the form of ``shared_heads``."""
    return turns.select("conv_id", F.col("place").alias("depth"), "turn_key", "chars"), turns.select("conv_id", "n_turns").distinct()


def dense_turns(rows: DataFrame) -> DataFrame:
    """``rows`` with a dense number for every different turn instead of its key.

    Each key is one row of the dictionary, whose numbers are ranged positions; a turn of very many rows is a key of
    an equi-join, which adaptive execution splits.
    """
    known = ordinal(rows.select("turn_key").distinct(), "turn_key", name="turn_id")
    return rows.join(known, "turn_key").drop("turn_key")


def _named(before: Column | str, ids: Column | str) -> Column:
    """Name of the node that a run of turns leads to below the turns that ``before`` is the digest of."""
    return F.sha2(F.concat(before, F.lit(":"), F.array_join(ids, ",")), 256)


def segments(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Runs of at most ``block`` turns: conv_id, block, ids, chars, before, top and key, and whether more follow.

    ``before`` is a digest of all turns before the run, ``top`` the node they lead to and ``key`` the node the run leads
    to. The digests of long conversations are made by doubling: after j rounds a run knows its last 2^j
    ones, so that a conversation of any length takes few rounds of equi-joins.
    """
    at = F.floor((F.col("depth") - 1) / block).cast("long")
    turn = F.struct("depth", "turn_id", "chars")
    runs = rows.groupBy("conv_id", at.alias("block")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))  # at most ``block`` rows
    runs = cut(runs.select("conv_id", "block", F.col("turns.turn_id").alias("ids"), F.col("turns.chars").alias("chars")))
    last = runs.groupBy("conv_id").agg(F.max("block").alias("last"))
    short = runs.join(last.filter("last = 0"), "conv_id").withColumns({"before": F.lit(ROOT), "top": F.lit(ROOT), "more": F.lit(False)})
    long = cut(runs.join(last.filter("last > 0"), "conv_id"))
    most = long.agg(F.max("block")).first()[0] or 0
    if not most:
        return short.withColumn("key", _named("before", "ids")).drop("last")

    upto = long.select("conv_id", "block", F.sha2(F.array_join("ids", ","), 256).alias("d"))
    step = 1
    while step <= most:
        earlier = upto.select("conv_id", (F.col("block") + step).alias("block"), F.col("d").alias("e"))
        joined = upto.join(earlier, ["conv_id", "block"], "left")
        upto = cut(joined.select("conv_id", "block", F.when(F.col("e").isNull(), F.col("d")).otherwise(F.sha2(F.concat("e", F.lit("+"), "d"), 256)).alias("d")))
        step *= 2
    before = upto.select("conv_id", (F.col("block") + 1).alias("block"), F.col("d").alias("before"))
    known = long.join(before, ["conv_id", "block"], "left").withColumn("before", F.coalesce("before", F.lit(ROOT)))
    known = cut(known.withColumn("key", _named("before", "ids")).withColumn("more", F.col("block") < F.col("last")))
    tops = known.select("conv_id", (F.col("block") + 1).alias("block"), F.col("key").alias("top"))
    known = known.join(tops, ["conv_id", "block"], "left").withColumn("top", F.coalesce("top", F.lit(ROOT)))
    return short.withColumn("key", _named("before", "ids")).unionByName(known).drop("last")


def prefix_shards(found: DataFrame, shard: int = SHARD, least: int = LEAST, block: int = BLOCK) -> tuple[DataFrame, int]:
    """``found`` with the length of the prefix by which each segment is dealt, and the number of bins.

    The prefix is the first turn, and one more as long as more than a shard's segments share it. Nodes above
    the end of the prefix can be in several shards.
    """
    spark = found.sparkSession
    total, tasks = found.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    bins = max(tasks, -(-total // shard))
    limit = min(shard, max(least, total // bins))
    done, left = None, found
    for p in range(1, block + 1):
        prefix = F.slice("ids", 1, p)
        heavy = left.groupBy("top", prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select("top", "prefix")
        heavy = cut(heavy)
        dealt = left.withColumn("prefix", prefix)
        if heavy.isEmpty():
            break
        # one that ends with the prefix has all its nodes above the end of a longer one
        light = dealt.join(heavy, ["top", "prefix"], "left_anti").withColumn("p", F.lit(p))
        done = light if done is None else done.unionByName(light)
        left = cut(dealt.join(heavy, ["top", "prefix"], "left_semi").drop("prefix"))
    else:
        p, dealt = block + 1, left.withColumn("prefix", F.col("ids"))
    light = dealt.withColumn("p", F.lit(p))
    out = light if done is None else done.unionByName(light)
    return out.withColumn("bin", F.pmod(F.xxhash64("top", F.array_join("prefix", ",")), F.lit(bins))).drop("prefix"), bins


class DoubleArray:
    """A trie in two arrays: the child of the node at slot s by label c is at slot BASE[s] + c, and CHECK there is s."""

    def __init__(self, parent: np.ndarray, label: np.ndarray):
        """Nodes 1 .. n in breadth-first order, each with its parent (0 is the root) and its label, sorted within a parent."""
        n = len(parent) + 1
        size = 2 * n + int(label.max(initial=0)) + 2
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        slot = np.zeros(n, np.int64)
        self.check[0], self.top = 0, 0  # the root is its own; the last slot taken
        starts = np.searchsorted(parent, np.arange(n + 1))
        free = 1
        for node in range(n):
            a, b = starts[node], starts[node + 1]
            if a == b:
                continue
            labels = label[a:b]
            while self.check[free] >= 0:
                free += 1
            base = free - int(labels[0])
            if b - a > 1:
                base = self._room(labels, free)
            at = base + labels
            self.base[slot[node]], self.check[at], self.top = base, slot[node], max(self.top, int(at[-1]))
            slot[a + 1:b + 1] = at
            if at[-1] + n + 2 >= len(self.check):
                self._grow(2 * len(self.check) + n)
        self.slot = slot

    def _room(self, labels: np.ndarray, free: int, tries: int = 16) -> int:
        """A base at which all labels fall on free slots: at one of the next free slots, or else behind all taken ones."""
        reach = int(labels[-1] - labels[0])
        for at in free + np.flatnonzero(self.check[free:free + 4 * tries] < 0)[:tries]:
            spots = int(at) - int(labels[0]) + labels
            if int(at) + reach < len(self.check) and (self.check[spots] < 0).all():
                return int(at) - int(labels[0])
        behind = self.top + 1
        if behind + reach + 2 >= len(self.check):
            self._grow(behind + reach + len(self.check))
        return behind - int(labels[0])

    def _grow(self, size: int) -> None:
        more = size - len(self.check)
        self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
        self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def step(self, slot: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Slots of the children; a label without a child is an error here."""
        at = self.base[slot] + label
        if (self.check[at] != slot).any():
            raise KeyError("no such path")
        return at


def _edges(paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent and label of the nodes of these padded paths (-1 behind the end), breadth first."""
    order = np.lexsort(paths.T[::-1])
    paths = paths[order]
    parents, labels = [], []
    own, differs, total = np.zeros(len(paths), np.int64), np.zeros(len(paths), bool), 1
    differs[:1] = True
    for d in range(paths.shape[1]):
        here = paths[:, d] >= 0
        differs = differs | np.concatenate([[True], paths[1:, d] != paths[:-1, d]])
        new = differs & here
        # paths that go on are neighbours of those they share the prefix with
        parents.append(own[new])
        labels.append(paths[new, d])
        own = np.where(here, total - 1 + np.cumsum(new), own)
        total += int(new.sum())
    return np.concatenate(parents), np.concatenate(labels)


def shard_nodes(pdf: pd.DataFrame) -> pd.DataFrame:
    """Nodes of the shards of one bin, whole ones and parts of those that other shards, or later segments, share.

    All shards of the bin are one trie, with the node above each as first label. A node whose whole subtree lies here
    gets its totals by the walk; any other one gets its members here and the totals of its whole children.
    """
    tops, top = np.unique(pdf["top"].to_numpy(str), return_inverse=True)
    sizes = pdf["ids"].map(len).to_numpy()
    turns, flat = np.unique(np.concatenate(pdf["ids"].to_list()), return_inverse=True)
    width = int(sizes.max())
    inside = np.arange(width) < sizes[:, None]
    paths = np.full((len(pdf), width + 1), -1, np.int64)
    paths[:, 0] = top + len(turns)
    paths[:, 1:][inside] = flat
    letters = np.zeros((len(pdf), width), np.int64)
    letters[inside] = np.concatenate(pdf["chars"].to_list())

    trie = DoubleArray(*_edges(paths))
    slots, room = trie.slot, len(trie.check)
    depth, n, chars = (np.zeros(room, np.int64) for _ in range(3))
    conv = np.full(room, np.iinfo(np.int64).max)
    opened, one = np.zeros(room, bool), np.zeros(room, np.int64)  # ``one``: any row through the node
    many, least = pdf["n"].to_numpy(np.int64), pdf["conv_id"].to_numpy(np.int64)
    p, more, first = pdf["p"].to_numpy(np.int64), pdf["more"].to_numpy(bool), (pdf["block"] * pdf["span"]).to_numpy(np.int64)
    at, end = np.zeros(len(pdf), np.int64), {}
    for d in range(width + 1):
        rows = np.flatnonzero(paths[:, d] >= 0)
        at[rows] = here = trie.step(at[rows], paths[rows, d])
        np.add.at(n, here, many[rows])
        np.minimum.at(conv, here, least[rows])
        depth[here], one[here] = first[rows] + d, rows
        opened[here[(d < p[rows]) | more[rows]]] = True
        if d:
            chars[here] = letters[rows, d - 1]
    ended = np.flatnonzero(~more)
    end = dict(zip(at[ended].tolist(), pdf["key"].to_numpy(object)[ended]))

    # bottom up: breadth first backwards
    nodes = slots[1:]
    above = trie.check[nodes]
    children, leaves, saved = (np.zeros(room, np.int64) for _ in range(3))
    level = np.where(above == 0, 0, depth[nodes] - first[one[nodes]])
    for d in range(int(level.max()), 0, -1):
        s = nodes[level == d]
        s = s[~opened[s]]
        leaves[s] += children[s] == 0
        saved[s] += (n[s] - 1) * chars[s]
        for total, value in ((children, 1), (leaves, leaves[s]), (saved, saved[s])):
            np.add.at(total, trie.check[s], value)
    # a later segment's top is counted where it ends the segment before
    n[nodes[(level == 0) & (depth[nodes] > 0)]] = 0

    before, ids, names = pdf["before"].to_numpy(object), pdf["ids"].to_numpy(object), {}

    def name(s: int, lv: int) -> str:
        if s not in names:
            r = one[s]
            run = ",".join(map(str, ids[r][:lv]))
            names[s] = tops[top[r]] if lv == 0 else hashlib.sha256(f"{before[r]}:{run}".encode()).hexdigest()
        return names[s]

    out = []
    for s, a, lv in zip(nodes.tolist(), above.tolist(), level.tolist()):
        key = name(s, lv) if opened[s] else end.get(s)
        under = lv > 0 and opened[a]
        out.append((
            key, name(a, lv - 1) if under else None, conv[s], conv[a] if lv > 0 and not under else None, depth[s], n[s], chars[s],
            children[s], leaves[s], saved[s], opened[s],
        ))
    frame = pd.DataFrame(out, columns=[c.split()[0] for c in _NODE.split(", ")])
    return frame.astype({"parent_conv_id": "Int64"})


def _merged(parts: DataFrame) -> DataFrame:
    """Nodes met in several shards or segments, made whole: members added up, then totals along their own tree.

    Totals climb by pointer jumping: each round a node hands its total to the node it points at and
    takes over that one's pointer, so a path of any length takes few rounds. Only open nodes take part.
    """
    own = parts.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.max("chars").alias("chars"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    own = cut(own)
    below = own.filter(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    own = own.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    own = cut(own.drop("more").withColumns({
        "n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"),
        "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars"),
    }))
    state = own.select("key", F.col("parent_key").alias("jump"), "n_leaves", "saved_tokens")
    while not state.filter(F.col("jump").isNotNull()).isEmpty():
        up = state.filter(F.col("jump").isNotNull()).groupBy(F.col("jump").alias("key")).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        grown = state.join(up, "key", "left").withColumns({
            "n_leaves": F.col("n_leaves") + F.coalesce("l", F.lit(0)), "saved_tokens": F.col("saved_tokens") + F.coalesce("s", F.lit(0)),
        })
        # a pointer to the top has nowhere to go on to
        onward = state.filter(F.col("jump").isNotNull()).select(F.col("key").alias("to"), F.col("jump").alias("next"))
        moved = grown.join(onward, F.col("jump") == F.col("to"), "left")
        state = cut(moved.select("key", F.col("next").alias("jump"), "n_leaves", "saved_tokens"))
    return cut(own.drop("n_leaves", "saved_tokens").join(state.drop("jump"), "key"))


def end_digests(ends: DataFrame) -> DataFrame:
    """key and ends_sha256: the ids of the conversations that end in a node, ascending, joined by commas.

    The ids are sorted and joined in ranges first; a digest then reads the joined texts of its node in order, so
    the one task that a digest takes streams over few rows.
    """
    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                each = pdf.groupby("key", sort=False)["conv_id"]
                yield pd.DataFrame({"first": each.min(), "ids": each.agg(lambda x: ",".join(map(str, x)))}).reset_index()

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sha = None, None
        for pdf in batches:
            done = []
            for key, ids in zip(pdf["key"], pdf["ids"]):
                if key == now:
                    sha.update(b"," + ids.encode())
                    continue
                if sha is not None:
                    done.append((now, sha.hexdigest()))
                now, sha = key, hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=["key", "ends_sha256"])
        if sha is not None:
            yield pd.DataFrame([(now, sha.hexdigest())], columns=["key", "ends_sha256"])

    ordered = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    texts = ordered.mapInPandas(joined, "key string, first long, ids string")
    return texts.repartition("key").sortWithinPartitions("key", "first").mapInPandas(digests, "key string, ends_sha256 string")


def prefix_trie(rows: DataFrame, lengths: DataFrame, block: int = BLOCK, shard: int = SHARD, least: int = LEAST) -> DataFrame:
    """Every different prefix of the conversations as a node.

    ``rows`` holds (conv_id, depth from 1, turn_key, chars), ``lengths`` (conv_id, n_turns) of all conversations,
    turnless ones included. Columns: conv_id, the smallest member; depth; parent_conv_id; n_convs;
    n_children; n_leaves and saved_tokens over the subtree; ends_sha256 of the members that end there.

    Equal segments are combined before anything is gathered, and shards are split along the prefix until they are
    small, so neither a common conversation nor a common first turn makes a large task. Rows without conv_id are not
    read, and without any conversation there is no node.
    """
    runs = cut(segments(dense_turns(rows), block))
    alike = runs.groupBy("block", "before", "top", "key", "ids", "chars").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.max("more").alias("more"),
    )
    dealt, bins = prefix_shards(cut(alike), shard, least, block)
    dealt = dealt.withColumn("span", F.lit(block).cast("long"))
    parts = cut(dealt.groupBy("bin").applyInPandas(shard_nodes, _NODE))

    # the root is there for conversations without turns too
    bare = lengths.filter("n_turns = 0")
    root = bare.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("parent_key"), "conv_id", F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(0).cast("long").alias("depth"), "n_convs", *[F.lit(0).cast("long").alias(c) for c in ("chars", "n_children", "n_leaves", "saved_tokens")],
        F.lit(True).alias("open"),
    )
    shared = _merged(parts.filter("open").unionByName(root))
    whole = parts.filter("NOT open")

    tops = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    columns = ["key", "conv_id", "parent_conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    nodes = whole.filter("parent_key IS NULL").select(columns)
    for some in (whole.filter("parent_key IS NOT NULL"), shared):
        nodes = nodes.unionByName(some.drop("parent_conv_id").join(tops, "parent_key", "left").withColumnRenamed("_parent", "parent_conv_id").select(columns))
    nodes = cut(nodes)

    ends = runs.filter("NOT more").select("key", "conv_id").unionByName(bare.select(F.lit(ROOT).alias("key"), "conv_id"))
    # nodes where nothing ends need no join
    named = nodes.filter(F.col("key").isNotNull()).join(end_digests(ends), "key", "left")
    nodes = named.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY))).unionByName(
        nodes.filter(F.col("key").isNull()).withColumn("ends_sha256", F.lit(_EMPTY))
    )
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

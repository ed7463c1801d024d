"""Near-duplicates by Jaccard similarity of shingle sets: the fingerprints of ``simhash`` first, prefix signatures for what
they leave apart, and exact verification of both."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import components, small_batches
from snapflow.llm.simhash import bits_set, first_of_each, majority, near_links
from snapflow.session import cut, drop_folders, work_dir

WORDS = 5
SEED = 42  # of the shingle hash
#: Similarity from which two documents are copies, as a fraction of integers.
NUM, DEN = 4, 5
#: The order of shingles puts those last that are frequent in about so many texts.
SAMPLE = 4_096
#: At most so many frequent shingles are known to every task.
FREQUENT = 65_536
#: Numbers that tell texts which cannot be asked for; so many rows at most are broadcast.
SLOTS = 1 << 20
#: Rounds that compare with one member of each group before all pairs left are compared.
CENTRES = 2
_PART = 1 << 16


def shingle_hashes(text: str | None, k: int = WORDS) -> np.ndarray:
    """Hashes of the runs of k words, repeats included; a shorter text is one shingle, none without words.

    Words are those of the fingerprints: runs of anything but ASCII white space, A-Z in lower case.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    k = min(k, len(words))
    hash_of = xxhash.xxh64_intdigest
    return np.fromiter((hash_of(b" ".join(words[i:i + k]), SEED) for i in range(len(words) - k + 1)), np.uint64)


def shingle_set(text: str | None, k: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(shingle_hashes(text, k).view(np.int64))


def fingerprint_of_hashes(hashes: np.ndarray) -> int:
    """The fingerprint of ``simhash`` over these shingle hashes, a bounded part of them at a time."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _PART):
        total += bits_set(hashes[at:at + _PART])
    return majority(total, len(hashes))


def prefix_size(n: int) -> int:
    """How many first shingles, in any order common to all sets, two sets of this similarity share one of."""
    return n - -(-NUM * n // DEN) + 1 if n else 0


def in_order(hs: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hashes with frequent ones last, the most frequent at the end; ``frequent`` is sorted."""
    if not len(frequent):
        return hs
    at = np.minimum(np.searchsorted(frequent, hs), len(frequent) - 1)
    return hs[np.lexsort((hs, np.where(frequent[at] == hs, counts[at], 0)))]


def shingles(text: Column | str) -> Column:
    @F.pandas_udf("array<long>")
    def sets(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t) for t in texts], dtype=object)

    return sets(text)


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of a bounded sample of texts hold, and in how many.

    They only order the shingles, so that phrases of very many documents are seldom
    in a signature; which pairs are found does not depend on them.
    """
    share = max(1, texts.count() // SAMPLE)
    some = texts.filter(F.pmod("tkey", F.lit(share)) == 0).dropDuplicates(["tkey"])
    counted = some.select(F.explode(shingles("text")).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("c"))
    rows = counted.filter("c > 2").orderBy(F.desc("c"), "h").limit(FREQUENT).toPandas().sort_values("h")
    return rows["h"].to_numpy(np.int64), rows["c"].to_numpy(np.int64)


def verified(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets whose Jaccard similarity is large enough."""
    of = lambda c: held.select(F.col("sid").alias(c), F.col("hs").alias(f"h{c}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    shared = F.size(F.array_intersect("ha", "hb"))
    enough = shared * (NUM + DEN) >= (F.size("ha") + F.size("hb")) * NUM  # shared / (all - shared) >= NUM / DEN
    return both.filter(enough).select("a", "b")


def likely(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures share enough for copies, of pairs (a, na, b, nb) of sets with their sizes.

    What two sets share outside their signatures lies behind the signature that ends first in the order, so it is no
    more than the larger of the two rests. Copies pass whatever the order; sets that share a passage seldom do.
    """
    of = lambda c: signatures.select(F.col("sid").alias(c), F.col("hs").alias(f"h{c}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    rest = F.ceil(F.greatest("na", "nb") * NUM / DEN) - 1
    most = F.size(F.array_intersect("ha", "hb")) + rest
    return both.filter(most * (NUM + DEN) >= (F.col("na") + F.col("nb")) * NUM).select("a", "b")


def fingerprint_pairs(points: DataFrame) -> DataFrame:
    """Pairs (a, na, b, nb) of sets that the fingerprints link, of ``points`` (sid, n, fp): sets of equal fingerprints with one
    of them, and these with one another where the vantage-point shards of ``simhash`` join their fingerprints."""
    one = lambda c: F.struct("sid", "n").alias(c)
    centres = cut(points.groupBy("fp").agg(F.min(F.struct("sid", "n")).alias("c")))
    equal = points.join(centres, "fp").select(one("x"), F.col("c").alias("y"))
    of = lambda c, y: centres.select(F.col("fp").alias(c), F.col("c").alias(y))
    near = near_links(centres.select("fp")).join(of("a", "x"), "a").join(of("b", "y"), "b").select("x", "y")
    pairs = equal.filter(F.col("x.sid") != F.col("y.sid")).unionByName(near)
    return _sized(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))


def _sized(pairs: DataFrame) -> DataFrame:
    """Pairs of structs (sid, n) as (a, na, b, nb)."""
    return pairs.select(F.col("a.sid").alias("a"), F.col("a.n").alias("na"), F.col("b.sid").alias("b"), F.col("b.n").alias("nb"))


def _near_labels(links: DataFrame) -> DataFrame:
    """(node, root): a node at most two links away, the smallest by hash; nodes of one root are connected.

    Enough to leave out pairs between centre rounds, where most members hang on a centre, for a few shuffles instead
    of the rounds that whole components take. Equal roots are always joined; joined nodes may differ in root.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("by")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("by")))
    least = lambda c: F.min_by(c, F.xxhash64(c))
    first = both.unionByName(both.select("node", F.col("node").alias("by"))).groupBy("node").agg(least("by").alias("root"))
    reached = both.join(first.withColumnRenamed("node", "by"), "by").select("node", "root")
    return reached.unionByName(first).groupBy("node").agg(least("root").alias("root"))


def _asked_texts(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """(sid, text) of the documents whose keys are in ``asked`` (sid, _key).

    Texts leave before the shuffle where no asked key falls into their slot; the slots in use, at most ``SLOTS``
    numbers whatever the table, are broadcast.
    """
    slot = lambda key: F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int").alias("slot")
    keyed = texts.select(F.struct("doc_id", "tkey").alias("_key"), "text")
    used = asked.select(slot("_key")).distinct()
    near = keyed.withColumn("slot", slot("_key")).join(F.broadcast(used), "slot", "left_semi")
    return near.join(asked, "_key").select("sid", "text")


def copy_groups(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, sid and root of every document: documents of one root are joined by copies.

    Copies share 0.8 or more of all shingles of both. ``sid`` is a hash of the shingle
    set, and equal sets are one point. Fingerprints over the same shingles are joined through the
    vantage-point shards of ``simhash`` first, and its links are verified on the sets. Copies can differ in
    more bits than a tree can be searched for; the signatures find those: in any fixed order of all shingles, two
    copies share one of the first n - 0.8 n + 1 of their n shingles, so no pair is missed. Of
    sets of different labels with a signature shingle in common, all are compared with one member first; then,
    and only where that leaves several labels, all pairs of different labels.

    Signatures are shuffled twice, once to count the documents of a shingle and once to keep the shingles that
    several have. Pairs are weighed by what their signatures share, and shingle sets are made again for the documents
    of the pairs left only.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select("doc_id", F.xxhash64("text").alias("tkey"), "text")
    known = spark.sparkContext.broadcast(_frequent(texts))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            hashes = [shingle_hashes(t) for t in pdf["text"]]
            sets = [np.unique(h.view(np.int64)) for h in hashes]
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"], "tkey": pdf["tkey"], "n": [len(s) for s in sets],
                "sid": np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64),
                "fp": np.array([fingerprint_of_hashes(h) for h in hashes], np.uint64).view(np.int64),
                "first": [in_order(s, *known.value)[:prefix_size(len(s))] for s in sets],
            })

    kind = docs.schema["doc_id"].dataType.simpleString()
    # ids as they are: pandas would make floats of integers beside nulls
    plain = texts.select(F.col("doc_id").cast("string").alias("doc_id"), "tkey", "text")
    signed = plain.mapInPandas(sign, "doc_id string, tkey long, n int, sid long, fp long, first array<long>")
    signed_at, points_at = work_dir(spark, "signed"), work_dir(spark, "points")
    signed = cut(signed.withColumn("doc_id", F.col("doc_id").cast(kind)), signed_at)
    one = F.min(F.struct("doc_id", "tkey")).alias("_key")  # a document that has the set; a struct compares null ids as equal
    points = cut(signed.groupBy("sid").agg(one, F.min("n").alias("n"), F.min("fp").alias("fp"), F.any_value("first").alias("first")), points_at)
    marks = cut(signed.drop("n", "fp", "first"))
    drop_folders(spark, [signed_at])
    entries = points.select("sid", "n", F.posexplode("first").alias("at", "h"))
    shared = points.select(F.explode("first").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h")
    members = cut(entries.join(shared, "h"))
    keys = cut(points.select("sid", "_key", "n", "fp"))
    drop_folders(spark, [points_at])
    held_of = cut(members.groupBy("sid").agg(F.collect_list("h").alias("hs")))  # a signature's shared shingles

    def copies(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are copies, of pairs (a, na, b, nb)."""
        pairs = cut(likely(pairs, held_of))
        asked = cut(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct().join(keys.select("sid", "_key"), "sid"))
        held_at = work_dir(spark, "held")
        held = cut(_asked_texts(texts, asked).select("sid", shingles("text").alias("hs")).dropDuplicates(["sid"]), held_at)
        found = cut(verified(pairs, held))
        drop_folders(spark, [held_at])
        return found

    links = copies(fingerprint_pairs(keys))
    roots = cut(_near_labels(links))
    for salt in [*range(CENTRES), None]:
        now = members.join(roots, F.col("sid") == F.col("node"), "left")
        now = now.withColumn("root", F.coalesce("root", "sid")).select("h", "sid", "n", "at", "root")
        open_groups = now.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("h")
        now = cut(now.join(open_groups, "h"))
        if not now.take(1):
            break
        if salt is None:
            other = now
        else:
            centre = F.min_by(F.struct("sid", "n", "at", "root"), F.xxhash64("sid", F.lit(salt)))
            other = now.groupBy("h").agg(centre.alias("c")).select("h", "c.*")
        other = other.select("h", F.col("sid").alias("s2"), F.col("n").alias("n2"), F.col("at").alias("at2"), F.col("root").alias("r2"))
        # at the first shingle two copies share, enough are left behind it in both
        left = F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2"))
        near = left * (NUM + DEN) >= (F.col("n") + F.col("n2")) * NUM
        pairs = now.join(other, "h").filter((F.col("root") != F.col("r2")) & near)
        one, two = F.struct("sid", "n"), F.struct(F.col("s2").alias("sid"), F.col("n2").alias("n"))
        pairs = pairs.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()
        links = links.unionByName(copies(_sized(pairs)))
        if salt is not None:
            roots = cut(_near_labels(links))
    roots = components(links)
    joined = marks.join(roots.withColumnRenamed("node", "sid"), "sid", "left")
    return joined.select("doc_id", "tkey", "sid", F.coalesce("root", "sid").alias("root"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of copies: the smallest id, given ones before null, then the smallest text hash."""
    return first_of_each(docs, copy_groups(docs))

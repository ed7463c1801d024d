"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification.

Only DataFrame functions: words, shingles, hashes and intersections stay in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.session import cut

WORDS = 5
CONTAINED = 0.8


def words(text: Column | str) -> Column:
    """Lower-case runs of letters and digits."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _windows(w: Column, k: int, of_parts, of_all) -> Column:
    """One value for the k words from each place on; a shorter text is one shingle, none without words."""
    n = F.size(w)
    full = F.transform(F.sequence(F.lit(0), n - k), lambda i: of_parts([F.get(w, i + d) for d in range(k)]))
    return F.when(n >= k, full).when(n > 0, F.array(of_all(w)))


def shingles(w: Column, k: int = WORDS) -> Column:
    """Distinct shingles as text, null without words."""
    return F.array_distinct(_windows(w, k, lambda p: F.concat_ws(" ", *p), lambda a: F.array_join(a, " ")))


def shingle_hashes(w: Column, k: int = WORDS) -> Column:
    """Hashes of all shingles, repeats included."""
    return _windows(w, k, lambda p: F.xxhash64(*p), F.xxhash64)


def item_index(items: DataFrame, k: int = WORDS, contained: float = CONTAINED) -> DataFrame:
    """(item, item_id, shingles, n, need, minima): every item with the signature it is searched by.

    ``need`` is the least number of its n shingles a containing document shares. The
    signature is its n - need + 1 smallest shingle hashes: as n - need shingles at
    most may be missing, a containing document always shares one of the signature, so
    the search misses nothing whatever the sizes. Items without words are left out.
    """
    made = items.select("item_id", words("text").alias("w")).filter(F.size("w") > 0).distinct().select(
        "item_id", shingles(F.col("w"), k).alias("shingles"), F.array_distinct(shingle_hashes(F.col("w"), k)).alias("hs")
    )
    sized = made.withColumn("n", F.size("shingles")).withColumn("need", F.ceil(F.col("n") * contained - 1e-9).cast("int"))
    return sized.select(
        F.xxhash64("item_id", "shingles").alias("item"), "item_id", "shingles", "n", "need",
        F.slice(F.array_sort("hs"), F.lit(1), F.col("n") - F.col("need") + 1).alias("minima"),
    )


def candidates(docs: DataFrame, index: DataFrame, k: int = WORDS) -> DataFrame:
    """Distinct (did, tkey, item): documents that share a signature hash and are large enough.

    Items are partitioned by size, in powers of two, and a document only probes the
    partitions it is long enough to contain. The signatures are written first, so
    that Spark knows their size: it broadcasts them below its own threshold and joins
    by shuffle above. A shingle held by very many documents gives each one row, and the
    hits of a document are combined before they are shuffled.
    """
    smallest = F.pow(F.lit(2.0), F.floor(F.log2("need"))).cast("int")  # of the item's partition
    entries = cut(index.select("item", smallest.alias("smallest"), F.explode("minima").alias("h")))
    # words apart from what is made of them, or each shingle would split its text again
    hashed = docs.select("did", "tkey", words("text").alias("w")).select(
        "did", "tkey", F.coalesce(F.size("w"), F.lit(0)).alias("n"), shingle_hashes(F.col("w"), k).alias("hs")
    )
    # an outer generator and a size that cannot be null, because filters inferred from them would hash every text again
    probes = hashed.select("did", "tkey", "n", F.explode_outer("hs").alias("h"))
    return probes.join(entries, "h").filter(F.col("n") >= F.col("smallest")).select("did", "tkey", "item").distinct()


def contaminated(docs: DataFrame, items: DataFrame, k: int = WORDS, contained: float = CONTAINED) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment): documents holding 0.8 or more of an item.

    Shingles are the distinct runs of five words, words being runs of letters and
    digits in lower case; a text of fewer words is one shingle. Candidates of the
    MinHash search are verified on the shingles themselves. There is one row per pair
    of ids; where ids repeat, that of the largest containment. Null texts and texts
    without words hold nothing and are held by nothing, null ids are ids like others,
    and other columns are not read.
    """
    index = cut(item_index(items, k, contained))
    rows = docs.select(F.col("doc_id").alias("did"), F.xxhash64("text").alias("tkey"), "text")
    pairs = candidates(rows, index, k).join(index.drop("minima"), "item")
    wanted = cut(pairs.groupBy("did", "tkey").agg(F.collect_list(F.struct("item_id", "shingles", "n", "need")).alias("items")))
    wanted = wanted.withColumnsRenamed({"did": "d", "tkey": "t"})
    same = F.col("did").eqNullSafe(F.col("d")) & (F.col("tkey") == F.col("t"))
    # a document's shingles are made once, whatever the number of items it may hold; the list
    # of documents grows with the table, so the join is by shuffle at every size
    held = rows.join(wanted.hint("shuffle_hash"), same).select("did", "items", words("text").alias("w")).select("did", "items", shingles(F.col("w"), k).alias("held"))
    each = held.select("did", "held", F.explode("items").alias("i"))
    checked = each.select(
        F.col("did").alias("doc_id"), "i.item_id", "i.n", "i.need", F.size(F.array_intersect("i.shingles", "held")).alias("n_shared")
    ).filter(F.col("n_shared") >= F.col("need"))
    share = F.col("n_shared") / F.col("n")
    return checked.groupBy("doc_id", "item_id").agg(
        F.max_by("n_shared", share).alias("n_shared"), F.max_by("n", share).alias("n_shingles"), F.round(F.max(share), 6).alias("containment")
    )

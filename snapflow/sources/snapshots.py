"""Versioned Parquet snapshots of a keyed table.

    <root>/data/w=<write>/bucket=<b>/...   rows of the buckets that one write changed
    <root>/zones/w=<write>/...             for searched tables, the range of each file of a write
    <root>/manifest/w=<write>/...          for each bucket, the version and the write holding it
    <root>/commits/<n>.json                the commit: its id, its batch, its counts and its manifest

Rows go to buckets by key hash. A commit rewrites only the buckets in which its
batch changes a row, never a path being read, and becomes visible with its file
under commits, which is written last and only if there is none of that number; a
job that dies before leaves the previous version in place, and of several writers the
later one goes on from the earlier one's version. Where the cluster offers a table
format with MERGE, use that instead.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from snapflow.operators.upsert import ACTION, INSERT, SKIP, UPDATE, WRITTEN, changes
from snapflow.session import session_conf
from snapflow.sources.markers import create_if_absent, numbered, read_text

BUCKET, SLICE = "bucket", "slice"
_MANIFEST = "bucket int, data_version int, folder string, buckets int"
_COMMITS = "commit_id string, mark string, attempted long, inserted long, updated long, skipped long, v int, manifest string"
#: Key sets up to this size are compared in the scan too, where Bloom filters skip row groups.
FEW_KEYS = 10


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def commits(spark: SparkSession, root: str) -> DataFrame:
    """All commits of a table, one row each; empty before the first."""
    try:
        return spark.read.schema(_COMMITS).json(f"{root}/commits")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], _COMMITS)
        raise


def newest(spark: SparkSession, root: str) -> int:
    """Number of the newest version; 0 before the first."""
    return max(numbered(spark, f"{root}/commits"), default=0)


def manifest(spark: SparkSession, root: str, version: int | None = None) -> list[Row]:
    """Rows of one manifest, the newest by default: one row per filled bucket."""
    version = newest(spark, root) if version is None else version
    if not version:
        return []
    made = json.loads(read_text(spark, f"{root}/commits/{version}.json"))
    rows = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest/w={made['manifest']}")
    return rows.withColumn("v", F.lit(version)).collect()


def _folder(root: str, part: Row) -> str:
    return f"{root}/data/w={part.folder}/{BUCKET}={part.bucket}"


def _read_paths(spark: SparkSession, root: str, schema: str, paths: list[str], extra: str = "") -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema + extra)
    read = spark.read.schema(f"{schema}{extra}, w string, {BUCKET} int").option("basePath", f"{root}/data")
    return read.parquet(*paths).drop("w", BUCKET).select(*spark.createDataFrame([], schema + extra).columns)


def _read(spark: SparkSession, root: str, schema: str, parts: list[Row], extra: str = "") -> DataFrame:
    return _read_paths(spark, root, schema, [_folder(root, p) for p in parts], extra)


def read_snapshot(
    spark: SparkSession, root: str, schema: str, version: int | None = None
) -> DataFrame:
    """The table as of a version (newest by default)."""
    return _read(spark, root, schema, manifest(spark, root, version))


def parts_of(keys: DataFrame, root: str, by: list[str], version: int | None = None) -> list[Row]:
    """The manifest rows of the buckets that a set of keys falls into; at most one row per bucket reaches the driver."""
    parts = manifest(keys.sparkSession, root, version)
    if not parts:
        return []
    hit = {r[BUCKET] for r in keys.select(bucket_of(by, parts[0].buckets).alias(BUCKET)).distinct().collect()}
    return [p for p in parts if p.bucket in hit]


def read_for_keys(keys: DataFrame, root: str, schema: str, by: list[str], version: int | None = None) -> DataFrame:
    """Rows of the keys' own buckets, which hold all rows of these keys and others; the join is the caller's.

    A few keys are also compared in the scan, so that the Bloom filters of ``commit`` skip what lacks them.
    """
    read = _read(keys.sparkSession, root, schema, parts_of(keys, root, by, version))
    if len(by) == 1:
        few = keys.select(by[0]).distinct().limit(FEW_KEYS + 1).collect()
        if len(few) <= FEW_KEYS:
            return read.filter(F.col(by[0]).isin([r[0] for r in few]))
    return read


def read_changes(spark: SparkSession, root: str, schema: str, version: int) -> DataFrame:
    """Rows a commit inserted or updated, with the action."""
    parts = [p for p in manifest(spark, root, version) if p.data_version == version]
    return changes(_read(spark, root, schema, parts, f", {ACTION} string"))


def read_feed(spark: SparkSession, root: str, schema: str, first: int = 1, last: int | None = None) -> DataFrame:
    """Rows inserted or updated by the versions ``first`` to ``last``, with the version and the action.

    Every bucket that one of these versions wrote is read once; the newest version is the default end.
    """
    last = newest(spark, root) if last is None else last
    versions = {}
    for v in range(first, last + 1):  # a bucket written by v is in v's own manifest
        versions[v] = [p for p in manifest(spark, root, v) if p.data_version == v]
    folders = {p.folder: v for v, parts in versions.items() for p in parts}
    extra = f", {ACTION} string"
    if not folders:
        return spark.createDataFrame([], f"{schema}{extra}, version int")
    paths = [_folder(root, p) for parts in versions.values() for p in parts]
    read = spark.read.schema(f"{schema}{extra}, w string, {BUCKET} int").option("basePath", f"{root}/data").parquet(*paths)
    known = F.create_map(*[F.lit(x) for pair in folders.items() for x in pair])
    columns = spark.createDataFrame([], schema + extra).columns
    return changes(read.withColumn("version", known[F.col("w")]).select(*columns, "version"))


def commit_counts(spark: SparkSession, root: str, version: int) -> DataFrame:
    """Rows attempted, inserted, updated and skipped by a commit."""
    return commits(spark, root).filter(F.col("v") == version).select(
        "attempted", F.col("inserted").alias(INSERT), F.col("updated").alias(UPDATE), F.col("skipped").alias(SKIP)
    )


_MANIFEST_FILE = pa.schema([("bucket", pa.int32()), ("data_version", pa.int32()), ("folder", pa.string()), ("buckets", pa.int32())])


def commit(
    batch: DataFrame,
    root: str,
    schema: str,
    keys: list[str],
    merge: Callable[[DataFrame, DataFrame, list[str]], DataFrame],
    buckets: int = 64,
    commit_id: str | None = None,
    layout: tuple[str, ...] = (),
    order: tuple[str, ...] = (),
) -> int:
    """Merge a batch into the table and return the version that holds it.

    ``merge(state, batch, keys)`` is an upsert; its keys include the bucket and a
    slice of it, so that one shuffle of each side serves the join and the layout
    and several tasks serve a bucket. Actions are found first, from keys and compared
    columns, and only buckets with an insert or update are written; a batch that
    changes nothing adds no data. The bucket count is fixed by the first commit.

    A ``commit_id`` names the slice of input, say run and shard. An id that any
    earlier commit had is a replay and changes nothing, whatever came after; the same
    id with other rows raises.

    Writers need no lock. Each merges into the version it found and creates the next
    number's commit file; one who finds that file there takes the other's version as
    his base, keeps his buckets that the other did not touch and merges the rest again.

    ``layout`` columns become folders below the bucket and ``order`` sorts each file,
    for searches on them; the ranges of the first of them are kept by file.
    """
    spark = batch.sparkSession
    version = newest(spark, root)
    current = manifest(spark, root, version)
    if current:
        buckets = current[0].buckets

    given, batch = batch, batch.withColumn(BUCKET, bucket_of(keys, buckets)).persist()
    try:
        # at most one row per bucket reaches the driver
        part = batch.groupBy(BUCKET).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*given.columns).cast("decimal(38,0)")).alias("h")
        ).collect()
        mark = f"{sum(r.n for r in part)}-{sum(r.h for r in part)}"
        hit, done, seen_upto = {r[BUCKET] for r in part}, {}, 0
        while True:
            if commit_id is not None and version > seen_upto:
                seen = commits(spark, root).filter((F.col("commit_id") == commit_id) & (F.col("v") > seen_upto)).first()
                if seen is not None and seen.mark != mark:
                    raise ValueError(f"commit {commit_id!r} returns with other rows")
                if seen is not None:
                    return version
            if not hit:  # nothing to replay either
                return version
            if current and current[0].buckets != buckets:  # another writer made the first commit
                batch.unpersist()
                return commit(given, root, schema, keys, merge, buckets, commit_id, layout, order)
            stale = hit if not done else {p.bucket for p in current if p.data_version > seen_upto} & hit
            if stale:
                done.update(_merged(batch, current, stale, root, schema, keys, merge, buckets, layout, order))
            seen_upto, version = version, version + 1
            write = f"x{uuid.uuid4().hex}"
            holds = {p.bucket: (p.data_version, p.folder) for p in current}
            holds |= {b: (version, folder) for b, (folder, _) in done.items() if folder}
            rows = [{"bucket": b, "data_version": v, "folder": f, "buckets": buckets} for b, (v, f) in holds.items()]
            made = spark.createDataFrame(pa.Table.from_pylist(rows, _MANIFEST_FILE))
            made.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/w={write}")
            n = {a: sum(counts.get(a, 0) for _, counts in done.values()) for a in (INSERT, UPDATE, SKIP)}
            row = {
                "commit_id": commit_id, "mark": mark, "attempted": sum(n.values()), "inserted": n[INSERT],
                "updated": n[UPDATE], "skipped": n[SKIP], "v": version, "manifest": write,
            }
            if create_if_absent(spark, f"{root}/commits/{version}.json", json.dumps(row)):
                return version
            version = newest(spark, root)
            current = manifest(spark, root, version)
    finally:
        batch.unpersist()


def _merged(
    batch: DataFrame, current: list[Row], hit: set[int], root: str, schema: str, keys: list[str],
    merge: Callable[[DataFrame, DataFrame, list[str]], DataFrame], buckets: int, layout: tuple[str, ...], order: tuple[str, ...],
) -> dict[int, tuple[str | None, dict[str, int]]]:
    """Merge the batch into some buckets of a version: for each, the write that holds it, if it changed, and its actions."""
    spark, write = batch.sparkSession, f"x{uuid.uuid4().hex}"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def merged(hit: set[int]) -> DataFrame:
        slices = -(-tasks // len(hit))
        part = F.pmod(F.floor(F.pmod(F.xxhash64(*keys), F.lit(buckets * slices)) / buckets), F.lit(slices)).cast("int")
        state = _read(spark, root, schema, [p for p in current if p.bucket in hit]).withColumn(BUCKET, bucket_of(keys, buckets))
        new = batch.filter(F.col(BUCKET).isin(hit))
        sides = [d.withColumn(SLICE, part).repartition(BUCKET, SLICE) for d in (state, new)]
        return merge(*sides, [BUCKET, SLICE, *keys])

    with session_conf(spark, spark__sql__requireAllClusterKeysForCoPartition="false"):
        actions = merged(hit).groupBy(BUCKET, ACTION).agg(F.count(F.lit(1)).alias("n")).collect()
        changed = {r[BUCKET] for r in actions if r[ACTION] in WRITTEN}
        if changed:
            rows = merged(changed).drop(SLICE)
            if layout or order:
                rows = rows.sortWithinPartitions(BUCKET, *layout, *order)
            target = rows.write.mode("overwrite").partitionBy(BUCKET, *layout)
            for key in keys:  # of the size that the distinct keys of a file ask for
                target = target.option(f"parquet.bloom.filter.enabled#{key}", "true")
            target.option("parquet.bloom.filter.adaptive.enabled", "true").parquet(f"{root}/data/w={write}")
            if order:
                _write_zones(spark, root, write, layout, order[0])
    counts: dict[int, dict[str, int]] = {}
    for r in actions:
        counts.setdefault(r[BUCKET], {})[r[ACTION]] = r["n"]
    return {b: (write if b in changed else None, counts.get(b, {})) for b in hit}


def _write_zones(spark: SparkSession, root: str, write: str, layout: tuple[str, ...], column: str) -> None:
    """Range of ``column`` in every file of a write, beside its folders; one narrow scan of what was just written."""
    data = spark.read.option("basePath", f"{root}/data").parquet(f"{root}/data/w={write}")
    zones = data.groupBy(BUCKET, *layout, F.col("_metadata.file_path").alias("file")).agg(
        F.min(column).alias("least"), F.max(column).alias("most"), F.count(F.lit(1)).alias("n_rows")
    )
    zones.coalesce(1).write.mode("overwrite").parquet(f"{root}/zones/w={write}")


def zones(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The files of a version of a searched table: bucket, layout columns, file, least, most and n_rows."""
    parts = manifest(spark, root, version)
    if not parts:
        return spark.createDataFrame([], "bucket int, file string, least long, most long, n_rows long")
    live = spark.createDataFrame([(p.bucket, p.folder) for p in parts], f"{BUCKET} int, w string")
    paths = [f"{root}/zones/w={w}" for w in sorted({p.folder for p in parts})]
    return spark.read.option("basePath", f"{root}/zones").parquet(*paths).join(F.broadcast(live), [BUCKET, "w"], "left_semi").drop("w")


def files_between(spark: SparkSession, root: str, lo, hi, version: int | None = None, **layout) -> list[str]:
    """The files of a searched table whose range meets lo..hi, in folders of the given layout values; chosen before any is opened."""
    version = newest(spark, root) if version is None else version
    if not version:  # no table yet, so no layout columns either
        return []
    found = zones(spark, root, version).filter((F.col("least") <= F.lit(hi)) & (F.col("most") >= F.lit(lo)))
    for column, value in layout.items():
        found = found.filter(F.col(column) == value)
    return sorted(r.file for r in found.select("file").collect())


def search(state: DataFrame, strong: int, lo: int, hi: int) -> DataFrame:
    return state.filter((F.col("strong") == strong) & F.col("price").between(lo, hi))


def search_snapshot(spark: SparkSession, root: str, schema: str, strong: int, lo: int, hi: int, version: int | None = None) -> DataFrame:
    """Prices of a grade in a range: only files that can hold one are listed and opened."""
    return search(_read_paths(spark, root, schema, files_between(spark, root, lo, hi, version, strong=strong)), strong, lo, hi)

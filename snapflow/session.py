"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_made: list[str] = []  # folders handed out by this process

SESSION_CONF = {
    # naive-UTC columns are compared with instants, so the zone must be fixed
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # pages are large rows: keep the Arrow batches handed to Python small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "snapflow", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Only a local master without the setting gets a temporary folder; a cluster
    without it is refused, because a machine-local folder dies with its machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None)
    current = sc.getCheckpointDir()
    if current:
        return named or current
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        named = tempfile.mkdtemp(prefix="snapflow-")
    sc.setCheckpointDir(named)
    return named


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder path under the shared checkpoint folder."""
    _made.append(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}")
    return _made[-1]


def made_folders() -> list[str]:
    """The folders handed out and not yet removed."""
    return list(_made)


def drop_folders(spark: SparkSession, paths: list[str]) -> None:
    """Remove some of the folders handed out; for when no frame that reads them is needed any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in paths:
        if name in _made:
            _made.remove(name)
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


def drop_work(spark: SparkSession) -> None:
    """Remove the folders handed out so far; for when no frame that reads them is needed any more."""
    drop_folders(spark, made_folders())


def cut(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder, so that later passes see the same rows.

    A columnar table rather than an RDD checkpoint: each later pass reads only
    the columns it needs. ``path`` is a folder from ``work_dir`` for callers that drop it themselves.
    """
    path = path or work_dir(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_held: dict[str, tuple[int, str | None]] = {}  # settings in force: by how many blocks, and the value before
_holding = threading.Lock()


@contextmanager
def session_conf(spark: SparkSession, **conf: str) -> Iterator[None]:
    """SQL settings for the actions run inside the block; dots are written as ``__``.

    Blocks of several threads may overlap: the value before comes back with the end of the last one.
    """
    settings = {k.replace("__", "."): v for k, v in conf.items()}
    with _holding:
        for k, v in settings.items():
            n, before = _held.get(k, (0, None))
            _held[k] = (n + 1, before if n else spark.conf.get(k, None))
            spark.conf.set(k, v)
    try:
        yield
    finally:
        with _holding:
            for k in settings:
                n, before = _held.pop(k)
                if n > 1:
                    _held[k] = (n - 1, before)
                elif before is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, before)

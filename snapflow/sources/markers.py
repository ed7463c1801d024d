"""Small text files that are created whole, and only where none is: the rows that decide who was first."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(conf)


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``text`` to ``path`` unless there is a file; whether this call wrote it.

    A file of another name is moved into place without overwriting, as streaming checkpoints do: on HDFS
    one of several writers succeeds, and no reader sees half a file.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, fs = _path(spark, path)
    if fs.exists(target):
        return False
    temp = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(temp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    qualified = fs.makeQualified(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), conf)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(fs.makeQualified(temp), qualified, options)
        return True
    except Py4JJavaError as e:
        fs.delete(temp, False)
        if fs.exists(target):
            return False
        raise e


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return None
    source = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, hidden ones left out; empty if there is no such folder."""
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return []
    found = [status.getPath().getName() for status in fs.listStatus(target)]
    return sorted(n for n in found if not n.startswith((".", "_")))


def numbered(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the files ``<number>.json`` of a folder, ascending."""
    return sorted(int(n.removesuffix(".json")) for n in names(spark, path) if n.endswith(".json"))

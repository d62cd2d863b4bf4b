"""Folders of the shared file system: listing, finished writes, removal."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def finished(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Sorted names ``prefix...`` of the folders under ``root`` whose write has finished, from one listing."""
    p, fs = _path(spark, f"{root.rstrip('/')}/{prefix}*/_SUCCESS")
    return sorted(st.getPath().getParent().getName() for st in fs.globStatus(p) or ())


def names(spark: SparkSession, root: str, pattern: str = "*") -> list[str]:
    """Sorted names under ``root`` that match ``pattern``, finished or not."""
    p, fs = _path(spark, f"{root.rstrip('/')}/{pattern}")
    return sorted(st.getPath().getName() for st in fs.globStatus(p) or ())


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, as a mark that something is done."""
    p, fs = _path(spark, path)
    fs.create(p, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove one folder and what is in it."""
    p, fs = _path(spark, path)
    fs.delete(p, True)


def newest_change(spark: SparkSession, path: str) -> int:
    """Latest modification time (ms) of ``path`` and, if it is a folder, of its direct entries."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return 0
    return max([fs.getFileStatus(p).getModificationTime(), *(st.getModificationTime() for st in fs.listStatus(p))])

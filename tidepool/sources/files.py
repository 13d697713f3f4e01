"""Small file-system calls through Hadoop's FileSystem, so paths on any
cluster store (HDFS, object stores, local) behave the same way.

Only metadata calls live here; data always moves through DataFrame readers
and writers.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    """Recursively delete one folder or file; True if something was removed."""
    fs, p = _fs_and_path(spark, path)
    return bool(fs.delete(p, True))


def mkdirs(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.mkdirs(p))


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a folder; one atomic step on HDFS and local disks."""
    fs, p = _fs_and_path(spark, old)
    if not fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"cannot move {old} to {new}")


def list_children(spark: SparkSession, path: str) -> list[str]:
    """Names (not paths) of the direct children of ``path``."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)]


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under ``path``."""
    fs, p = _fs_and_path(spark, path)
    return int(fs.getContentSummary(p).getLength())

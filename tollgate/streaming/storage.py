"""Folders on the cluster's file system: what a streaming job must know or clean up itself."""

from __future__ import annotations

from pyspark.sql import SparkSession

GROUP = 1000               # batches per folder level, which keeps directories short


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it does not exist."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def has_files(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p) and fs.listFiles(p, True).hasNext()


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def batch_path(path: str, batch_id: int) -> str:
    """The folder of a batch below ``path``, as written by ``partitionBy("batch_group", "batch_id")``."""
    return f"{path}/batch_group={batch_id // GROUP}/batch_id={batch_id}"


def number_of(folder: str) -> int:
    """``name=17`` -> 17."""
    return int(folder.rpartition("=")[2])

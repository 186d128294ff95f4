"""Folders on the file system that Spark writes to, local or remote."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    located = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), located


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the folders directly in ``path``, sorted; none where it does not exist."""
    system, located = _located(spark, path)
    if not system.exists(located):
        return []
    return sorted(found.getPath().toString() for found in system.listStatus(located) if found.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what it holds; nothing happens where it does not exist."""
    system, located = _located(spark, path)
    system.delete(located, True)

"""Batch writers.  A target is a catalog table, or a parquet path when it holds a slash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_CLUSTER_COLUMNS = 4


def _save(writer: DataFrameWriter, target: str) -> None:
    if "/" in target:
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)


def _require(df: DataFrame, columns: Sequence[str]) -> None:
    for name in columns:
        if name not in df.columns:
            raise ValueError(f"Column {name!r} not found in the frame to write")


def append(df: DataFrame, target: str) -> None:
    _save(df.write.mode("append"), target)


def overwrite(df: DataFrame, target: str) -> None:
    _save(df.write.mode("overwrite"), target)


def append_partitioned(df: DataFrame, target: str, columns: Sequence[str]) -> None:
    """Append into directories by column value.

    The rebalance hint gathers a value's rows into few files, and lets AQE split a
    value that holds too many of them.
    """
    _require(df, columns)
    _save(df.hint("rebalance", *[F.col(name) for name in columns]).write.mode("append").partitionBy(*columns), target)


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows range-ordered by up to four columns, so file statistics can skip.

    The task id closes the range key: it spreads a value that is too frequent for
    one task, and a retried task gives the same id.
    """
    if not 1 <= len(columns) <= MAX_CLUSTER_COLUMNS:
        raise ValueError(f"Between 1 and {MAX_CLUSTER_COLUMNS} clustering columns are needed")
    _require(df, columns)
    placed = df.withColumn("__task", F.spark_partition_id())
    return placed.repartitionByRange(*columns, "__task").sortWithinPartitions(*columns).drop("__task")


def append_clustered(df: DataFrame, target: str, columns: Sequence[str]) -> None:
    _save(clustered(df, columns).write.mode("append"), target)


def write(df: DataFrame, target: str, columns: Sequence[str] | None = None, layout: str | None = None) -> None:
    """Append with the declared layout: none, ``partition`` or ``cluster``."""
    if not columns:
        append(df, target)
    elif layout == "partition":
        append_partitioned(df, target, columns)
    elif layout == "cluster":
        append_clustered(df, target, columns)
    else:
        raise ValueError(f"Columns {list(columns)} need a layout of 'partition' or 'cluster', not {layout!r}")


def create_empty(spark: SparkSession, target: str, schema: T.StructType) -> None:
    """Create the target without rows, unless it is there already."""
    writer = spark.createDataFrame([], schema).write
    if "/" in target:
        writer.mode("ignore").parquet(target)
    else:
        writer.mode("ignore").format("parquet").saveAsTable(target)

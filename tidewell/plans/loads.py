"""History of loads as an ordinary table: one row per batch with operation, time and greatest watermark.

The rows come from the change log itself, or are appended by each load; the newest loads
of an operation give the scope of an incremental check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def load_history(log: DataFrame, batch: str, loaded_at: Column | str, watermark: Column | str,
                 operation: Column | str) -> DataFrame:
    """``batch_id, operation, loaded_at, watermark, rows`` per batch of a log, by one aggregation."""
    return log.groupBy(F.col(batch).alias("batch_id")).agg(
        F.min(operation).alias("operation"), F.max(loaded_at).alias("loaded_at"), F.max(watermark).alias("watermark"),
        F.count(F.lit(1)).alias("rows"))


def record_load(load: DataFrame, path: str) -> None:
    """Append history rows to the table at ``path``, which is created if absent."""
    load.write.mode("append").parquet(path)


def newest_loads(history: DataFrame, operation: str | None = None, count: int = 2) -> DataFrame:
    """The newest loads, of one operation if named, with ``place`` 1 for the newest."""
    rows = history if operation is None else history.where(F.col("operation") == operation)
    newest = rows.orderBy(F.desc("loaded_at"), F.desc("batch_id")).limit(count)
    return newest.withColumn("place", F.row_number().over(Window.orderBy(F.desc("loaded_at"), F.desc("batch_id"))))


def previous_load(history: DataFrame, operation: str = "MERGE") -> DataFrame:
    """The second newest load of an operation: no row if there are fewer than two.

    Its ``watermark`` is the greatest of all loads up to that one, of any operation: what the table held as of then.
    A late load, whose own watermark lies below an earlier one, so does not move the scope back.
    """
    place = F.struct("loaded_at", "batch_id")
    found = newest_loads(history, operation).where("place = 2").drop("place")
    known = history.where(place <= found.select(place).scalar())
    return found.withColumn("watermark", known.agg(F.max("watermark")).scalar()).select(*history.columns)

"""Union, difference and deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEFT_ROWS = "left_rows"
RIGHT_ROWS = "right_rows"


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows, columns matched by name.  Empty inputs simply add nothing."""
    if not frames:
        raise ValueError("union_by_name needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b), frames)


def dedup(df: DataFrame, key: Sequence[str] | None = None, exclude: Sequence[str] | None = None,
          order: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per key.

    The key is ``key`` minus ``exclude``, or all columns minus ``exclude``; blank
    names are ignored.  With ``order`` the first row of each key survives, else
    any.  Only candidates for the first row leave the map side.
    """
    named = [name for name in (key or []) if name.strip()]
    barred = set(exclude or [])
    columns = [name for name in (named or df.columns) if name not in barred]
    if order is None:
        return df.dropDuplicates(columns)
    window = Window.partitionBy(*columns).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(window)).where("__n = 1").drop("__n")


def dedup_stream(df: DataFrame, key: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Streaming dedup whose state is bounded by an event-time watermark."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))


def side_counts(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per distinct row, how often it occurs on each side.

    One pass over both inputs, combined map-side; both directions of a set
    difference are filters on it.  Nulls compare equal.
    """
    tagged = left.select(*columns, F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionByName(
        right.select(*columns, F.lit(0).alias("__l"), F.lit(1).alias("__r")))
    return tagged.groupBy(*columns).agg(F.sum("__l").alias(LEFT_ROWS), F.sum("__r").alias(RIGHT_ROWS))


def difference(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None,
               every_copy: bool = False) -> DataFrame:
    """Both set differences at once, as distinct rows with a ``side`` column.

    ``side`` is ``left`` for rows only on the left, else ``right``.  With
    ``every_copy`` a row also differs when its number of copies does, and
    ``copies`` holds the surplus; copies are counted, not repeated.
    """
    columns = list(columns or left.columns)
    counts = side_counts(left, right, columns)
    if every_copy:
        surplus = F.col(LEFT_ROWS) - F.col(RIGHT_ROWS)
        return counts.where(surplus != 0).select(
            F.when(surplus > 0, "left").otherwise("right").alias("side"), *columns, F.abs(surplus).alias("copies"))
    one_sided = counts.where((F.col(LEFT_ROWS) == 0) | (F.col(RIGHT_ROWS) == 0))
    return one_sided.select(F.when(F.col(RIGHT_ROWS) == 0, "left").otherwise("right").alias("side"), *columns)

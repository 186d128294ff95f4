"""Tools that keep one hot key from becoming one hot task.

Two patterns cover the library:

* many rows joined to one row per key (``apart``): the grouped side is combined
  map-side, and the join is laid out so that AQE can split a skewed partition of
  the many side;
* the next or previous row within a key (``next_in_order``, ``previous_in_order``):
  a hot key is cut into consecutive pieces that are ordered in separate tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

_CHECKSUM = "__apart"
_PIECE = "__piece"
_PIECES = "__pieces"
_RANK = "__rank"
_CUTS = "__cuts"
_HEADS = "__heads"
_CHUNK = "__chunk"
_BORDER = "__border"
_ROWS = "__rows"

#: A table is thought of as this many equal pieces; a key larger than one piece is
#: hot and is divided.  There are at most this many hot keys and twice as many cut
#: points, whatever the size of the table, so their list may be broadcast.
PIECE_BUDGET = 16_384
#: A piece has at least this many rows: one task orders them without trouble.
PIECE_ROWS = 500_000
#: Sampled ranks per cut point; more make the pieces more even.
OVERSAMPLE = 8


def apart(df: DataFrame, keys: Sequence[str]) -> GroupedData:
    """Group by ``keys`` for a result that will be joined back on ``keys``.

    The groups are those of ``groupBy(*keys)``.  Grouping on a checksum of the
    keys as well means the result is not already partitioned on the join keys,
    so the join adds its own exchange on both sides.  AQE splits skewed
    partitions only between such exchanges; joined directly, the aggregate would
    pin every row of a hot key to one task.  The extra exchange moves one narrow
    row per key.  Drop the helper with :func:`drop_apart`.
    """
    return df.groupBy(*keys, F.xxhash64(*keys).alias(_CHECKSUM))


def drop_apart(df: DataFrame) -> DataFrame:
    return df.drop(_CHECKSUM)


def distinct_apart(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, for the right side of a semi or anti join."""
    return drop_apart(df.select(*keys, F.xxhash64(*keys).alias(_CHECKSUM)).distinct())


def hot_keys(df: DataFrame, keys: Sequence[str], budget: int = PIECE_BUDGET,
             min_rows: int = PIECE_ROWS) -> DataFrame:
    """Keys with more rows than one piece, and the number of pieces each is worth.

    At most ``budget`` rows whatever the size of ``df``.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS))
    size = F.greatest(F.coalesce(F.sum(_ROWS), F.lit(0)) / F.lit(budget), F.lit(float(min_rows)))
    pieces = F.col(_ROWS) / counts.agg(size).scalar()
    return counts.where(pieces > 1).select(*keys, F.ceil(pieces).cast("int").alias(_PIECES))


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str = "") -> Column:
    return reduce(and_, [left[key].eqNullSafe(right[prefix + key]) for key in keys])


def _cut_points(population: DataFrame, keys: Sequence[str], budget: int, min_rows: int) -> DataFrame:
    """Per hot key a sorted array of rank values taken from its own rows.

    The row with the least hash in each of a fixed number of slots is sampled, the
    same one on every attempt of a task; every few of the sorted samples one is a
    cut.  ``__heads`` holds every ``__chunk``-th cut, for a search in two steps.
    """
    hot = hot_keys(population, keys, budget, min_rows).withColumnsRenamed({key: f"__of_{key}" for key in keys})
    hot_rows = population.join(F.broadcast(hot), _null_safe(population, hot, keys, "__of_"))
    sampled = (
        hot_rows.withColumn("__hash", F.xxhash64(_RANK))
        .groupBy(*keys, F.pmod("__hash", F.col(_PIECES) * OVERSAMPLE).alias("__slot"))
        .agg(F.min_by(_RANK, "__hash").alias("__sample"))
    )
    sorted_samples = sampled.groupBy(*keys).agg(F.array_sort(F.collect_set("__sample")).alias("__samples"))
    cuts = sorted_samples.select(
        *[F.col(key).alias(f"__of_{key}") for key in keys],
        F.filter("__samples", lambda sample, i: i % OVERSAMPLE == OVERSAMPLE - 1).alias(_CUTS))
    cuts = cuts.withColumn(_CHUNK, F.greatest(F.ceil(F.sqrt(F.size(_CUTS))), F.lit(1)).cast("int"))
    return cuts.withColumn(_HEADS, F.filter(_CUTS, lambda cut, i: i % F.col(_CHUNK) == 0))


def _with_pieces(df: DataFrame, population: DataFrame, keys: Sequence[str], forward: bool,
                 budget: int, min_rows: int) -> DataFrame:
    """Add each row's piece number and the value just across the piece's border.

    Looking forward a piece starts at its cut, looking back it ends there; either
    way the row across the border is the next cut itself, which carries the value.
    Keys that are not hot have no cuts and one piece.
    """
    cuts = _cut_points(population, keys, budget, min_rows)
    joined = df.join(F.broadcast(cuts), _null_safe(df, cuts, keys, "__of_"), "left")

    def passed(array: Column) -> Column:
        return F.size(F.filter(array, lambda cut: cut <= F.col(_RANK) if forward else cut < F.col(_RANK)))

    # The chunk that holds the border first, then the place in it.
    chunk = passed(F.col(_HEADS)) - 1
    inside = passed(F.slice(_CUTS, F.col("__at_chunk") * F.col(_CHUNK) + 1, F.col(_CHUNK)))
    piece = F.when(F.col("__at_chunk") >= 0, F.col("__at_chunk") * F.col(_CHUNK) + inside).otherwise(0)
    placed = joined.withColumn("__at_chunk", chunk).withColumn(_PIECE, piece)
    # Only the one value travels with the row, not the array of cuts.
    border = F.get(_CUTS, F.col(_PIECE) if forward else F.col(_PIECE) - 1)
    return placed.withColumn(_BORDER, border["__value"]).drop(
        _CUTS, _HEADS, _CHUNK, "__at_chunk", *[f"__of_{key}" for key in keys])


def _ranked(df: DataFrame, order: Sequence[str], value: str) -> DataFrame:
    # The value closes the rank, so rows that tie on it share the value too.
    return df.withColumn(_RANK, F.struct(*[F.col(name) for name in order], F.col(value).alias("__value")))


def _neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, forward: bool,
               population: DataFrame | None, budget: int, min_rows: int) -> DataFrame:
    ranked = _ranked(df, order, value)
    ranks = _ranked(df if population is None else population, order, value).select(*keys, _RANK)
    split = _with_pieces(ranked, ranks, keys, forward, budget, min_rows)
    window = Window.partitionBy(*keys, _PIECE).orderBy(_RANK)
    boxed = F.struct(F.col(value).alias("__value"))
    inside = F.lead(boxed).over(window) if forward else F.lag(boxed).over(window)
    return (
        split.withColumn("__inside", inside)
        .withColumn(out, F.when(F.col("__inside").isNotNull(), F.col("__inside")["__value"]).otherwise(F.col(_BORDER)))
        .drop(_RANK, _BORDER, _PIECE, "__inside")
    )


def next_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
                  population: DataFrame | None = None, budget: int = PIECE_BUDGET,
                  min_rows: int = PIECE_ROWS) -> DataFrame:
    """``LEAD(value) OVER (PARTITION BY keys ORDER BY order, value)`` as column ``out``.

    ``population`` is a frame with the same keys, order and values that is cheaper
    to scan than ``df``, such as its input before duplicates were merged.
    """
    return _neighbour(df, keys, order, value, out, True, population, budget, min_rows)


def previous_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
                      population: DataFrame | None = None, budget: int = PIECE_BUDGET,
                      min_rows: int = PIECE_ROWS) -> DataFrame:
    """``LAG(value) OVER (PARTITION BY keys ORDER BY order, value)`` as column ``out``."""
    return _neighbour(df, keys, order, value, out, False, population, budget, min_rows)

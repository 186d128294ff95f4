"""Slowly changing dimensions from a change log.

Changes are ordered by the sequence columns, never by arrival.  Two changes of a
key with the same sequence are one position in time: the one with the greater
content hash counts, so every run picks the same one.

The ``latest_state`` and ``version_state`` forms keep deletes as tombstones.  They
may be applied to their own output plus new changes, which is how the streaming
merge stays independent of arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.cdc import DELETE
from tidewell.operators.skew import PIECE_ROWS, next_in_order

START, END = "start_at", "end_at"


def _tie(df: DataFrame) -> Column:
    """Hash of a row's content; null flags tell rows apart that differ in where a null is."""
    parts = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        flat = isinstance(field.dataType, T.AtomicType)
        parts += [column if flat else column.cast("string"), column.isNull()]
    return F.xxhash64(*parts)


def _first_per(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # Filtering on row_number keeps one candidate per group in each map task.
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(window)).where("__n = 1").drop("__n")


def latest_state(log: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """The last change of every key, deletes included."""
    ranked = log.withColumn("__tie", _tie(log))
    order = [F.desc(name) for name in sequence] + [F.desc("__tie")]
    return _first_per(ranked, keys, order).drop("__tie")


def position_state(log: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """One change of every key and position in time, deletes included."""
    ranked = log.withColumn("__tie", _tie(log))
    return _first_per(ranked, [*keys, *sequence], [F.desc("__tie")]).drop("__tie")


def version_state(log: DataFrame, keys: Sequence[str], sequence: Sequence[str], end: str = END,
                  piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Every change of every key with the sequence of the next one, deletes included.

    With several sequence columns the end is a struct of them.
    """
    bare = log.drop(end)
    single = position_state(bare, keys, sequence)
    position = F.col(sequence[0]) if len(sequence) == 1 else F.struct(*sequence)
    # The log holds the same positions per key, and reading it again needs no shuffle.
    positions = bare.select(*keys, position.alias("__at"))
    placed = single.withColumn("__at", position)
    return next_in_order(placed, keys, [], "__at", end, population=positions, min_rows=piece_rows).drop("__at")


def sequence_ties(log: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """One row: ``tied_positions, surplus_changes``, where a key repeats a sequence value."""
    repeated = log.groupBy(*keys, *sequence).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("tied_positions"),
                        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("surplus_changes"))


def visible_latest(state: DataFrame, op: str | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Current rows of a latest state: no tombstones, no excluded columns."""
    if op is not None and op in state.columns:
        state = state.where(F.col(op) != DELETE)
    return state.drop(*exclude)


def visible_versions(state: DataFrame, sequence: Sequence[str], op: str | None = None,
                     exclude: Sequence[str] = (), start: str = START) -> DataFrame:
    """Versions of a version state, with their start; a delete only ends one."""
    if op is not None and op in state.columns:
        state = state.where(F.col(op) != DELETE)
    position = F.col(sequence[0]) if len(sequence) == 1 else F.struct(*sequence)
    return state.withColumn(start, position).drop(*exclude)


def scd1(log: DataFrame, keys: Sequence[str], sequence: Sequence[str], op: str | None = None,
         exclude: Sequence[str] = ()) -> DataFrame:
    """Latest row per key; keys whose last change is a delete are absent.

    Without an operation column in the log nothing is ever deleted.
    """
    return visible_latest(latest_state(log, keys, sequence), op, exclude)


def scd2(log: DataFrame, keys: Sequence[str], sequence: Sequence[str], op: str | None = None,
         exclude: Sequence[str] = (), start: str = START, end: str = END, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per version with ``[start, end)``; the current one has no end."""
    return visible_versions(version_state(log, keys, sequence, end, piece_rows), sequence, op, exclude, start)

"""Column mapping and naming."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.types import spark_type


@dataclass(frozen=True)
class ColumnSpec:
    """One target column: where it comes from, its type, or the SQL deriving it."""

    name: str
    source: str | None = None
    type: str | None = None
    derived: str | None = None

    @property
    def is_derived(self) -> bool:
        return bool(self.derived and self.derived.strip())


def _derivation(spec: ColumnSpec, cast: bool) -> Column:
    text = spec.derived.strip()
    if re.match(r"(?:F|functions)\.\w|lit\(", text):
        raise ValueError(f"Column {spec.name!r}: the expression must be SQL text, not Python: {text}")
    column = F.expr(text)
    return column.cast(spark_type(spec.type)) if cast and spec.type else column


def transform_map(df: DataFrame, specs: Sequence[ColumnSpec], on_error: str = "fail",
                  cast_derived: bool = False) -> DataFrame:
    """Apply the specs in order and keep exactly their columns, in their order.

    A derived column is its SQL expression, uncast unless ``cast_derived``; any
    other is its source column under the new name, cast to its type.  Expressions
    see the results of earlier specs.  ``on_error="null"`` turns a failing cast
    into null.  Specs between two expressions share one projection.
    """
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    types = {field.name: field.dataType for field in df.schema.fields}
    source_at = {name: name for name in df.columns}  # where each source column is now
    results: dict[str, Column] = {}
    settled = True

    def settle() -> None:
        nonlocal df, results, settled
        columns = [column.alias(name) for name, column in results.items()]
        for name, at in source_at.items():
            place = f"__source_{name}" if at in results else at
            columns.append(F.col(f"`{at}`").alias(place))
            source_at[name] = place
        df = df.select(*columns)
        results = {name: F.col(f"`{name}`") for name in results}
        settled = True

    for spec in specs:
        if spec.is_derived:
            if not settled:
                settle()
            column = _derivation(spec, cast_derived)
        else:
            source = spec.source if spec.source in source_at else spec.name
            if source in source_at and (source == spec.source or source not in results):
                column, known = F.col(f"`{source_at[source]}`"), types[source]
            elif spec.name in results:
                column, known = results[spec.name], None
            else:
                raise ValueError(f"Column {spec.name!r}: no source column {spec.source or spec.name!r}")
            target = spark_type(spec.type) if spec.type else None
            if target is not None and known != target:
                column = column.cast(target) if on_error == "fail" else column.try_cast(target)
        results[spec.name] = column
        settled = False
    return df.select(*[results[spec.name].alias(spec.name) for spec in specs])


def derive_columns(df: DataFrame, specs: Sequence[ColumnSpec], cast_derived: bool = False) -> DataFrame:
    """Only the derived expressions; every other column is left alone."""
    for spec in specs:
        if spec.is_derived:
            df = df.withColumn(spec.name, _derivation(spec, cast_derived))
    return df


def select_columns(df: DataFrame, keep: Mapping[str, bool]) -> DataFrame:
    """Columns named in ``keep`` and not flagged to drop (``False``), in source order."""
    return df.select(*[F.col(f"`{name}`") for name in df.columns if keep.get(name, False)])


def _checked(names: list[str]) -> list[str]:
    seen: set[str] = set()
    for name in names:
        if not name:
            raise ValueError("A column name is empty after cleaning")
        if name.lower() in seen:
            raise ValueError(f"Two columns share the cleaned name {name!r}")
        seen.add(name.lower())
    return names


def clean_names(df: DataFrame, style: str = "compact") -> DataFrame:
    """Remove characters that tables reject from column names.

    ``compact`` deletes brackets, bars, commas and blanks; ``snake`` turns blank
    runs into ``_`` and deletes everything but letters, digits and ``_``.
    """
    if style == "compact":
        names = [re.sub(r"[()|,\s]", "", name) for name in df.columns]
    elif style == "snake":
        names = [re.sub(r"\W", "", re.sub(r"\s+", "_", name), flags=re.ASCII) for name in df.columns]
    else:
        raise ValueError(f"Unknown naming style: {style}")
    return df.toDF(*_checked(names))


def rename_columns(df: DataFrame, mapping: Mapping[str, str] | None = None,
                   configured: Mapping[str, str] | None = None) -> DataFrame:
    """Rename by mapping; an explicit one wins over the configured one."""
    chosen = mapping if mapping is not None else configured
    return df.withColumnsRenamed(dict(chosen)) if chosen else df


def add_constants(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Literal columns; text is text, never evaluated as an expression."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()}) if values else df


def lineage_columns(df: DataFrame, batch_id: str, loaded_at: datetime | Column | None = None,
                    batch_name: str = "batch_id", time_name: str = "loaded_at") -> DataFrame:
    """Append the batch id and the load time (now, unless given)."""
    if loaded_at is None:
        loaded_at = F.current_timestamp()
    elif not isinstance(loaded_at, Column):
        loaded_at = F.lit(loaded_at)
    return df.withColumns({batch_name: F.lit(batch_id), time_name: loaded_at})


def as_text(df: DataFrame) -> DataFrame:
    """Every column as string, names unchanged."""
    return df.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in df.columns])


def drop_types(df: DataFrame, *types: type[T.DataType]) -> DataFrame:
    """Drop the columns of the given data types."""
    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, types)])

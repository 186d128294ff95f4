"""Canonical text of a row and the hashes built from it.

The default form is the one existing change logs were hashed with, so new loads
stay comparable with them.  It has known collisions (``NULL`` text versus a
null, a ``|`` inside a value, changes below one second); ``strict=True`` removes
them for tables that need not match older hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_HASH = "row_key_hash"
ROW_HASH = "row_hash"

# The text of a null and the separator between columns.
NULL_TEXT = "NULL"
SEPARATOR = "|"


def _plain_text(name: str, data_type: T.DataType, strict: bool) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        instant = column.cast("timestamp")
        return (F.unix_micros(instant) if strict else instant.cast("long")).cast("string")
    if isinstance(data_type, T.BooleanType):
        return column.cast("int").cast("string")
    if isinstance(data_type, T.StringType):
        return column
    if isinstance(data_type, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(column)))
    if isinstance(data_type, (T.ArrayType, T.StructType)):
        return F.to_json(column)
    if isinstance(data_type, T.BinaryType) and strict:
        return F.hex(column)
    return column.cast("string")


def canonical_text(field: T.StructField, strict: bool = False) -> Column:
    """Text of one column as it enters a hash; never null."""
    text = _plain_text(field.name, field.dataType, strict)
    if strict:
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.coalesce(text, F.lit(NULL_TEXT))


def canonical_strings(df: DataFrame, columns: Sequence[str] | None = None, strict: bool = False) -> DataFrame:
    """``df`` with the chosen columns (default all) in canonical text form."""
    chosen = set(df.columns if columns is None else columns)
    return df.select(*[
        canonical_text(field, strict).alias(field.name) if field.name in chosen else F.col(f"`{field.name}`")
        for field in df.schema.fields
    ])


def hash_of(df: DataFrame, columns: Sequence[str], strict: bool = False) -> Column:
    """md5 over the columns' canonical text, always in ``df``'s column order."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"Columns not found: {missing}")
    wanted = set(columns)
    texts = [canonical_text(field, strict) for field in df.schema.fields if field.name in wanted]
    return F.md5(F.concat_ws(SEPARATOR, *texts))


def add_row_hashes(df: DataFrame, keys: Sequence[str] = (), key_name: str = KEY_HASH,
                   row_name: str = ROW_HASH, strict: bool = False) -> DataFrame:
    """Append the key hash (all columns when no key is declared) and the row hash.

    The row hash covers every column, keys included.
    """
    row = hash_of(df, df.columns, strict)
    key = hash_of(df, list(keys), strict) if keys else row
    return df.select("*", key.alias(key_name), row.alias(row_name))

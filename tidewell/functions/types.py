"""Declared type names to Spark types.

Source definitions name types in several database dialects.  Names are mapped
to Spark DDL words and Spark parses the DDL, so nested types come for free.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.errors import ParseException
from pyspark.sql import types as T

# Accepted type names and the Spark DDL word each one means.
TYPE_WORDS = {
    "string": "string", "varchar": "string", "char": "string", "text": "string", "nvarchar": "string",
    "int": "int", "integer": "int",
    "bigint": "bigint", "long": "bigint",
    "smallint": "smallint", "short": "smallint",
    "byte": "tinyint", "tinyint": "tinyint",
    "float": "float", "float32": "float",
    "double": "double", "float64": "double",
    "decimal": "decimal",
    "boolean": "boolean", "bool": "boolean",
    "binary": "binary", "blob": "binary",
    "date": "date",
    "timestamp": "timestamp", "timestamp_ltz": "timestamp", "timestamp_ntz": "timestamp_ntz",
    "null": "void", "void": "void",
    "array": "array", "map": "map", "struct": "struct",
}

_INTERVAL = re.compile(r"(yearmonth|daytime)interval\s*\(\s*(\w+)\s*,\s*(\w+)\s*\)", re.IGNORECASE)
_INTERVAL_UNITS = {"yearmonth": ["year", "month"], "daytime": ["day", "hour", "minute", "second"]}
# A type word with optional arguments; a word before a colon is a field name.
_TYPE_WORD = re.compile(r"(?<![\w`])(`[^`]*`\s*:|[A-Za-z_]\w*\s*:|[A-Za-z_]\w*)(\s*\(\s*\d+\s*(?:,\s*\d+\s*)?\))?")


def _interval_ddl(match: re.Match) -> str:
    units = _INTERVAL_UNITS[match.group(1).lower()]

    def unit(token: str) -> str:
        word = units[int(token)] if token.isdigit() and int(token) < len(units) else token.lower()
        if word not in units:
            raise ValueError(f"Unknown interval field: {token}")
        return word

    first, last = unit(match.group(2)), unit(match.group(3))
    return f"interval {first}" if first == last else f"interval {first} to {last}"


def canonical_ddl(type_name: str) -> str:
    """Spark DDL for a declared type name, e.g. ``nvarchar(40)`` -> ``string``."""

    def word(match: re.Match) -> str:
        token, arguments = match.group(1), match.group(2) or ""
        if token.rstrip().endswith(":"):
            return token
        ddl = TYPE_WORDS.get(token.lower())
        if ddl is None:
            raise ValueError(f"Unsupported type: {type_name}")
        if ddl == "decimal":
            return ddl + (arguments or "(10,0)")
        return ddl

    text = type_name.strip()
    if _INTERVAL.fullmatch(text):
        return _INTERVAL.sub(_interval_ddl, text)
    if not text:
        raise ValueError("Empty type name")
    return _TYPE_WORD.sub(word, text)


def spark_type(type_name: str) -> T.DataType:
    """The Spark ``DataType`` of a declared type name."""
    try:
        return T.DataType.fromDDL(canonical_ddl(type_name))
    except ParseException as error:
        raise ValueError(f"Unsupported type: {type_name}") from error


def declared_schema(columns: Iterable[tuple]) -> T.StructType:
    """Schema from ``(name, type name[, nullable])`` declarations."""
    fields = []
    for name, type_name, *rest in columns:
        fields.append(T.StructField(name, spark_type(type_name), rest[0] if rest else True))
    return T.StructType(fields)

from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.hashing import add_row_hashes, canonical_strings
from tidewell.functions.temporal import clock_text, elapsed_text
from tidewell.functions.types import canonical_ddl, declared_schema, spark_type


@pytest.mark.parametrize(("name", "expected"), [
    ("nvarchar(40)", T.StringType()), ("TEXT", T.StringType()), ("char(1)", T.StringType()),
    ("integer", T.IntegerType()), ("long", T.LongType()), ("short", T.ShortType()), ("byte", T.ByteType()),
    ("float32", T.FloatType()), ("float64", T.DoubleType()),
    ("decimal(38, 0)", T.DecimalType(38, 0)), ("decimal", T.DecimalType(10, 0)),
    ("bool", T.BooleanType()), ("blob", T.BinaryType()), ("timestamp_ltz", T.TimestampType()),
    ("timestamp_ntz", T.TimestampNTZType()), ("void", T.NullType()),
    ("yearmonthinterval(year, month)", T.YearMonthIntervalType(0, 1)),
    ("yearmonthinterval(0, 1)", T.YearMonthIntervalType(0, 1)),
    ("daytimeinterval(day, hour)", T.DayTimeIntervalType(0, 1)),
    ("array<array<nvarchar(5)>>", T.ArrayType(T.ArrayType(T.StringType()))),
    ("map<string, decimal(4,2)>", T.MapType(T.StringType(), T.DecimalType(4, 2))),
    ("struct<text: decimal(1,1), b: array<long>>", T.StructType([
        T.StructField("text", T.DecimalType(1, 1)), T.StructField("b", T.ArrayType(T.LongType()))])),
])
def test_type_names(spark, name, expected):
    assert spark_type(name) == expected


@pytest.mark.parametrize("name", ["money", "", "array<money>", "yearmonthinterval(day, month)"])
def test_unknown_types(spark, name):
    with pytest.raises(ValueError):
        spark_type(name)


def test_declared_schema_keeps_nullability(spark):
    schema = declared_schema([("a", "int", False), ("b", "text")])
    assert [(f.name, f.nullable) for f in schema] == [("a", False), ("b", True)]
    assert canonical_ddl("varchar(3)") == "string"


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_hash_text(spark):
    df = spark.createDataFrame(
        [(7, True, datetime(2024, 1, 1, 0, 0, 1, 900000), None, "x")], "k int, b boolean, t timestamp, n string, s string")
    row = add_row_hashes(df, ["s", "k"]).first()
    assert row["row_key_hash"] == md5("7|x")  # frame order, whatever the key list's order
    assert row["row_hash"] == md5("7|1|1704067201|NULL|x")
    keyless = add_row_hashes(df).first()
    assert keyless["row_key_hash"] == keyless["row_hash"] == row["row_hash"]


def test_time_types_share_a_text(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:01' a, timestamp_ntz'2024-01-01 00:00:01' b")
    row = canonical_strings(df).first()
    assert row["a"] == row["b"] == "1704067201"


def test_default_collisions_and_strict(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "c"), ("NULL", "c")], "x string, y string")
    assert add_row_hashes(df).select("row_hash").distinct().count() == 2
    assert add_row_hashes(df, strict=True).select("row_hash").distinct().count() == 4


def test_subsecond_change_needs_strict(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:01.1' t UNION ALL SELECT timestamp'2024-01-01 00:00:01.2'")
    assert add_row_hashes(df).select("row_hash").distinct().count() == 1
    assert add_row_hashes(df, strict=True).select("row_hash").distinct().count() == 2


def test_map_text_ignores_entry_order(spark):
    df = spark.sql("SELECT map('a', 1, 'b', 2) m UNION ALL SELECT map('b', 2, 'a', 1)")
    assert add_row_hashes(df).select("row_hash").distinct().count() == 1


def test_missing_key_column(spark):
    with pytest.raises(ValueError, match="nope"):
        add_row_hashes(spark.range(1), ["nope"])


def test_clock_and_elapsed_text(spark):
    df = spark.createDataFrame([(5_000,), (65_000,), (3_605_000,), (90_000_000,)], "ms bigint")
    assert [r[0] for r in df.select(clock_text(F.col("ms"))).collect()] == ["00:05", "01:05", "1:00:05", "25:00:00"]
    now = F.lit("2024-01-01 02:30:00").cast("timestamp")
    at = spark.createDataFrame([("2024-01-01 02:00:30",), ("2024-01-01 00:30:00",)], "t string")
    texts = at.select(elapsed_text(F.col("t").cast("timestamp"), now)).collect()
    assert [r[0] for r in texts] == ["29 minutes ago", "2 hours ago"]

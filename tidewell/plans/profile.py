"""Table profiles: watermark columns, column statistics and the combined report."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.plans.keys import recommend_key
from tidewell.plans.parallel import CONCURRENCY, map_tables

# Stems of the names a watermark column may have.
WATERMARK_STEMS = (
    "creat", "update", "modif", "add", "last", "effective", "start", "review", "audit", "demo", "enter",
    "insert", "end", "change", "load", "entry", "posted", "recorded",
)
# Result for no column, and the messages.
NONE_FOUND = "NA"
NO_NAME = "No column found which is matching with priority column list. Hence manual intervention is needed"
NO_VALID = "No valid timestamp columns found after evaluation."
SAME_MEAN = "Columns {} have the same highest mean timestamp: {}. Manual inspection required."

PROFILE_SCHEMA = (
    "catalog string, schema string, table_name string, primary_key string, unique_columns string, "
    "key_message string, watermark_column string, watermark_message string, record_count bigint"
)


def watermark_candidates(df: DataFrame) -> list[str]:
    """Timestamp columns whose name contains one of the stems."""
    stems = re.compile("|".join(WATERMARK_STEMS), re.IGNORECASE)
    return [field.name for field in df.schema.fields
            if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)) and stems.search(field.name)]


def watermark_measures(df: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """Per candidate: nulls, greatest value, mean and whether it qualifies; one pass.

    A column qualifies without nulls and with its greatest value before ``now``.
    """
    names = watermark_candidates(df)
    present = F.current_timestamp() if now is None else now if isinstance(now, Column) else F.lit(now)
    measures = []
    for i, name in enumerate(names):
        at = F.col(f"`{name}`").cast("timestamp")
        # Microseconds overflow a bigint sum long before a table is large.
        micros = F.unix_micros(at).cast("decimal(20,0)")
        measures += [F.count_if(at.isNull()).alias(f"n{i}"), F.max(at).alias(f"m{i}"), F.sum(micros).alias(f"s{i}"),
                     F.count(at).alias(f"c{i}")]
    if not names:
        return df.sparkSession.createDataFrame(
            [], "column_name string, nulls bigint, latest timestamp_ntz, mean_epoch double, valid boolean")
    entries = F.array(*[
        F.struct(
            F.lit(name).alias("column_name"), F.col(f"n{i}").alias("nulls"),
            F.col(f"m{i}").cast("timestamp_ntz").alias("latest"),
            (F.col(f"s{i}").cast("double") / F.col(f"c{i}") / 1e6).alias("mean_epoch"),
            ((F.col(f"n{i}") == 0) & F.coalesce(F.col(f"m{i}") < present.cast("timestamp"), F.lit(False)))
            .alias("valid"),
        )
        for i, name in enumerate(names)
    ])
    return df.agg(*measures).select(F.inline(entries))


def find_watermark_column(df: DataFrame, now: datetime | None = None) -> tuple[str, str]:
    """``(column, message)``: the qualifying candidate with the latest mean."""
    rows = watermark_measures(df, now).collect()
    if not rows:
        return NONE_FOUND, NO_NAME
    valid = [row for row in rows if row["valid"]]
    if not valid:
        return NONE_FOUND, NO_VALID
    best = max(row["mean_epoch"] for row in valid)
    tied = [row["column_name"] for row in valid if row["mean_epoch"] == best]
    if len(tied) == 1:
        return tied[0], ""
    mean = datetime.fromtimestamp(best, timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    return NONE_FOUND, SAME_MEAN.format(", ".join(tied), mean)


def stats_columns(schema: T.StructType, required: Sequence[str] = (), exclude: Sequence[str] = (),
                  leading_columns: int | None = None) -> list[str]:
    """Columns worth min/max statistics, plus the required ones.

    Boolean, binary and map columns are left out.  ``leading_columns`` takes only so many
    columns after exclusions, as table layouts with a limit on indexed columns do.
    """
    leading = [field for field in schema.fields if field.name not in exclude][:leading_columns]
    chosen = [f.name for f in leading if not isinstance(f.dataType, (T.BooleanType, T.BinaryType, T.MapType))]
    return chosen + [name for name in required if name not in chosen]


def column_stats(df: DataFrame, by: Column | str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Least and greatest value (as text), nulls and rows per column and group.

    The default group is the data file, which shows how well a layout skips.
    """
    group = F.col("_metadata.file_path") if by is None else F.col(by) if isinstance(by, str) else by
    names = list(columns or stats_columns(df.schema))
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(names):
        measures += [F.min(f"`{name}`").alias(f"a{i}"), F.max(f"`{name}`").alias(f"b{i}"),
                     F.count_if(F.col(f"`{name}`").isNull()).alias(f"n{i}")]
    entries = F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(f"a{i}").cast("string").alias("min_value"),
                 F.col(f"b{i}").cast("string").alias("max_value"), F.col(f"n{i}").alias("null_count"))
        for i, name in enumerate(names)
    ])
    return df.groupBy(group.alias("part")).agg(*measures).select("part", "rows", F.inline(entries))


def profile_tables(spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]], catalog: str, schema: str,
                   what: str = "keys", declared: DataFrame | None = None, now: datetime | None = None,
                   key_size: int | None = None, concurrency: int = CONCURRENCY) -> DataFrame:
    """One report row per table; empty and unreadable tables give none.

    ``what`` is ``keys`` or ``watermark``.  Declared keys, where known, are used
    as they are and spare the search.
    """
    if what not in ("keys", "watermark"):
        raise ValueError(f"what must be 'keys' or 'watermark', not {what!r}")
    known: dict[str, list[str]] = {}
    if declared is not None:
        asked = declared.where(F.upper("table_name").isin([name.upper() for name in tables]))
        for row in asked.orderBy("table_name", "ordinal_position").collect():
            known.setdefault(row["table_name"], []).append(row["column_name"])

    def report(item: tuple[str, Callable[[], DataFrame]]) -> tuple | None:
        name, read = item
        try:
            df = read()
            count = df.count()
            if count == 0:
                return None
            if what == "watermark":
                column, message = find_watermark_column(df, now)
                return catalog, schema, name, None, None, None, column, message, count
            if name.upper() in known:
                return catalog, schema, name, ",".join(known[name.upper()]), None, None, None, None, count
            found = recommend_key(df, key_size, key_size)
            return (catalog, schema, name, found["primary_key"], found["unique_columns"], found["message"],
                    None, None, count)
        except (PySparkException, OSError):
            return None

    rows = [row for row in map_tables(spark, report, tables.items(), concurrency) if row is not None]
    return spark.createDataFrame(rows, PROFILE_SCHEMA)

"""Layer-to-layer reconciliation of a landing snapshot with a history table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.hashing import KEY_HASH, ROW_HASH
from tidewell.operators.sets import LEFT_ROWS, RIGHT_ROWS, difference, side_counts
from tidewell.operators.skew import apart, drop_apart, next_in_order
from tidewell.operators.transforms import as_text
from tidewell.plans.parallel import CONCURRENCY, map_tables
from tidewell.sinks.writers import append
from tidewell.sources.tables import current_rows

HASHES = (KEY_HASH, ROW_HASH)

RESULT_SCHEMA = (
    "run_id string, source_table string, target_table string, watermark_column string, "
    "source_count bigint, target_count bigint, only_in_source bigint, only_in_target bigint, "
    "status string, strict_status string, created_at timestamp"
)

# Result states.
SUCCESS, FAILED = "SUCCESS", "FAILED"


def layer_rows(df: DataFrame, watermark: str | None = None, after: Any = None, end: str = "end_at") -> DataFrame:
    """Current rows of a layer, all of them or those strictly after a watermark."""
    df = current_rows(df, end)
    if watermark is not None and after is not None:
        df = df.where(F.col(watermark) > F.lit(after).cast(df.schema[watermark].dataType))
    return df


def qc_scope(source: DataFrame, target: DataFrame, watermark: str | None = None, previous: Any = None,
             first_load: bool = False, force_full: bool = False) -> tuple[DataFrame, DataFrame]:
    """The two sides to compare.

    Full when there is no watermark, when forced, on a first load or when the
    previous watermark is null; otherwise the rows after the previous watermark.
    """
    full = watermark is None or force_full or first_load or previous is None
    mark, after = (None, None) if full else (watermark, previous)
    return layer_rows(source, mark, after), layer_rows(target, mark, after)


def count_check(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: ``counts_equal, source_count, target_count``."""
    sides = source.select(F.lit(1).alias("s")).unionByName(target.select(F.lit(0).alias("s")))
    counts = sides.agg(F.count_if(F.col("s") == 1).alias("source_count"),
                       F.count_if(F.col("s") == 0).alias("target_count"))
    return counts.select((F.col("source_count") == F.col("target_count")).alias("counts_equal"),
                         "source_count", "target_count")


def hash_differences(source: DataFrame, target: DataFrame, hashes: Sequence[str] = HASHES) -> DataFrame:
    """Distinct hash pairs on one side only; ``side`` is ``left`` for the source."""
    return difference(source, target, list(hashes))


def compare_layers(source: DataFrame, target: DataFrame, source_side: bool = True,
                   hashes: Sequence[str] = HASHES) -> DataFrame:
    """One row of reconciliation measures from a single pass over both sides.

    ``status`` depends only on target rows that the source lacks; when
    ``source_side`` is off, ``only_in_source`` is null.  ``strict_status`` also
    asks for equal counts and nothing missing in the target.
    """
    counts = side_counts(source, target, list(hashes))
    only_source = F.count_if(F.col(RIGHT_ROWS) == 0)
    measured = counts.agg(
        F.coalesce(F.sum(LEFT_ROWS), F.lit(0)).alias("source_count"),
        F.coalesce(F.sum(RIGHT_ROWS), F.lit(0)).alias("target_count"),
        only_source.alias("missing_target"),
        F.count_if(F.col(LEFT_ROWS) == 0).alias("only_in_target"),
    )
    agreed = F.col("only_in_target") == 0
    strict = agreed & (F.col("missing_target") == 0) & (F.col("source_count") == F.col("target_count"))
    return measured.select(
        "source_count", "target_count",
        (F.col("missing_target") if source_side else F.lit(None).cast("bigint")).alias("only_in_source"),
        "only_in_target",
        F.when(agreed, SUCCESS).otherwise(FAILED).alias("status"),
        F.when(strict, SUCCESS).otherwise(FAILED).alias("strict_status"),
    )


def mismatch_rows(source: DataFrame, target: DataFrame, hashes: Sequence[str] = HASHES) -> DataFrame:
    """Full rows behind the hash differences, with their ``side``; copies included."""
    hashes = list(hashes)
    counts = drop_apart(
        apart(
            source.select(*hashes, F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionByName(
                target.select(*hashes, F.lit(0).alias("__l"), F.lit(1).alias("__r"))),
            hashes,
        ).agg(F.max("__l").alias("__l"), F.max("__r").alias("__r")))
    left = source.join(counts.where("__r = 0").select(*hashes), hashes, "left_semi")
    right = target.join(counts.where("__l = 0").select(*hashes), hashes, "left_semi")
    return left.select(F.lit("left").alias("side"), *source.columns).unionByName(
        right.select(F.lit("right").alias("side"), *source.columns))


def text_differences(left: DataFrame, right: DataFrame, every_copy: bool = False) -> DataFrame:
    """Row differences after casting every column to text."""
    return difference(as_text(left), as_text(right.select(*left.columns)), every_copy=every_copy)


def assert_same_rows(left: DataFrame, right: DataFrame, every_copy: bool = False) -> None:
    """Raise when either side holds a row the other lacks."""
    counts = text_differences(left, right, every_copy).groupBy("side").count().collect()
    if counts:
        found = {row["side"]: row["count"] for row in counts}
        raise AssertionError(f"Rows differ: {found.get('left', 0)} only left, {found.get('right', 0)} only right")


@dataclass(frozen=True)
class TableCheck:
    """One table pair.  The readers are called when the check runs, so a missing
    table fails that check alone."""

    source_table: str
    target_table: str
    read_source: Callable[[], DataFrame]
    read_target: Callable[[], DataFrame]
    watermark_column: str | None = None


def run_id_for(source_name: str, when: datetime | None = None) -> str:
    """``date_source_uuid``."""
    when = when or datetime.now(timezone.utc)
    return f"{when:%Y-%m-%d}_{source_name}_{uuid.uuid4().hex}"


def _run_check(check: TableCheck, source_side: bool) -> tuple:
    names = (check.source_table, check.target_table, check.watermark_column)
    try:
        source, target = check.read_source(), check.read_target()
    except (PySparkException, ValueError, OSError) as error:
        return (*names, None, None, None, None, f"{FAILED} - Data Fetch: {str(error)[:200]}", FAILED)
    try:
        return (*names, *compare_layers(source, target, source_side).first())
    except Exception as error:  # noqa: BLE001 - one table must not stop the others
        return (*names, None, None, None, None, f"{FAILED} - Unexpected Error: {str(error)[:200]}", FAILED)


def run_qc(spark: SparkSession, checks: Iterable[TableCheck], run_id: str, created_at: datetime,
           source_side: bool = True, concurrency: int = CONCURRENCY) -> DataFrame:
    """Check every pair and return one result row each, failures included."""
    rows = map_tables(spark, lambda check: _run_check(check, source_side), checks, concurrency)
    return spark.createDataFrame([(run_id, *row, created_at) for row in rows], RESULT_SCHEMA)


def append_results(results: DataFrame, target: str) -> None:
    """Append the results of a run to the table (or parquet path) ``target``, which is created if absent."""
    append(results, target)


def check_durations(log: DataFrame, run: str = "run_id", started: str = "created_at") -> DataFrame:
    """How long each check took: until the next one of its run started.

    Rows repeated exactly are one row with ``copies``; all but the last of them
    lasted no time.
    """
    rows = log.groupBy(*log.columns).agg(F.count(F.lit(1)).alias("copies"))
    rest = [name for name in log.columns if name not in (run, started)]
    mark = {"__started": F.col(started)}
    timed = next_in_order(rows.withColumns(mark), [run], [started, *rest], "__started", "ended_at",
                          population=log.withColumns(mark)).drop("__started")
    seconds = F.unix_timestamp(F.col("ended_at")) - F.unix_timestamp(F.col(started))
    return timed.withColumn("seconds", seconds).withColumn("minutes", F.round(F.col("seconds") / 60, 2))


# Size classes by source row count, in report order.
SIZE_CLASSES = (("<1K", 1_000), ("1K-10K", 10_000), ("10K-100K", 100_000))
LARGEST, UNKNOWN = ">100K", "Unknown"


def duration_buckets(durations: DataFrame, count_column: str = "source_count") -> DataFrame:
    """Durations by size class of the table, smallest class first."""
    size = F.col(count_column)
    label, place = F.when(size.isNull(), UNKNOWN), F.when(size.isNull(), 5)
    for position, (name, limit) in enumerate(SIZE_CLASSES, 1):
        label, place = label.when(size < limit, name), place.when(size < limit, position)
    bucketed = durations.select(
        label.otherwise(LARGEST).alias("count_bucket"), place.otherwise(4).alias("__place"),
        "copies", "seconds", "minutes")
    # Of several copies all but one lasted zero seconds.
    timed = F.count("seconds") + F.sum(F.col("copies") - 1)
    low = F.min(F.when(F.col("copies") > 1, F.lit(0)).otherwise(F.col("seconds")))
    return (
        bucketed.groupBy("count_bucket", "__place")
        .agg(
            F.sum("copies").alias("tables_processed"),
            F.round(F.sum("seconds") / timed, 2).alias("avg_seconds"),
            F.round(F.sum(F.col("minutes").cast("decimal(20,2)")).cast("double") / timed, 2).alias("avg_minutes"),
            low.alias("min_seconds"),
            F.coalesce(F.max("seconds"), F.max(F.when(F.col("copies") > 1, F.lit(0)))).alias("max_seconds"),
        )
        .orderBy("__place").drop("__place")
    )

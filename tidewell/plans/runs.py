"""Status report of task runs and freshness of arriving data."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.temporal import clock_text, elapsed_text
from tidewell.operators.skew import apart, drop_apart

# Display colour of each result state, and the states that are errors.
STATE_COLOURS = {
    "CANCELED": "Warning",
    "EXCLUDED": "Default",
    "FAILED": "Attention",
    "MAXIMUM_CONCURRENT_RUNS_REACHED": "Attention",
    "SUCCESS": "Good",
    "SUCCESS_WITH_FAILURES": "Warning",
    "TIMEDOUT": "Attention",
    "UPSTREAM_CANCELED": "Default",
    "UPSTREAM_FAILED": "Default",
}
ERROR_STATES = ("FAILED", "MAXIMUM_CONCURRENT_RUNS_REACHED", "TIMEDOUT")


def state_colour(state: Column) -> Column:
    colour = F.lit(None).cast("string")
    for name, shade in STATE_COLOURS.items():
        colour = F.when(state == name, shade).otherwise(colour)
    return F.coalesce(colour, F.lit("Default"))


def run_status(tasks: DataFrame, run: str = "run_id", hidden: str | None = None) -> DataFrame:
    """Tasks of each run ordered by end, unfinished last, with colour and run verdict.

    Tasks whose key contains ``hidden``, such as notifiers, are not listed but count for the verdict.
    """
    failed = drop_apart(apart(tasks, [run]).agg(
        F.coalesce(F.bool_or(F.col("result_state").isin(*ERROR_STATES)), F.lit(False)).alias("run_has_errors")))
    shown = tasks if hidden is None else tasks.where(~F.col("task_key").contains(hidden))
    listed = shown.join(failed, run)
    return listed.select(
        run, "task_key", F.coalesce("result_state", F.lit("")).alias("status"),
        state_colour(F.col("result_state")).alias("colour"), "end_time",
        clock_text(F.col("run_duration")).alias("duration"), "run_has_errors",
    ).orderBy(run, F.asc_nulls_last("end_time"), "task_key")


def freshness(df: DataFrame, arrived: Column | str, now: datetime | None = None, zone: str = "UTC") -> DataFrame:
    """Last arrival, how long ago that is, and rows whose arrival date is today in ``zone``."""
    at = F.col(arrived) if isinstance(arrived, str) else arrived
    present = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    at = at.cast("timestamp")
    today = F.to_date(F.from_utc_timestamp(present, zone))
    summary = df.agg(F.max(at).alias("last"), F.count_if(F.to_date(at) == today).alias("rows_today"))
    return summary.select(F.col("last").cast("timestamp_ntz").alias("last_received_at"),
                          elapsed_text(F.col("last"), present).alias("time_ago"), "rows_today")

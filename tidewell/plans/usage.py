"""Cluster usage reports over node samples, run periods and cluster changes.

Node samples have ``start_time, end_time, cluster_id, instance_id``, five
percentages and two byte counters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.temporal import (
    clipped_end,
    exact_avg,
    in_hours,
    minutes_between,
    seconds_between,
    shifted,
)
from tidewell.operators.skew import apart, drop_apart, previous_in_order

PERCENTS = ("cpu_user_percent", "cpu_system_percent", "cpu_wait_percent", "mem_used_percent", "mem_swap_percent")
BYTES = ("network_sent_bytes", "network_received_bytes")
GIB = 1024 * 1024 * 1024


def _restricted(samples: DataFrame, hours: tuple[int, int] | None, cluster_id: str | None) -> DataFrame:
    if cluster_id is not None:
        samples = samples.where(F.col("cluster_id") == cluster_id)
    if hours is not None:
        samples = samples.where(in_hours(F.col("start_time"), *hours))
    return samples


def used_compute(tasks: DataFrame, compute_id: str, column: str = "compute_ids") -> DataFrame:
    """Task runs whose array of compute ids holds one id."""
    return tasks.where(F.array_contains(F.col(column), compute_id))


def clip_intervals(samples: DataFrame, hour: int) -> DataFrame:
    """End times cut at a full hour of the day each sample started."""
    return samples.withColumn("end_time", clipped_end(F.col("start_time"), F.col("end_time"), hour))


def daily_utilisation(samples: DataFrame, hours: tuple[int, int] | None = None, clip: bool = False,
                      cluster_id: str | None = None) -> DataFrame:
    """Per day, cluster and instance: active time, mean and peak load, traffic.

    ``clip`` cuts samples at the end of the hour window.
    """
    samples = _restricted(samples, hours, cluster_id)
    if clip and hours is not None:
        samples = clip_intervals(samples, hours[1])
    minutes = minutes_between(F.col("start_time"), F.col("end_time"))
    measures = [F.sum(minutes).alias("total_active_minutes"), (F.sum(minutes) / 60).alias("total_active_hours")]
    measures += [exact_avg(F.col(name)).alias(f"avg_{name}") for name in PERCENTS]
    measures += [F.max(name).alias(f"max_{name}") for name in PERCENTS]
    measures += [F.sum(name).alias(f"total_{name}") for name in BYTES]
    measures += [(F.sum(name) / GIB).alias(f"total_{name.removesuffix('_bytes')}_gb") for name in BYTES]
    return samples.groupBy(F.to_date("start_time").alias("date"), "cluster_id", "instance_id").agg(*measures)


def threshold_counts(daily: DataFrame, limit: float = 50,
                     columns: Sequence[str] = ("max_mem_used_percent", "max_cpu_system_percent",
                                               "max_cpu_user_percent")) -> DataFrame:
    """How many daily rows exceed the limit, one output row per column; one pass."""
    counts = daily.agg(*[F.count_if(F.col(name) > limit).alias(name) for name in columns])
    entries = F.array(*[
        F.struct(F.lit(i).alias("s_no"), F.lit(f"{name} greater_than_{limit:g}").alias("aggregation_type"),
                 F.col(name).alias("n"))
        for i, name in enumerate(columns, 1)
    ])
    return counts.select(F.inline(entries)).orderBy("s_no")


def idle_minutes(samples: DataFrame, hours: tuple[int, int] | None = None, below: float = 1,
                 cluster_id: str | None = None) -> DataFrame:
    """Per day and cluster: minutes in which the CPU was used less than ``below`` percent."""
    samples = _restricted(samples, hours, cluster_id)
    load = F.col("cpu_user_percent") + F.col("cpu_system_percent") + F.col("cpu_wait_percent")
    minutes = minutes_between(F.col("start_time"), F.col("end_time"))
    idle = F.sum(F.when(load < below, minutes).otherwise(0))
    return (samples.groupBy(F.to_date("start_time").alias("date"), "cluster_id")
            .agg(idle.alias("idle_time_minutes"), (idle / 60).alias("idle_time_hours")))


def active_nodes(samples: DataFrame, offset: tuple[int, int] = (0, 0), hours: tuple[int, int] | None = None,
                 on_date: str | None = None, cluster_id: str | None = None, approximate: bool = False) -> DataFrame:
    """Distinct instances per sample time, with the time moved to a local clock.

    Date and hour filters apply to the local clock.
    """
    local = shifted(F.col("start_time"), *offset)
    samples = _restricted(samples, None, cluster_id)
    if hours is not None:
        samples = samples.where(in_hours(local, *hours))
    if on_date is not None:
        samples = samples.where(F.to_date(local) == F.lit(on_date).cast("date"))
    count = F.approx_count_distinct("instance_id") if approximate else F.count_distinct("instance_id")
    return samples.groupBy("start_time", local.alias("local_time")).agg(count.alias("active_nodes"))


def run_bounds(periods: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """First start and last end of each run's periods."""
    return periods.groupBy(*keys).agg(F.min("period_start_time").alias("run_start"),
                                      F.max("period_end_time").alias("run_end"))


def samples_in_spans(samples: DataFrame, spans: DataFrame, keys: Sequence[str], at: str = "start_time",
                     start: str = "run_start", end: str = "run_end", slot: str = "1 day") -> DataFrame:
    """Each sample with every span of its keys that holds its time, both ends included.

    Spans are listed once per time slot they touch, so the join is on the keys
    and the slot: a busy key is spread over its slots, and samples meet only the
    spans near them.  A slot much shorter than the spans repeats span rows; one
    much longer brings in spans that the range condition then rejects.
    """
    seconds = _slot_seconds(slot)

    def number(column: Column) -> Column:
        return F.floor(F.unix_timestamp(column) / seconds)

    listed = spans.withColumn("__slot", F.explode(F.sequence(number(F.col(start)), number(F.col(end)))))
    joined = samples.withColumn("__slot", number(F.col(at))).join(listed, [*keys, "__slot"])
    return joined.where((F.col(at) >= F.col(start)) & (F.col(at) <= F.col(end))).drop("__slot")


def _slot_seconds(slot: str) -> int:
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    amount, unit = slot.split()
    return int(amount) * units[unit.removesuffix("s")]


def quartile_of_run(at: Column, start: Column, end: Column) -> Column:
    """``q1``..``q4`` by quarters of the run in whole seconds, upper ends included."""
    length = seconds_between(start, end)

    def border(quarter: int) -> Column:
        step = F.floor(length * quarter / F.lit(4))
        return F.timestamp_add("SECOND", step.cast("int"), start)

    return (F.when(at <= border(1), "q1").when(at <= border(2), "q2").when(at <= border(3), "q3").otherwise("q4"))


def run_quartiles(samples: DataFrame, bounds: DataFrame, keys: Sequence[str] = ("cluster_id",),
                  workers_only: bool = False, slot: str = "1 day") -> DataFrame:
    """Samples taken during a run with the quarter of the run they fall in."""
    if workers_only:
        samples = samples.where(~F.col("driver"))
    inside = samples_in_spans(samples, bounds, keys, slot=slot)
    return inside.withColumn("quadrant", quartile_of_run(F.col("start_time"), F.col("run_start"), F.col("run_end")))


def quartile_by_interval(samples: DataFrame, key: str = "cluster_id") -> DataFrame:
    """Samples with the quarter of their cluster's whole active time, at full precision."""
    spans = drop_apart(apart(samples, [key]).agg(F.min("start_time").alias("min_start_time"),
                                                 F.max("end_time").alias("max_end_time")))
    joined = samples.join(spans, key)
    passed = F.col("start_time") - F.col("min_start_time")
    total = F.col("max_end_time") - F.col("min_start_time")

    def share(text: str) -> Column:
        return total * F.lit(text).cast("decimal(3,2)")

    label = (F.when(passed <= share("0.25"), "Q1").when(passed <= share("0.50"), "Q2")
             .when(passed <= share("0.75"), "Q3").otherwise("Q4"))
    return joined.withColumn("quadrant", label)


def bucket_report(labelled: DataFrame, keys: Sequence[str] = ("quadrant",)) -> DataFrame:
    """Per quarter: distinct instances, load statistics and traffic in one aggregation."""
    measures = [F.count_distinct("instance_id").alias("active_nodes")]
    for name in PERCENTS:
        measures += [exact_avg(F.col(name)).alias(f"avg_{name}"), F.min(name).alias(f"min_{name}"),
                     F.max(name).alias(f"max_{name}")]
    measures += [F.sum(name).alias(f"total_{name}") for name in BYTES]
    return labelled.groupBy(*keys).agg(*measures)


def idle_and_peak(changes: DataFrame) -> DataFrame:
    """Seconds each cluster spent without workers and with all of them.

    The time up to a change counts for the worker number that change reports.
    Exact copies of a change add no time and are merged first.
    """
    order = ["change_time", "worker_count", "max_workers"]
    moments = changes.select("cluster_id", *order, F.col("change_time").alias("__at"))
    gaps = previous_in_order(moments.distinct(), ["cluster_id"], order, "__at", "__last", population=moments)
    seconds = F.unix_timestamp("change_time") - F.unix_timestamp("__last")
    return gaps.groupBy("cluster_id").agg(
        F.sum(F.when(F.col("worker_count") == 0, seconds).otherwise(0)).alias("idle_time_seconds"),
        F.sum(F.when(F.col("worker_count") == F.col("max_workers"), seconds).otherwise(0))
        .alias("peak_utilization_time_seconds"),
    )

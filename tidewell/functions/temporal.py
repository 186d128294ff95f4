"""Time arithmetic shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shifted(column: Column, hours: int = 0, minutes: int = 0) -> Column:
    """The instant moved by a fixed offset."""
    return column + F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(minutes))


def in_hours(column: Column, start_hour: int, end_hour: int) -> Column:
    """True when the hour of day is in ``[start_hour, end_hour)``."""
    hour = F.hour(column)
    return (hour >= start_hour) & (hour < end_hour)


def clipped_end(start: Column, end: Column, hour: int) -> Column:
    """``end``, but not later than the full ``hour`` on the day of ``start``."""
    cap = F.date_trunc("DAY", start).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(hour))
    return F.when(end > cap, cap).otherwise(end)


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from ``start`` to ``end``."""
    return F.timestamp_diff("MINUTE", start, end)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``."""
    return F.timestamp_diff("SECOND", start, end)


def exact_sum(column: Column, scale: int = 6) -> Column:
    """Sum in decimal, so the result does not depend on the order of addition."""
    return F.sum(column.cast(f"decimal(20,{scale})"))


def exact_avg(column: Column, scale: int = 6) -> Column:
    """Mean of a double column that is the same under every partitioning."""
    return exact_sum(column, scale).cast("double") / F.count(column)


def clock_text(millis: Column) -> Column:
    """``h:mm:ss``, or ``mm:ss`` below one hour; hours are not wrapped at a day."""
    seconds = F.floor(millis / 1000)
    hours = F.floor(seconds / 3600)
    minute = F.floor(seconds / 60) % 60
    second = seconds % 60
    return (F.when(hours > 0, F.format_string("%d:%02d:%02d", hours, minute, second))
            .otherwise(F.format_string("%02d:%02d", minute, second)))


def elapsed_text(since: Column, now: Column) -> Column:
    """``N hours ago``, or minutes when less than one hour has passed."""
    hours = F.timestamp_diff("HOUR", since, now)
    minutes = F.timestamp_diff("MINUTE", since, now)
    return (F.when(hours >= 1, F.concat(hours.cast("string"), F.lit(" hours ago")))
            .otherwise(F.concat(minutes.cast("string"), F.lit(" minutes ago"))))

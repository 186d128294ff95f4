"""Streaming sinks and the file-to-table ingest path."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewell.functions.hashing import add_row_hashes
from tidewell.operators.transforms import ColumnSpec, lineage_columns, transform_map


def with_trigger(writer: DataStreamWriter, kind: str = "availableNow", interval: str | None = None) -> DataStreamWriter:
    """Apply a trigger: ``availableNow``, ``once``, or ``processingTime`` with an interval."""
    if kind == "availableNow":
        return writer.trigger(availableNow=True)
    if kind == "once":
        return writer.trigger(once=True)
    if kind == "processingTime" and interval:
        return writer.trigger(processingTime=interval)
    raise ValueError(f"Unknown trigger {kind!r}, or processingTime without an interval")


def write_stream(df: DataFrame, target: str, output_mode: str = "append", trigger: str = "availableNow",
                 interval: str | None = None, options: Mapping[str, str] | None = None,
                 wait: bool = True) -> StreamingQuery:
    """Write a stream to a table, or to parquet files when the target holds a slash.

    A checkpoint location is required: without it a restart would load every file
    again.
    """
    options = dict(options or {})
    if not options.get("checkpointLocation"):
        raise KeyError("checkpointLocation")
    writer = with_trigger(df.writeStream.format("parquet").outputMode(output_mode), trigger, interval)
    writer = writer.options(**options)
    query = writer.start(target) if "/" in target else writer.toTable(target)
    if wait:
        query.awaitTermination()
    return query


def ingest_stream(df: DataFrame, specs: Sequence[ColumnSpec], target: str, batch_id: str, keys: Sequence[str] = (),
                  loaded_at=None, trigger: str = "availableNow", interval: str | None = None,
                  options: Mapping[str, str] | None = None, wait: bool = True) -> StreamingQuery:
    """Mapped, hashed and stamped rows of a file stream, appended to the target."""
    hashed = add_row_hashes(transform_map(df, specs), keys)
    return write_stream(lineage_columns(hashed, batch_id, loaded_at), target, "append", trigger, interval, options, wait)

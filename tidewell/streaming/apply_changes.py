"""Apply a change stream to a history table, whatever order changes arrive in.

The history is kept as the changes themselves, one folder a batch::

    <path>/stream=<name>/batch=<id>/...

Folding is left to the reader, a single shuffle by key (hot keys are split as in
``scd2``).  It gives the same rows for any split, order and repetition of the changes, so

* a batch costs what it holds: nothing older is read or written again;
* a batch that is delivered again replaces its own folder;
* a delete that arrives before the change it follows still counts;
* :meth:`ChangeApplier.compact` may replace folders by their fold at any time.

Keyed state in the stream would hold every key once more and spare the reader no shuffle,
as changes mostly arrive in order and would all be passed on.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewell.operators.scd import START, latest_state, position_state, version_state, visible_latest, visible_versions
from tidewell.sinks.folders import remove, subfolders
from tidewell.streaming.ingest import with_trigger

# Accepted history modes.
MODES = ("SCD_1", "SCD_2")

COMPACTED = "compacted"


class ChangeApplier:
    """Change batches in, history out.

    Several streams may write to one path at the same time, each under its own name.  A
    reader sees whole batches but for the moment in which files of a
    batch are moved into place, and has to be repeated if a compaction removes folders under it.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], sequence: Sequence[str], mode: str,
                 op: str | None = None, exclude: Sequence[str] = ()):
        if mode not in MODES:
            raise ValueError(f"History mode must be one of {MODES}, not {mode!r}")
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.sequence = list(keys), list(sequence)
        self.mode, self.op, self.exclude = mode, op, list(exclude)

    def _folder(self, query_id: str, batch_id: str) -> str:
        return f"{self.path}/stream={quote(query_id, safe='')}/batch={quote(batch_id, safe='')}"

    def _reduced(self, changes: DataFrame) -> DataFrame:
        """What later changes still need: the last change of a key, or one of each position."""
        if self.mode == "SCD_1":
            return latest_state(changes, self.keys, self.sequence)
        return position_state(changes, self.keys, self.sequence)

    def folders(self) -> list[str]:
        """The folders that hold changes, one a batch."""
        return [batch for stream in subfolders(self.spark, self.path) for batch in subfolders(self.spark, stream)]

    def _read(self, folders: Sequence[str]) -> DataFrame:
        # Without partition columns: the names of streams and batches are no data.
        return self.spark.read.option("recursiveFileLookup", "true").parquet(*folders)

    def apply(self, changes: DataFrame, batch_id: str = "", query_id: str = "") -> None:
        """Add one batch of changes.  With a name, a batch given twice counts once."""
        if not query_id:
            query_id, batch_id = "unnamed", uuid.uuid4().hex
        rows = latest_state(changes, self.keys, self.sequence) if self.mode == "SCD_1" else changes
        rows.write.mode("overwrite").parquet(self._folder(query_id, batch_id))

    def table(self) -> DataFrame | None:
        """The history as readers see it; None before the first batch."""
        folders = self.folders()
        if not folders:
            return None
        changes = self._read(folders)
        if self.mode == "SCD_1":
            return visible_latest(latest_state(changes, self.keys, self.sequence), self.op, self.exclude)
        state = version_state(changes, self.keys, self.sequence)
        return visible_versions(state, self.sequence, self.op, self.exclude, START)

    def compact(self) -> None:
        """Replace all folders there are by one that holds what they come to.

        The new folder is complete before an old one goes, and until then readers find the same changes
        twice, which changes nothing; nor does a failure on the way, or a batch that is delivered once more.
        Deletes are kept, as changes before them may still arrive.
        """
        folders = self.folders()
        if len(folders) < 2:
            return
        self._reduced(self._read(folders)).write.parquet(self._folder(COMPACTED, uuid.uuid4().hex))
        for folder in folders:
            remove(self.spark, folder)

    def run(self, stream: DataFrame, checkpoint: str, query_name: str, trigger: str = "availableNow",
            interval: str | None = None, options: Mapping[str, str] | None = None, wait: bool = True) -> StreamingQuery:
        """Apply a change stream batch by batch.

        ``query_name`` identifies the stream over restarts; a new checkpoint needs a new name.
        """
        def add(batch: DataFrame, batch_id: int) -> None:
            self.apply(batch, str(batch_id), query_name)

        writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
        query = with_trigger(writer.options(**dict(options or {})), trigger, interval).start()
        if wait:
            query.awaitTermination()
        return query

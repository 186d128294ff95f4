"""How frequent are hashed items over the whole corpus: a table of fixed size.

Every task counts its items by hash bucket and sends the non-zero counts packed by
segment; a segment's counts are summed in one task.  The result has one byte per
bucket, whatever the corpus, so it may be sent to every task.  It only orders
items: any order is right, a rarer-first order is fast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewell.llm.common import arrow_schema, batch_of, packed

#: Buckets of a segment, and segments sent at once.
SEGMENT, SENT = 1 << 14, 16
COUNTS = arrow_schema("segment int, slots binary, counts binary")
COUNTS_DDL = "segment int, slots binary, counts binary"


def bucket_rows(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Packed non-zero counts by bucket, a few segments at a time: a full table is 25 MB."""
    total = -(-len(counts) // SEGMENT)
    for start in range(0, total, SENT):
        segments, slots, values = [], [], []
        for segment in range(start, min(start + SENT, total)):
            part = counts[segment * SEGMENT:(segment + 1) * SEGMENT]
            held = np.flatnonzero(part)
            if len(held):
                segments.append(segment)
                slots.append(held.astype(np.uint16))
                values.append(part[held])
        if segments:
            yield batch_of(COUNTS, [segments, packed(slots), packed(values)])


def counted(items: Callable[[pa.RecordBatch], Iterable[np.ndarray]], size: int):
    """A ``mapInArrow`` function that counts, once a task, what ``items`` takes from each batch, array by array."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.uint32)
        for batch in batches:
            for part in items(batch):
                np.add.at(counts, (part & np.uint64(size - 1)).astype(np.int64), np.uint32(1))
        yield from bucket_rows(counts)
    return count


def summed(key, group):
    total = np.zeros(SEGMENT, np.float64)
    for slots, counts in zip(group.column("slots").to_pylist(), group.column("counts").to_pylist()):
        total[np.frombuffer(slots, np.uint16)] += np.frombuffer(counts, np.uint32)
    rank = np.ceil(8 * np.log2(1 + total)).clip(0, 255).astype(np.uint8)
    return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "ranks": pa.array([rank.tobytes()], pa.binary())})


def rarity_table(counts: DataFrame, size: int) -> np.ndarray:
    """Rank per bucket, 0 to 255, larger is more frequent.  ``size`` bytes reach the driver."""
    rows = counts.groupBy("segment").applyInArrow(summed, "segment int, ranks binary").collect()
    table = np.zeros(max(size, SEGMENT), np.uint8)
    for row in rows:
        table[row.segment * SEGMENT:(row.segment + 1) * SEGMENT] = np.frombuffer(row.ranks, np.uint8)
    return table[:size]

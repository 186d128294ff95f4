"""Helpers shared by the corpus operators: tokens, hashes, shingles, written intermediates.

Words are maximal runs of characters other than ASCII white space, with A-Z
lower-cased.  All array work happens inside Spark tasks, on slices of Arrow
batches of a bounded number of bytes, so memory does not depend on batch or
partition size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import scratch_path

SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(frame: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unused(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in frame.columns}
    while name in taken:
        name += "_"
    return name


def fold(doc_id: str, modulus: int):
    """Column: crc32 of the id as text, modulo."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(modulus))


def bounded_sample(ids: DataFrame, column: str, size: int) -> DataFrame:
    """The ``size`` ids with the smallest hashes.

    A bound on the hash, from the number of rows, leaves little more than the sample, so that
    what meets in the final sort does not grow with the table.
    """
    rows = ids.count()
    share = min(1.0, (1.5 * size + 1000) / max(rows, 1))
    hashed = F.xxhash64(F.col(column))
    few = ids if share >= 1 else ids.where(hashed < int(-2.0 ** 63 + share * 2.0 ** 64))
    return few.orderBy(hashed, column).limit(size)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about ``limit`` bytes of ``column``."""
    sizes = np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(float))
    piece = (np.cumsum(sizes) // limit).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for start, stop in zip(cuts, cuts[1:]):
        if stop > start:
            yield batch.slice(start, stop - start)


def strings(array: pa.Array) -> pa.Array:
    """The array as non-null strings; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    return pc.fill_null(array.cast(pa.string()), "")


@dataclass
class Words:
    """Words of several texts: text ``i`` has ``hashes[offsets[i]:offsets[i + 1]]``.

    ``starts`` and ``ends`` are byte places of each word in ``data``, the texts' bytes
    joined, where text ``i`` is ``data[bounds[i]:bounds[i + 1]]``.
    """

    hashes: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def word(self, i: int) -> str:
        return self.data[self.starts[i]:self.ends[i]].tobytes().decode("utf-8", "replace")


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
BASE, INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Values of bytes in hashes, and bytes hashed at once: temporaries stay small however long a text is.
CODES = LOWER.astype(np.uint64) + np.uint64(1)
HASHED = 1 << 16
_powers: dict[str, np.ndarray] = {}


def powers(kind: str, size: int) -> np.ndarray:
    """Powers of the hash base (or its inverse) modulo 2^64; kept for pieces of usual size."""
    if len(_powers.get(kind, ())) < size:
        base = BASE if kind == "up" else INVERSE
        made = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(size, 2 * HASHED) - 1, base)]), dtype=np.uint64)
        if size > 2 * HASHED:
            return made
        _powers[kind] = made
    return _powers[kind][:size]


def span_hashes(data: np.ndarray, starts: np.ndarray, *stops: np.ndarray) -> list[np.ndarray]:
    """For each of ``stops``, hashes of ``data`` from ascending ``starts`` to there: scrambled polynomials over lower-cased bytes.

    Spans are not empty.  They are taken together by where they start, a piece of the data at a time; one prefix sum
    serves all spans of a piece.
    """
    out = [np.empty(len(starts), np.uint64) for _ in stops]
    for a, b in runs(starts // HASHED):
        low, high = starts[a], max(int(stop[a:b].max()) for stop in stops)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(CODES[data[low:high]] * powers("up", high - low), out=sums[1:])
        first = starts[a:b] - low
        below, down = sums[first], powers("down", high - low)[first]
        for hashes, stop in zip(out, stops):
            hashes[a:b] = mix((sums[stop[a:b] - low] - below) * down + (stop[a:b] - starts[a:b]).astype(np.uint64))
    return out


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The joined bytes of a string array and the bounds of each string."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[bounds[0]:bounds[-1]] if held is not None and bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def words_of(texts: pa.Array) -> Words:
    """Words and their hashes (:func:`span_hashes`); the cost is a few passes over the bytes."""
    data, bounds = bytes_of(texts)
    return words_in(data, bounds)


def words_in(data: np.ndarray, bounds: np.ndarray) -> Words:
    size = len(data)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64), none, none, data, bounds)
    inside = ~SPACE[data]
    first = np.zeros(size + 1, bool)
    first[bounds] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:size]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:] | first[1:size]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    hashes, = span_hashes(data, starts, ends)
    return Words(hashes, np.searchsorted(starts, bounds).astype(np.int64), starts, ends, data, bounds)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chain(first: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Ordered combination of two hash arrays."""
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + following)


def ngrams(tokens: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles and their offsets; a shorter text is one shingle."""
    h, counts = tokens.hashes, tokens.counts
    total = len(h)
    made = np.full(total, np.uint64(size))
    for step in range(size):
        ahead = np.zeros(total, np.uint64)
        ahead[:total - step] = h[step:]
        made = chain(made, ahead)
    text = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(total) + size <= tokens.offsets[1:][text]
    out_counts = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(out_counts)])
    out = np.zeros(offsets[-1], np.uint64)
    long_text = (counts >= size)[text] & inside
    out[offsets[:-1][text[long_text]] + (np.flatnonzero(long_text) - tokens.offsets[:-1][text[long_text]])] = made[long_text]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        value = np.array([np.uint64(counts[i])])
        for word in h[tokens.offsets[i]:tokens.offsets[i + 1]]:
            value = chain(value, np.array([word]))
        out[offsets[i]] = value[0]
    return out, offsets


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    if len(values) > 1:
        values = values[np.concatenate([[True], values[1:] != values[:-1]])]
    return values


def set_key(values: np.ndarray) -> tuple[int, int]:
    """128-bit key of a set given as distinct values, as two signed 64-bit integers."""
    a = mix(np.array([values.sum(dtype=np.uint64) + np.uint64(len(values))], np.uint64))
    b = mix(values ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return int(a.view(np.int64)[0]), int(np.int64(np.array([b], np.uint64).view(np.int64)[0]))


def packed(arrays: list[np.ndarray]) -> pa.Array:
    """Binary column holding each array's bytes."""
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def unpacked(column: pa.Array, dtype=np.uint64) -> list[np.ndarray]:
    return [np.frombuffer(v, dtype) for v in column.to_pylist()]


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of runs of equal neighbours."""
    if len(keys):
        cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        yield from zip(cuts[:-1].tolist(), cuts[1:].tolist())


def whole_groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of sorted batches regrouped so that rows equal in the first ``keys`` columns stay together."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        new = [batch.column(x).to_numpy(zero_copy_only=False) for x in names]
        held = new if held is None else [np.concatenate(pair) for pair in zip(held, new)]
        same = np.logical_and.reduce([held[k] == held[k][-1] for k in range(keys)]) if len(held[0]) else np.ones(0, bool)
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield [x[:cut] for x in held]
            held = [x[cut:] for x in held]
    if held is not None and len(held[0]):
        yield held


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def arrow_schema(spec: str) -> pa.Schema:
    """Arrow schema of a DDL string with the types these operators use."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(),
             "string": pa.string(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()),
             "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in spec.split(", "))])

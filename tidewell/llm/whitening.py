"""Whitening of embeddings by Chebyshev-filtered subspace iteration on their covariance.

The covariance V is never formed.  A pass over the vectors gives V·Q for a block Q of ``count`` + guard columns: each
task multiplies centred rows by Q and back, partial results are added up in two rounds of tasks, and one matrix of
dimension x block reaches the driver.  A round

1. filters the block by a Chebyshev polynomial of V, one pass a degree, by the three-term recurrence.  The
   unwanted interval runs from 0 to the smallest Ritz value of the block, where the polynomial stays within
   -1 and 1, while it grows fastest beyond;
2. makes the block orthonormal (QR) and solves the projected problem (Rayleigh-Ritz), which costs one pass and gives the
   first product of the next filter as well;
3. measures residuals: with |Vq - eq| = r an eigenvalue lies within r of e.

Components are certified, leading ones first, when their residual is below ``TOLERANCE`` of the largest eigenvalue, or when
rounds no longer lower it and it is below ``FLOOR``, as rounding allows no more.  They are then taken out of the
block and the operator, so that one dominant direction (a vector repeated very often) cannot drown the others.  If not all
are certified after ``MOST_ROUNDS`` rounds an error is raised; there is never an uncertified answer.

Entries become integers, floor(64 c) + 1000000, so sums, counts and deviations are exact, and a centred entry is
(n x - S) / n with one rounding.  Entries beyond 2^40 in size count as 2^40.

Rows whose vector is null, empty, holds null or non-finite entries, or has another length than most vectors (of
equally frequent lengths the longest counts) are left out.  Repeated rows count each time and null ids stay.  Components whose
eigenvalue is zero but for rounding are left out, as nothing can be divided by their root: a table of
equal vectors gives no rows, nor does an empty one.  A deviation that 64 bits cannot hold is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_schema, batch_of, materialise, quoted

SHIFT = 1_000_000
MOST = 2.0 ** 40
TOLERANCE = 1e-14
FLOOR = 1e-11
MOST_ROUNDS = 100
#: Highest degree of a filter; the degree of a round is chosen to gain about ``GAIN``.
MOST_DEGREE, GAIN, MOST_GAIN = 30, 1e9, 1e11
ROWS = 4096
#: Bytes of vectors that a task of a pass takes at least, where there are more partitions than cores.
TASK_BYTES = 32 << 20


@dataclass
class Fit:
    """Whitening of ``n`` vectors with integer sums ``sums``: components are columns of ``axes``."""

    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    trace: float
    residual: float
    passes: int


def integers(frame: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Rows (vec_id, x) of the vectors that take part, x the packed 64-bit integers."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    fine = frame.select(F.col(vec_id).alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)
    length = fine.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).head()
    schema = arrow_schema("vec_id long, x binary")
    size, rows = (length.d, length.n) if length else (0, 0)
    # Passes are many and short: small scan partitions are taken together, without a shuffle.
    tasks = max(frame.sparkSession.sparkContext.defaultParallelism, 8 * size * rows // TASK_BYTES)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = np.clip(batch.column(1).flatten().to_numpy(zero_copy_only=False), -MOST, MOST)
            x = (np.floor(64 * c).astype(np.int64) + SHIFT).reshape(-1, size)
            yield batch_of(schema, [batch.column(0).cast(pa.int64()), pa.array([r.tobytes() for r in x], pa.binary())])

    return fine.where(F.size("v") == size).coalesce(tasks).mapInArrow(pack, "vec_id long, x binary")


def matrix_of(column: pa.Array) -> np.ndarray:
    """The packed rows as one integer matrix."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.int64).reshape(len(rows), -1)


def blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of at most ``ROWS`` rows with their matrix."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            piece = batch.slice(start, ROWS)
            yield piece, matrix_of(piece.column(column))


def added(parts: DataFrame, kind=np.float64) -> np.ndarray:
    """The sum of packed arrays of 64-bit numbers, one row a task: first within about the root of the tasks, then over those."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0).to_pylist():
                part = np.frombuffer(value, kind)
                total = part.copy() if total is None else total + part
        if total is not None:
            yield batch_of(arrow_schema("part binary"), [pa.array([total.tobytes()], pa.binary())])

    tasks = parts.rdd.getNumPartitions()
    if tasks > 16:
        parts = parts.repartition(int(np.ceil(np.sqrt(tasks)))).mapInArrow(add, "part binary")
    rows = [np.frombuffer(r.part, kind) for r in parts.collect()]
    return np.sum(rows, axis=0) if rows else np.zeros(0, kind)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n with one rounding, where n x fits in 64 bits (else two)."""
    if n < 2 ** 63 // int(SHIFT + 64 * MOST + 1):
        return (n * x - sums.astype(np.int64)) / n
    if n * (int(np.abs(x).max(initial=0)) + 1) < 2 ** 62:
        return (n * x - sums.astype(np.int64)) / n
    return (x - (sums // n).astype(np.int64)) - (sums % n).astype(np.float64) / n


def block_product(packed: DataFrame, q: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """V times ``q``: one pass over all vectors."""
    sent = packed.sparkSession.sparkContext.broadcast((q, sums))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, sums = sent.value
        total = np.zeros(q.shape)
        for _, x in blocks(batches, 0):
            c = centred(x, n, sums)
            total += c.T @ (c @ q)
        yield batch_of(arrow_schema("part binary"), [pa.array([total.tobytes()], pa.binary())])

    out = added(packed.select("x").mapInArrow(multiply, "part binary")).reshape(q.shape) / n
    sent.unpersist()
    return out


def exact_sums(packed: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors and their exact sums: high and low parts of 21 bits are added in 64 bits, enough for 2^42 vectors."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for _, x in blocks(batches, 0):
            n, total = n + len(x), total + np.concatenate([(x >> 21).sum(axis=0), (x & 0x1FFFFF).sum(axis=0)])
        if n:
            yield batch_of(arrow_schema("part binary"), [pa.array([np.concatenate([[n], total]).astype(np.int64).tobytes()], pa.binary())])

    total = added(packed.select("x").mapInArrow(count, "part binary"), np.int64)
    if not len(total):
        return 0, np.zeros(0, object)
    whole = np.array([int(v) for v in total], object)
    half = (len(whole) - 1) // 2
    return int(whole[0]), whole[1:1 + half] * (1 << 21) + whole[1 + half:]


def trace_of(packed: DataFrame, n: int, sums: np.ndarray) -> float:
    def square(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1)
        for _, x in blocks(batches, 0):
            c = centred(x, n, sums)
            total += (c * c).sum()
        yield batch_of(arrow_schema("part binary"), [pa.array([total.tobytes()], pa.binary())])

    return float(added(packed.select("x").mapInArrow(square, "part binary"))[0]) / n


def fit_whitening(packed: DataFrame, count: int = 32, guard: int = 16, seed: int = 7) -> Fit:
    """The ``count`` leading components of all packed vectors."""
    n, sums = exact_sums(packed)
    if not n:
        return Fit(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0, 0)
    d = len(sums)
    trace = trace_of(packed, n, sums)
    if trace == 0:
        return Fit(n, sums.tolist(), np.zeros(0), np.zeros((d, 0)), 0.0, 0.0, 2)
    passes = 2

    def product(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return block_product(packed, q, n, sums)

    wanted, width = min(count, d), min(count + guard, d)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
    done, known = np.zeros((d, 0)), np.zeros(0)

    def rest(block: np.ndarray) -> np.ndarray:
        """The block without its part in the certified components."""
        return block - done @ (done.T @ block)

    residual, best = 0.0, np.inf
    for _ in range(MOST_ROUNDS):
        vq = rest(product(q))
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        open_ = wanted - len(known)
        left = np.linalg.norm(vq - q * values, axis=0)[:open_] / max([*known, values[0]])
        stuck = left.max() <= FLOOR and left.max() > best / 2
        certified = open_ if stuck else int(np.argmax(np.append(left > TOLERANCE, True)))
        best = left.max() if not certified else np.inf
        residual = max([residual, *left[:certified]])
        done, known = np.hstack([done, q[:, :certified]]), np.append(known, values[:certified])
        if len(known) == wanted:
            break
        q, vq, values = q[:, certified:], rest(vq[:, certified:]), values[certified:]
        border = max(values[-1], 1e-8 * values[0])
        q = rest(chebyshev(lambda block: rest(product(block)), q, vq, border, values[0], values[wanted - len(known) - 1]))
        q = np.linalg.qr(rest(np.linalg.qr(q)[0]))[0]
    else:
        raise RuntimeError(f"components not certified: {len(known)} of {wanted} after {passes} passes")
    order = np.argsort(-known, kind="stable")
    known, done = known[order], done[:, order]
    held = known > max(d, 64) * np.finfo(float).eps * known[0]
    return Fit(n, sums.tolist(), known[held], done[:, held], trace, residual, passes)


def chebyshev(product, q: np.ndarray, vq: np.ndarray, border: float, top: float, last: float) -> np.ndarray:
    """The block under the Chebyshev polynomial of V that is small on [0, border]; ``vq`` is V·q, the first product.

    The degree is such that the last wanted value gains ``GAIN``, but the top one no more than ``MOST_GAIN``, beyond which
    its direction would drown all others in rounding.
    """
    half = border / 2
    rate = lambda value: np.arccosh(max((value - half) / half, 1 + 1e-6))
    degree = int(np.clip(min(np.ceil(np.log(2 * GAIN) / rate(last)), np.log(2 * MOST_GAIN) // rate(top)), 2, MOST_DEGREE))
    before, now = q, (vq - half * q) / half
    for _ in range(degree - 1):
        before, now = now, 2 * (product(now) - half * now) / half - before
        size = np.abs(now).max()
        before, now = before / size, now / size
    return now


def whitened_rows(packed: DataFrame, fit: Fit) -> DataFrame:
    """Rows (vec_id, deviation, whitened): the vector's exact deviation and its whitened coordinates, packed."""
    sent = packed.sparkSession.sparkContext.broadcast((np.array(fit.sums, object), fit.axes / np.sqrt(fit.values)))
    n = fit.n

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, axes = sent.value
        for piece, x in blocks(batches, 1):
            w = centred(x, n, sums) @ axes
            yield batch_of(arrow_schema("vec_id long, deviation long, whitened binary"),
                           [piece.column(0), deviations(x, n, sums), pa.array([r.tobytes() for r in w], pa.binary())])

    return packed.mapInArrow(project, "vec_id long, deviation long, whitened binary")


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Exact sums of (n x - S)^2; in 64 bits where they surely fit, else in unbounded integers."""
    low, high = x.min(axis=0, initial=0), x.max(axis=0, initial=0)
    most = max((abs(n * int(v) - s) for edge in (x.min(axis=0), x.max(axis=0)) for v, s in zip(edge, sums)), default=0) if len(x) else 0
    if most * most * x.shape[1] < 2 ** 63 and n * int(max(abs(low).max(initial=0), abs(high).max(initial=0))) < 2 ** 63:
        off = n * x - sums.astype(np.int64)
        return pa.array((off * off).sum(axis=1), pa.int64())
    exact = (((x.astype(object) * n) - sums) ** 2).sum(axis=1)
    return pa.array([v if v < 2 ** 63 else None for v in exact], pa.int64())


def identity_error(rows: DataFrame, n: int, width: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, by a pass over them."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for batch in batches:
            w = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float64).reshape(-1, width)
            total[:-1] += w.T @ w
            total[-1] += w.sum(axis=0)
        yield batch_of(arrow_schema("part binary"), [pa.array([total.tobytes()], pa.binary())])

    total = added(rows.select("whitened").mapInArrow(multiply, "part binary")).reshape(width + 1, width) / n
    return float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(width)).max())


def whiten(frame: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", count: int = 32, guard: int = 16) -> DataFrame:
    """One row a vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    packed = materialise(integers(frame, quoted(vec_id), quoted(vector)), "vectors")
    fit = fit_whitening(packed, count, guard)
    width = len(fit.values)
    rows = whitened_rows(packed, fit)
    error = identity_error(rows, fit.n, width) if width else 0.0
    spec = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    explained, n = fit.values / (fit.trace or 1.0), fit.n

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not width:
                continue
            for start in range(0, batch.num_rows, ROWS):
                piece = batch.slice(start, ROWS)
                size = piece.num_rows
                w = np.frombuffer(b"".join(piece.column(2).to_pylist()), np.float64)
                twice = pa.array(np.repeat(np.arange(size), width))
                yield batch_of(arrow_schema(spec), [
                    piece.column(0).take(twice), np.tile(np.arange(1, width + 1, dtype=np.int32), size), np.full(size * width, n),
                    piece.column(1).take(twice), w, np.tile(explained, size), np.full(size * width, error)])

    return rows.mapInArrow(unfold, spec)

"""Approximate nearest neighbours over learned partitions of a neighbour graph.

The index is learned on a bounded sample (``SAMPLE`` vectors with the smallest hashed
ids): the sample's exact neighbour graph is cut into balanced parts by recursive
spectral bisection with swap refinement, so that few neighbours are separated, and a
small network learns to tell a vector's part.  Every row is indexed in its most
probable part.  A query goes to its most probable parts, as many as the sample needs
for ``RECALL`` of its true neighbours, and is ranked there by exact inner products in
double precision.  The number of parts grows with the table.

Parts are dealt in blocks of bounded size to tasks, so a part that one much repeated
vector fills is shared out, and so is an id with many vectors; inside a block only as many copies of a
vector are kept as can be among the nearest, counted by distinct ids.  Recall against brute force is part of the tests.

Rows with null id or with a vector that is null, zero, of another length than most, or
holds null or non-finite components take no part.  Ties go to the smaller id.  A query
never finds rows with its own id; a repeated id is found once, with its best score.
With fewer candidates than asked for all are returned; an empty table gives no row.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_schema, batch_of, bounded_sample, materialise, packed

#: Vectors the index is learned on, neighbours in its graph, recall wanted on it.
SAMPLE, LINKS, RECALL = 8192, 10, 0.97
#: Rows per part aimed at, least and most parts (powers of two), rows of a block.
PART_ROWS, LEAST_PARTS, MOST_PARTS, BLOCK = 4096, 16, 256, 4096
HIDDEN, EPOCHS, RATE = 128, 25, 3e-3

VECTORS = "vec_id long, vector binary, part int"
ROUTED = "query_id long, vector binary, parts array<int>"
FOUND = "query_id long, vec_id long, score double"


@dataclass
class Index:
    """A network of one hidden layer that gives a vector's part, and how many parts to search."""

    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray
    probes: int

    @property
    def parts(self) -> int:
        return len(self.second_bias)

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        return np.maximum(x @ self.first + self.first_bias, 0) @ self.second + self.second_bias


def usable(vectors: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows take part, and their vectors in double precision."""
    vectors = vectors.cast(pa.list_(pa.float64()))
    sizes = np.nan_to_num(np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), float), nan=-1)
    rows = np.flatnonzero(sizes == dimension)
    flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), dimension)
    good = np.isfinite(flat).all(axis=1) & (flat != 0).any(axis=1)
    return rows[good], flat[good]


def neighbour_graph(x: np.ndarray, links: int) -> np.ndarray:
    """The ``links`` rows of largest inner product of each row, in blocks."""
    links = min(links, len(x) - 1)
    out = np.zeros((len(x), links), np.int64)
    for start in range(0, len(x), 1024):
        scores = x[start:start + 1024] @ x.T
        scores[np.arange(len(scores)), np.arange(start, start + len(scores))] = -np.inf
        out[start:start + 1024] = np.argpartition(-scores, links - 1, axis=1)[:, :links]
    return out


def bisect(nodes: np.ndarray, sources: np.ndarray, targets: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Halve ``nodes`` so that few of the given links are cut: second eigenvector, then swaps."""
    place = {int(v): i for i, v in enumerate(nodes)}
    size = len(nodes)
    a = np.array([place[int(v)] for v in sources], np.int64)
    b = np.array([place[int(v)] for v in targets], np.int64)
    degree = np.maximum(np.bincount(a, minlength=size) + np.bincount(b, minlength=size), 1).astype(float)
    scale = 1 / np.sqrt(degree)
    constant = np.sqrt(degree) / np.linalg.norm(np.sqrt(degree))
    spread = lambda v: np.bincount(a, v[b], size) + np.bincount(b, v[a], size)
    value = rng.standard_normal(size)
    for _ in range(80):
        value = value + scale * spread(scale * value)
        value -= constant * (constant @ value)
        value /= max(np.linalg.norm(value), 1e-12)
    side = np.zeros(size)
    side[np.argsort(value * scale, kind="stable")[size // 2:]] = 1
    for _ in range(20):
        gain = np.where(side == 1, -1, 1) * (2 * spread(side) - (spread(np.ones(size))))
        zero, one = (np.flatnonzero(side == s) for s in (0, 1))
        zero, one = zero[np.argsort(-gain[zero], kind="stable")], one[np.argsort(-gain[one], kind="stable")]
        both = min(len(zero), len(one))
        swaps = int(((gain[zero[:both]] + gain[one[:both]]) > 0).sum() // 2)
        if not swaps:
            break
        old, cut = side.copy(), (side[a] != side[b]).sum()
        side[zero[:swaps]], side[one[:swaps]] = 1, 0
        if (side[a] != side[b]).sum() >= cut:
            side = old
            break
    return nodes[side == 0], nodes[side == 1]


def balanced_parts(graph: np.ndarray, parts: int) -> np.ndarray:
    """Part of each node after recursive halving."""
    rng = np.random.default_rng(7)
    sources, targets = np.repeat(np.arange(len(graph)), graph.shape[1]), graph.ravel()
    label = np.zeros(len(graph), np.int64)
    groups = [np.arange(len(graph))]
    while len(groups) < parts:
        halves = []
        for nodes in groups:
            inside = np.zeros(len(graph), bool)
            inside[nodes] = True
            kept = inside[sources] & inside[targets]
            halves += bisect(nodes, sources[kept], targets[kept], rng) if len(nodes) > 1 else (nodes, nodes[:0])
        groups = halves
    for number, nodes in enumerate(groups):
        label[nodes] = number
    return label


def learn(x: np.ndarray, parts: int) -> Index:
    """Partition the sample's graph, train the network, and find how many parts to search."""
    rng = np.random.default_rng(11)
    dimension = x.shape[1]
    if len(x) < 4 * parts:
        return Index(np.zeros((dimension, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    graph = neighbour_graph(x, LINKS)
    label = balanced_parts(graph, parts)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    weights = [rng.standard_normal((dimension, HIDDEN)) * np.sqrt(2 / dimension), np.zeros(HIDDEN),
               rng.standard_normal((HIDDEN, parts)) * np.sqrt(1 / HIDDEN), np.zeros(parts)]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for start in range(0, len(x), 256):
            rows = order[start:start + 256]
            hidden = np.maximum(unit[rows] @ weights[0] + weights[1], 0)
            out = hidden @ weights[2] + weights[3]
            chance = np.exp(out - out.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(rows)), label[rows]] -= 1
            chance /= len(rows)
            back = (chance @ weights[2].T) * (hidden > 0)
            slopes = [unit[rows].T @ back, back.sum(axis=0), hidden.T @ chance, chance.sum(axis=0)]
            step += 1
            for w, m, s, g in zip(weights, mean, square, slopes):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    index = Index(*weights, probes=parts)
    # Where the sample's neighbours are indexed, in the order a query would search.
    logits = index.logits(x)
    home = logits.argmax(axis=1)
    rank = np.argsort(np.argsort(-logits, axis=1), axis=1)
    needed = rank[np.repeat(np.arange(len(x)), graph.shape[1]), home[graph.ravel()]]
    reached = np.cumsum(np.bincount(needed, minlength=parts)) / len(needed)
    # A vector's own neighbours shaped its part, so the sample flatters: one more part is searched.
    index.probes = min(parts, int(np.searchsorted(reached, RECALL)) + 2)
    return index


def _index_rows(index: Index, dimension: int):
    schema = arrow_schema(VECTORS)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = usable(batch.column("embedding"), dimension)
            part = index.logits(x).argmax(axis=1).astype(np.int32)
            yield batch_of(schema, [batch.column("vec_id").take(pa.array(rows)), packed(list(x)), part])
    return assign


def _route(index: Index, dimension: int):
    schema = arrow_schema(ROUTED)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = usable(batch.column("embedding"), dimension)
            best = np.argsort(-index.logits(x), axis=1, kind="stable")[:, :index.probes].astype(np.int32)
            yield batch_of(schema, [batch.column("vec_id").take(pa.array(rows)), packed(list(x)), list(best)])
    return route


def _rank(dimension: int, count: int):
    schema = arrow_schema(FOUND)

    def rank(queries, rows):
        q, x = (np.frombuffer(b"".join(t.column("vector").to_pylist())).reshape(-1, dimension) for t in (queries, rows))
        query_ids, ids = queries.column("query_id").to_numpy(), rows.column("vec_id").to_numpy()
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(q) and len(x):
            # Of equal vectors the smallest ids suffice: one may be the query, the others fill the list.
            # Rows are distinct here, so these are as many ids.
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            repeated = bool((ids[1:] == ids[:-1]).any())
            _, group = np.unique(np.ascontiguousarray(x).view(f"V{8 * dimension}").ravel(), return_inverse=True)
            by_group = np.argsort(group, kind="stable")
            starts = np.searchsorted(group[by_group], group[by_group])
            kept = np.sort(by_group[np.arange(len(ids)) - starts <= count])
            ids, x = ids[kept], x[kept]
            for start in range(0, len(q), 512):
                part = q[start:start + 512]
                rough = part @ x.T
                slack = 1e-9 * (1 + np.abs(rough).max())
                best_of = rough
                if repeated:  # one score an id, its best
                    best_of = np.maximum.reduceat(rough, np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])), axis=1)
                least = max(0, best_of.shape[1] - count - 1)
                nth = np.partition(best_of, least, axis=1)[:, least]
                for k in range(len(part)):
                    near = np.flatnonzero(rough[k] >= nth[k] - slack)
                    near = near[ids[near] != query_ids[start + k]]
                    exact = (x[near] * part[k]).sum(axis=1)  # one order of addition whatever the block
                    best = np.lexsort((ids[near], -exact))
                    if repeated:
                        best = best[np.sort(np.unique(ids[near[best]], return_index=True)[1])]
                    best = best[:count]
                    out.append((np.full(len(best), query_ids[start + k]), ids[near[best]], exact[best]))
        columns = [np.concatenate([o[c] for o in out]) if out else np.zeros(0) for c in range(3)]
        return pa.table([pa.array(c.astype(t), f.type) for c, t, f in zip(columns, (np.int64, np.int64, float), schema)], schema=schema)
    return rank


def build_index(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[Index, int]:
    """Learn the index on the bounded sample; returns it with the vectors' length."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding")).where(
        "vec_id is not null and size(embedding) > 0")
    sizes = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    if not sizes:
        return Index(np.zeros((1, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1), 1
    dimension = sizes[0]["size"]
    total = sizes[0]["count"]
    whole = rows.where(F.size("embedding") == dimension)
    ids = bounded_sample(whole.select("vec_id"), "vec_id", SAMPLE).distinct()
    sample = whole.join(F.broadcast(ids), "vec_id").orderBy("vec_id").limit(SAMPLE).select("embedding").toArrow()
    _, x = usable(sample.column("embedding").combine_chunks(), dimension)
    x = np.unique(x, axis=0) if len(x) else x  # much repeated vectors count once in the graph
    parts = int(np.clip(2 ** round(np.log2(max(total / PART_ROWS, 1))), LEAST_PARTS, MOST_PARTS))
    return learn(x, parts), dimension


def nearest_neighbours(vectors: DataFrame, count: int = 20, every: int = 20, vec_id: str = "vec_id",
                       embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: nearest rows of each row whose id is divisible by ``every``."""
    index, dimension = build_index(vectors, vec_id, embedding)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding")).where("vec_id is not null")
    # A repeated row is one candidate; the aggregation is partial before the exchange, so a hot id is no hot task.
    placed = materialise(rows.mapInArrow(_index_rows(index, dimension), VECTORS).distinct(), "vectors")
    sizes = placed.groupBy("part").agg(F.expr(f"int(ceil(count(*) / {BLOCK}))").alias("blocks"))
    candidates = placed.join(F.broadcast(sizes), "part").select(
        "part", F.pmod(F.xxhash64("vec_id", "vector"), F.col("blocks")).cast("int").alias("block"), "vec_id", "vector")
    routed = rows.where(F.col("vec_id") % every == 0).mapInArrow(_route(index, dimension), ROUTED)
    queries = routed.select("query_id", "vector", F.explode("parts").alias("part")).join(F.broadcast(sizes), "part").select(
        "part", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "query_id", "vector")
    found = queries.groupBy("part", "block").cogroup(candidates.groupBy("part", "block")).applyInArrow(
        _rank(dimension, count), FOUND)
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count).select(
        "query_id", "rank", "vec_id", "score")

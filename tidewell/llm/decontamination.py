"""Benchmark decontamination by latent semantic retrieval and verification.

Benchmark items, cut into parts of at most ``PART`` words, are the queries.  Document
passages are overlapping windows; an item part is sought among the windows of its own length.

1. IDF weights come from the frequencies of all words of the corpus (a table of fixed size).
2. A span (a window and half its length on either side) can hold the wanted share of a part's words
   in order only if, of any so many rarest words of the part, it holds enough; prefix sums
   count them for every span, over all parts of a length together, and only spans that pass are kept.
3. A randomised singular value decomposition of the weighted matrix of kept spans and
   benchmark parts gives the latent space: the tasks multiply their spans with a random
   matrix and only the sums of fixed size meet.  Candidates are pairs where the inner product of latent
   images, and at most the product of what the two lose in the projection, reaches the least weight
   of the words wanted; the words themselves are then counted.
   None of these steps loses a pair that step 4 accepts, whatever the weights and the rank.
4. Candidates are verified by the longest common subsequence of words, computed for all
   pairs of a batch at once in the bits of integers.  ``COPY`` of the part's words in order is a
   copy; a smaller share, from ``PARAPHRASE`` on, counts only if the part's answer (its last
   quarter) is there too by ``ANSWER``.

Words are compared without ASCII marks around them and in lower case.  The benchmark is
the stated query set; its size is checked before it is sent to the tasks.  Null or empty
items match nothing; repeated items give equal matches.  Null and empty texts are clean; rows
with null id are never matched.  Documents with the same id share the verdict.  Other columns
stay as they are.  Empty tables give empty results.  Whole texts are searched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_schema, batch_of, materialise, packed, quoted, runs, slices, strings, unpacked, unused
from tidewell.llm.rarity import COUNTS_DDL, counted, rarity_table
from tidewell.llm.toxicity import bare_words

PART, LEAST_WORDS = 60, 5
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.75
#: Dimensions of the latent space and of the random matrix beyond them.
RANK, EXTRA = 256, 16
#: Rows of that length that a task multiplies at a time, but for the rest of a run.
PRODUCTS = 8192
BUCKETS = 1 << 20
#: Bytes of benchmark text that may be sent to every task.
BENCHMARK_BYTES = 64 << 20

#: ``words`` of a passage: from where to where the window is in the span, then numbers of the span's known words.
PASSAGES = "doc_id long, scale int, start int, words binary, norm double"
MATCHES = "doc_id long, item_id long, part int, start int, cosine double, shared double, answer double"


@dataclass
class Part:
    """A query: words of an item in order."""

    item_id: int
    number: int
    words: np.ndarray

    @property
    def scale(self) -> int:
        return len(self.words)


def lowered(texts: pa.Array) -> pa.Array:
    """Non-null texts in lower case, beyond ASCII too."""
    return pc.utf8_lower(strings(texts))


def parts_of(items: list[tuple[int, str]]) -> list[Part]:
    """Items as queries; long items are cut evenly."""
    out = []
    for item_id, text in items:
        _, words, _ = bare_words(lowered(pa.array([text], pa.string())))
        if len(words) >= LEAST_WORDS:
            for number, piece in enumerate(np.array_split(words, -(-len(words) // PART))):
                out.append(Part(item_id, number, piece))
    return out


def wanted(share: float, size: int) -> int:
    """Least number of words that is ``share`` of ``size`` words."""
    return next(k for k in range(size + 1) if k / size >= share)


class Weights:
    """IDF weights of words from the table of frequencies, and the numbers of the benchmark's words.

    Weights are square roots of the usual ones, so that a rare word beside a copied passage
    of plain words does not outweigh it.
    """

    def __init__(self, ranks: np.ndarray, parts: list[Part]):
        count = 2.0 ** (ranks.astype(np.float32) / 8)
        self.idf = np.sqrt(np.log1p(count.max() / np.maximum(count, 1))).astype(np.float32)
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *(p.words for p in parts)]))
        #: For each length of parts: numbers of words a span must hold and which words count (the last entry is for other words).
        self.held: dict[int, list[tuple[int, np.ndarray]]] = {}
        for p in parts:
            need, number = wanted(PARAPHRASE, p.scale), np.searchsorted(self.vocabulary, p.words)
            rarest = number[np.argsort(-self.of(p.words), kind="stable")]
            levels = dict.fromkeys(max(1, need * k // 6) for k in (2, 3, 4, 1, 5, 6))
            masks = self.held.setdefault(p.scale, [(k, np.zeros(len(self.vocabulary) + 1, bool)) for k in levels])
            for k, mask in masks:  # at most scale - need words are missing, so k of these are there
                mask[rarest[:p.scale - need + k]] = True

    def of(self, words: np.ndarray) -> np.ndarray:
        return self.idf[(words & np.uint64(BUCKETS - 1)).astype(np.int64)]

    def number(self, words: np.ndarray) -> np.ndarray:
        """Number of each word in the benchmark's vocabulary, -1 for others."""
        if not len(self.vocabulary):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at, -1)


def _windows(weights):
    schema = arrow_schema(PASSAGES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w: Weights = weights.value
        for batch in batches:
            for piece in slices(batch, "text"):
                found, words, _ = bare_words(lowered(piece.column("text")))
                ids = piece.column("doc_id").to_numpy()
                whole_sum = np.concatenate([[0], np.cumsum(w.of(words).astype(np.float64) ** 2)])
                number = w.number(words)
                before = np.concatenate([[0], np.cumsum(number >= 0)])
                number = number[number >= 0].astype(np.int32)
                counts = found.counts
                for scale, masks in w.held.items():
                    stride = max(1, scale // 4)
                    windows = np.where(counts > 0, np.maximum(-(-(counts - scale) // stride), 0) + 1, 0)
                    text = np.repeat(np.arange(len(counts)), windows)
                    start = found.offsets[:-1][text] + stride * (np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows))
                    stop = np.minimum(start + scale, found.offsets[1:][text])
                    # Some words around the window, for an item that sticks out.
                    first = before[np.maximum(start - 2 * stride, found.offsets[:-1][text])]
                    last = before[np.minimum(stop + 2 * stride, found.offsets[1:][text])]
                    kept = np.arange(len(text))
                    for least, mask in masks:
                        f, size = first[kept], last[kept] - first[kept]
                        ends = np.cumsum(size)
                        if len(kept) and ends[-1] < len(number):  # few are left: only their words are looked up
                            sums = np.concatenate([[0], np.cumsum(mask[number[np.repeat(f - (ends - size), size) + np.arange(ends[-1])]])])
                            f = ends - size
                        else:
                            sums = np.concatenate([[0], np.cumsum(mask[number])])
                        kept = kept[sums[f + size] - sums[f] >= least]
                    if len(kept):
                        start, stop, first, last, text = start[kept], stop[kept], first[kept], last[kept], text[kept]
                        spans = [np.concatenate([np.array([a - f, b - f], np.int32), number[f:z]]) for a, b, f, z in zip(before[start], before[stop], first, last)]
                        yield batch_of(schema, [ids[text], np.full(len(kept), scale, np.int32), (start - found.offsets[:-1][text]).astype(np.int32),
                                                packed(spans), np.sqrt(whole_sum[stop] - whole_sum[start])])
    return cut


def passage_rows(batch: pa.RecordBatch, weights: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of spans over the benchmark's vocabulary, each word once: row, column, weight."""
    spans = [s[2:] for s in unpacked(batch.column("words"), np.int32)]
    size = len(weights.vocabulary)
    keys, _ = counted_words(spans, size)
    row, column = keys // size, keys % size
    return row, column, weights.of(weights.vocabulary[column])


def counted_words(spans: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of each span as ascending ``span * size + word``, and how often they are there."""
    words = np.concatenate([np.zeros(0, np.int64), *spans])
    return np.unique(np.repeat(np.arange(len(spans)), [len(s) for s in spans]) * size + words, return_counts=True)


def times_there(keys: np.ndarray, counts: np.ndarray, span: np.ndarray, words: np.ndarray, size: int) -> np.ndarray:
    """How often each of a row of words is in the span of that row; ``words`` of -1 are nowhere."""
    if not len(keys):
        return np.zeros(words.shape, np.int64)
    asked = span[:, None] * size + words
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where((words >= 0) & (keys[at] == asked), counts[at], 0)


def times(row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int, matrix: np.ndarray) -> np.ndarray:
    """Product of the sparse rows with a dense matrix; ``row`` ascends."""
    out = np.zeros((rows, matrix.shape[1]), np.float32)
    add_runs(out, row, column, value, matrix)
    return out


def add_runs(out: np.ndarray, row: np.ndarray, column: np.ndarray, value: np.ndarray, matrix: np.ndarray) -> None:
    """Adds ``matrix[column] * value``, summed by ``row``, to the rows of ``out``; a bounded number of products at a time."""
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    for a, b in runs(first // PRODUCTS):
        start, stop = first[a], first[b] if b < len(first) else len(row)
        out[row[first[a:b]]] += np.add.reduceat(matrix[column[start:stop]] * value[start:stop, None], first[a:b] - start, axis=0)


def _range_rows(weights, random_: np.ndarray):
    """Sums of A'(A random) over the passages of a task, one row per block of the vocabulary."""
    schema = arrow_schema("block int, part binary")
    block = 512

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w: Weights = weights.value
        total = np.zeros((len(w.vocabulary), random_.shape[1]), np.float64)
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                row, column, value = passage_rows(part, w)
                image = times(row, column, value, part.num_rows, random_)
                order = np.argsort(column, kind="stable")
                add_runs(total, column[order], row[order], value[order], image)
        held = [k for k in range(0, len(total), block) if total[k:k + block].any()]
        yield batch_of(schema, [[k // block for k in held], packed([total[k:k + block].astype(np.float32) for k in held])])
    return multiply


def _sum_blocks(key, group):
    parts = [np.frombuffer(p, np.float32).astype(np.float64) for p in group.column("part").to_pylist()]
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([sum(parts).astype(np.float32).tobytes()], pa.binary())})


def part_matrix(parts: list[Part], weights: Weights) -> np.ndarray:
    """TF-IDF rows of the benchmark parts over their vocabulary."""
    out = np.zeros((len(parts), len(weights.vocabulary)), np.float32)
    for k, p in enumerate(parts):
        np.add.at(out[k], weights.number(p.words), weights.of(p.words))
    return out


def latent_space(passages: DataFrame, weights, parts: list[Part]) -> np.ndarray:
    """Orthonormal basis of the leading right singular space, one row per word of the benchmark.

    The benchmark parts belong to the collection, weighted like the corpus's passages taken
    together, so that every query has its image there.  Vocabulary times rank numbers reach the driver.
    """
    w: Weights = weights.value
    size = len(w.vocabulary)
    random_ = np.random.default_rng(3).standard_normal((size, min(RANK + EXTRA, size))).astype(np.float32)
    own = part_matrix(parts, w)
    total = np.zeros(random_.shape, np.float64)
    sums = passages.mapInArrow(_range_rows(weights, random_), "block int, part binary").groupBy("block").applyInArrow(
        _sum_blocks, "block int, part binary")
    for row in sums.toLocalIterator():
        held = np.frombuffer(row.part, np.float32).reshape(-1, random_.shape[1])
        total[row.block * 512:row.block * 512 + len(held)] = held
    query = own.T @ (own @ random_)
    scale = np.linalg.norm(total) / max(np.linalg.norm(query), 1e-12)
    basis, _ = np.linalg.qr(total + max(scale, 1.0) * query)
    return basis[:, :min(RANK + EXTRA, size)].astype(np.float32)


def common_subsequences(pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Length of the longest common subsequence of each (passage, query), queries of up to 64 words.

    All pairs advance together, one passage word a step; a bit per query word.
    """
    if not pairs:
        return np.zeros(0, np.int64)
    longest, width = max(len(p) for p, _ in pairs), max(len(q) for _, q in pairs)
    passage = np.zeros((len(pairs), longest), np.uint64)
    query = np.zeros((len(pairs), width), np.uint64)
    for k, (p, q) in enumerate(pairs):
        passage[k, :len(p)], query[k, :len(q)] = p, q
    bits = np.uint64(1) << np.arange(width, dtype=np.uint64)
    free = np.full(len(pairs), ~np.uint64(0))
    for step in range(longest):
        word = passage[:, step]
        match = np.where((query == word[:, None]) & (word != 0)[:, None], bits, np.uint64(0))
        match = np.bitwise_or.reduce(match, axis=1)
        hit = free & match
        free = (free + hit) | (free & ~match)
    size = np.array([len(q) for _, q in pairs], np.uint64)
    mask = np.where(size >= 64, ~np.uint64(0), (np.uint64(1) << np.minimum(size, np.uint64(63))) - np.uint64(1))
    return np.bitwise_count(~free & mask).astype(np.int64)


def residuals(square: np.ndarray, images: np.ndarray) -> np.ndarray:
    """Norms of what is left of vectors of the given squared norms outside the latent space, rounded up."""
    return np.sqrt(np.maximum(square - (images.astype(np.float64) ** 2).sum(axis=1), 0) + 1e-5 * square)


def _matches(weights, parts: list[Part], basis: np.ndarray):
    schema = arrow_schema(MATCHES)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w: Weights = weights.value
        size = len(w.vocabulary)
        by_scale: dict[int, np.ndarray] = {s: np.array([k for k, p in enumerate(parts) if p.scale == s]) for s in w.held}
        number = np.full((len(parts), PART), -1)
        for k, p in enumerate(parts):
            number[k, :p.scale] = w.number(p.words)
        weight = np.where(number >= 0, w.of(w.vocabulary[number]), 0).astype(np.float64)
        row, place = np.nonzero(number >= 0)
        images = times(row, number[row, place], weight[row, place].astype(np.float32), len(parts), basis)
        scale = np.array([p.scale for p in parts])
        need, copy = (np.array([wanted(share, n) for n in scale]) for share in (PARAPHRASE, COPY))
        last = np.maximum(1, scale // 4)
        least = np.array([wanted(ANSWER, n) for n in last])
        answer_word = (np.arange(PART) >= (scale - last)[:, None]) & (number >= 0)
        # The lightest words of a part that are enough.
        floor = np.array([np.sort(weight[k, :n] ** 2)[:m].sum() for k, (n, m) in enumerate(zip(scale, need))])
        square = np.array([(np.bincount(np.unique(number[k, :n], return_inverse=True)[1], weight[k, :n]) ** 2).sum() for k, n in enumerate(scale)])
        norms, lost = np.sqrt(square), residuals(square, images)
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                rows = batch.slice(start, 2000)
                held = unpacked(rows.column("words"), np.int32)
                spans = [s[2:] for s in held]
                keys, counts = counted_words(spans, size)
                inner = counted_words([s[2 + s[0]:2 + s[1]] for s in held], size)
                row, column = keys // size, keys % size
                value = w.of(w.vocabulary[column])
                image = times(row, column, value, rows.num_rows, basis)
                beyond = residuals(np.bincount(row, value.astype(np.float64) ** 2, rows.num_rows), image)
                scales, norm = rows.column("scale").to_numpy(), np.maximum(rows.column("norm").to_numpy(), 1e-12)
                for s in np.unique(scales):
                    here, there = np.flatnonzero(scales == s), by_scale[s]
                    bound = image[here] @ images[there].T + beyond[here, None] * lost[there]
                    a, b = np.nonzero(bound >= floor[there] * (1 - 1e-4))
                    a, b = here[a], there[b]
                    for k in range(0, len(a), 4000):
                        x, y = a[k:k + 4000], b[k:k + 4000]
                        hit = times_there(keys, counts, x, number[y], size) > 0
                        some = hit.sum(axis=1)
                        good = (some >= copy[y]) | ((some >= need[y]) & ((hit & answer_word[y]).sum(axis=1) >= least[y]))
                        x, y = x[good], y[good]
                        # Word numbers from 1: zero is no word.
                        shared = common_subsequences([(spans[i] + 1, number[j, :s] + 1) for i, j in zip(x, y)]) / scale[y]
                        answer = common_subsequences([(spans[i] + 1, number[j, s - last[j]:s] + 1) for i, j in zip(x, y)]) / last[y]
                        good = (shared >= COPY) | ((shared >= PARAPHRASE) & (answer >= ANSWER))
                        x, y, shared, answer = x[good], y[good], shared[good], answer[good]
                        if len(x):
                            cosine = (times_there(*inner, x, number[y], size) * weight[y] ** 2).sum(axis=1) / norms[y] / norm[x]
                            yield batch_of(schema, [rows.column("doc_id").take(pa.array(x)), [parts[j].item_id for j in y], [parts[j].number for j in y],
                                                    rows.column("start").take(pa.array(x)), cosine, shared, answer])
    return match


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, cosine, shared, answer: verified items of each document, with the best evidence."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).where(
        "item_id is not null and text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > BENCHMARK_BYTES:
        raise ValueError(f"the benchmark holds {size} bytes of text; search it in parts of up to {BENCHMARK_BYTES}")
    parts = parts_of([(r.item_id, r.text) for r in items.distinct().collect()])
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where(
        "doc_id is not null and text is not null")
    if not parts:
        return spark.createDataFrame([], "doc_id long, item_id long, cosine double, shared double, answer double")
    words = lambda b: (bare_words(lowered(p.column("text")))[1] for p in slices(b, "text"))
    ranks = rarity_table(plain.select("text").mapInArrow(counted(words, BUCKETS), COUNTS_DDL), BUCKETS)
    weights = spark.sparkContext.broadcast(Weights(ranks, parts))
    passages = materialise(plain.mapInArrow(_windows(weights), PASSAGES), "passages")
    basis = latent_space(passages, weights, parts)
    found = passages.mapInArrow(_matches(weights, parts, basis), MATCHES)
    return found.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("shared").alias("shared"), F.max("answer").alias("answer"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns stay."""
    leaked = unused(docs, "leaked")
    found = benchmark_matches(docs, benchmark, doc_id, text).select(F.col("doc_id").alias(leaked)).distinct()
    return docs.join(found, F.col(quoted(doc_id)).cast("long") == F.col(leaked), "left_anti")

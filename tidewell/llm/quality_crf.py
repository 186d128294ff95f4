"""Document quality from a linear-chain conditional random field over lines.

Every line gets binned surface features of itself and of its two neighbours; the
chain's two states are bad and good.  The field is trained by penalised likelihood on
a bounded sample of labelled documents (``TRAIN_DOCS``, the ones with the smallest
hashed ids), each line carrying its document's label.  A document's quality is the
length-weighted mean of the lines' forward-backward marginals, put on the label's
scale by a logistic fit on the same sample.  Labels, language, source and id enter no
score; only the training rows are chosen by id.

Every line of every text is scored.  Null and empty texts have no line: their score
is the share of good documents in training.  Rows with null id are scored, their fold
is not the held-out one, and they never train.  Repeated labels of a document train
only if they agree; repeated documents get equal rows.  Without any usable label all
scores are 0.5.  Long texts are chains of many lines, a very long line is one step.
Ties of score and threshold count as good.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_schema, batch_of, bounded_sample, bytes_of, fold, packed, slices, strings, words_in

#: Documents the field is trained on, at most; optimiser steps; penalty on weights.
TRAIN_DOCS, STEPS, PENALTY = 3000, 60, 0.3
#: Upper bin bounds of shares; the last bin is open.
SHARES = np.array([0.0, 0.02, 0.05, 0.1, 0.2, 0.35, 0.6])
BINS = len(SHARES) + 1
FEATURES = ("upper", "digit", "mark", "stop", "wide", "again", "repeat", "spread", "length", "word", "capital", "closed", "single")

_KIND = np.zeros(256, np.uint8)  # 1 lower, 2 upper, 3 digit, 4 sentence mark, 5 other mark, 6 beyond ASCII, 0 space
_KIND[[c for c in range(33, 127)]] = 5
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 1, 2, 3
_KIND[[ord(c) for c in ".,;:'\"?()-"]] = 4
_KIND[128:] = 6


def lines_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, bounds of their non-empty lines (starts, ends), and the text of each line."""
    data, bounds = bytes_of(texts)
    feeds = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([bounds[:-1][np.diff(bounds) > 0], feeds + 1]))
    starts = starts[starts < len(data)]
    ends = np.minimum(np.concatenate([starts[1:], [len(data)]]), np.append(feeds, len(data))[np.searchsorted(feeds, starts)])
    keep = ends > starts
    starts, ends = starts[keep], ends[keep]
    return data, np.stack([starts, ends]), np.searchsorted(bounds, starts, side="right") - 1


def binned(share: np.ndarray) -> np.ndarray:
    return np.searchsorted(SHARES, share, side="left").astype(np.int64)


def features(data: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """One bin number per line and feature."""
    starts, ends = lines
    size = np.maximum(ends - starts, 1)
    kinds = _KIND[data]
    share = {}
    for number, name in ((2, "upper"), (3, "digit"), (5, "mark"), (4, "stop"), (6, "wide")):
        sums = np.concatenate([[0], np.cumsum(kinds == number)])
        share[name] = (sums[ends] - sums[starts]) / size
    words = words_in(data, np.append(starts, len(data)))
    first = words.offsets[:-1]
    count = words.counts
    line = np.repeat(np.arange(len(starts)), count)
    same = np.zeros(len(line) + 1)
    if len(line) > 1:
        same[2:] = np.cumsum((words.hashes[1:] == words.hashes[:-1]) & (line[1:] == line[:-1]))
    share["repeat"] = (same[words.offsets[1:]] - same[first]) / np.maximum(count, 1)
    keys = np.sort((line.astype(np.uint64) << np.uint64(40)) | (words.hashes >> np.uint64(24)))
    fresh = np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)]
    kept = np.bincount((keys[fresh] >> np.uint64(40)).astype(np.int64), minlength=len(starts)) if len(keys) else np.zeros(len(starts))
    share["again"] = 1 - kept / np.maximum(count, 1)
    # Words that consist of marks around or inside: how many bytes of the words are no letters.
    letters = np.concatenate([[0], np.cumsum((kinds == 1) | (kinds == 2) | (kinds == 6))])
    bare = (letters[words.ends] - letters[words.starts]) * 10 < 8 * (words.ends - words.starts)
    spoiled = np.concatenate([[0], np.cumsum(bare)])
    share["spread"] = (spoiled[words.offsets[1:]] - spoiled[first]) / np.maximum(count, 1)
    columns = {name: binned(value) for name, value in share.items()}
    columns["length"] = np.minimum(np.log2(size).astype(np.int64) // 2, BINS - 1)
    columns["word"] = np.minimum(size // np.maximum(count, 1) // 2, BINS - 1)
    columns["capital"] = (kinds[np.minimum(starts, len(data) - 1)] % 7).astype(np.int64) if len(data) else size * 0
    columns["closed"] = (kinds[np.maximum(ends - 1, 0)] % 7).astype(np.int64) if len(data) else size * 0
    columns["single"] = np.minimum(count, BINS - 1)
    return np.stack([columns[name] for name in FEATURES], axis=1) if len(starts) else np.zeros((0, len(FEATURES)), np.int64)


def neighbourhood(bins: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Feature numbers of each line, its predecessor and its successor; one number stands for none."""
    own = bins + np.arange(bins.shape[1]) * BINS
    width = bins.shape[1] * BINS
    none = np.full((1, bins.shape[1]), 3 * width)
    before = np.concatenate([none, own[:-1] + width])[:len(own)]
    after = np.concatenate([own[1:] + 2 * width, none])[-len(own):] if len(own) else own
    starts = np.concatenate([[True], text[1:] != text[:-1]])[:len(own)]
    before[starts] = 3 * width
    after[np.append(starts[1:], True)[:len(own)]] = 3 * width
    return np.concatenate([own, before, after], axis=1)


@dataclass
class Field:
    """Weights of the features for state good, transition scores, and the scale of the document score."""

    weights: np.ndarray
    moves: np.ndarray
    scale: tuple[float, float]
    prior: float


def marginals(scores: np.ndarray, moves: np.ndarray, counts: np.ndarray):
    """P(good) per line, expected transitions, for chains of ``counts`` lines stored one after another.

    All chains advance together, longest first, one line a step.
    """
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    sizes = counts[order]
    local = np.stack([np.zeros(len(scores)), scores], axis=1)
    forward, backward = np.zeros_like(local), np.zeros_like(local)
    longest = int(sizes.max()) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")
    joint = np.zeros((2, 2))
    for step in range(longest):
        at = starts[:active[step]] + step
        if step == 0:
            value = local[at]
        else:
            value = np.logaddexp(forward[at - 1, 0][:, None] + moves[0], forward[at - 1, 1][:, None] + moves[1]) + local[at]
        forward[at] = value - np.logaddexp(value[:, 0], value[:, 1])[:, None]
    for step in range(longest - 2, -1, -1):
        at = starts[:active[step + 1]] + step
        ahead = backward[at + 1] + local[at + 1]
        value = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
        pair = forward[at][:, :, None] + moves[None] + ahead[:, None, :]
        pair = np.exp(pair - pair.max(axis=(1, 2), keepdims=True))
        joint += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        backward[at] = value - np.logaddexp(value[:, 0], value[:, 1])[:, None]
    total = forward + backward
    good = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -60, 60)))
    return good, joint


def train(chains: list[tuple[np.ndarray, np.ndarray, int]]) -> Field:
    """Fit the field on (feature numbers, line sizes, label) of each document."""
    labels = np.array([c[2] for c in chains], float)
    prior = float(labels.mean()) if len(labels) else 0.5
    chains = [c for c in chains if len(c[0])]
    width = 3 * len(FEATURES) * BINS + 1
    if not chains or prior in (0.0, 1.0):
        return Field(np.zeros(width), np.zeros((2, 2)), (0.0, np.log((prior + 1e-3) / (1 - prior + 1e-3))), prior)
    numbers = np.concatenate([c[0] for c in chains])
    counts = np.array([len(c[0]) for c in chains])
    sizes = np.concatenate([c[1] for c in chains]).astype(float)
    labels = np.array([c[2] for c in chains], float)
    wanted = np.repeat(labels, counts)
    seen = np.array([[np.sum((counts - 1)[labels == 0]), 0], [0, np.sum((counts - 1)[labels == 1])]], float)
    weights, moves = np.zeros(width), np.zeros((2, 2))
    mean, square = np.zeros(width + 4), np.zeros(width + 4)
    for step in range(1, STEPS + 1):
        good, joint = marginals(weights[numbers].sum(axis=1), moves, counts)
        gradient = np.bincount(numbers.ravel(), np.repeat(wanted - good, numbers.shape[1]), width) - PENALTY * weights
        both = np.concatenate([gradient, (seen - joint).ravel() - PENALTY * moves.ravel()]) / len(wanted)
        mean, square = 0.9 * mean + 0.1 * both, 0.99 * square + 0.01 * both ** 2
        move = 0.15 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
        weights, moves = weights + move[:width], moves + move[width:].reshape(2, 2)
    good, _ = marginals(weights[numbers].sum(axis=1), moves, counts)
    quality = weighted(good, sizes, counts)
    return Field(weights, moves, logistic(quality, labels), prior)


def weighted(good: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the lines' marginals per chain."""
    sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], np.cumsum(counts)])])
    return sums(good * sizes) / np.maximum(sums(sizes), 1)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a lightly penalised logistic fit, by Newton's method."""
    design = np.stack([x, np.ones(len(x))], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        move = np.linalg.solve(hessian, design.T @ (y - p) - 1e-2 * beta)
        beta += np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature numbers and sizes of the lines of each document."""
    schema = arrow_schema("label int, numbers binary, sizes binary")
    for batch in batches:
        for piece in slices(batch, "text"):
            data, lines, text = lines_of(strings(piece.column("text")))
            numbers = neighbourhood(features(data, lines), text).astype(np.int16)
            bounds = np.searchsorted(text, np.arange(piece.num_rows + 1))
            sizes = (lines[1] - lines[0]).astype(np.int32)
            yield batch_of(schema, [piece.column("label"), packed([numbers[a:b] for a, b in zip(bounds, bounds[1:])]),
                                    packed([sizes[a:b] for a, b in zip(bounds, bounds[1:])])])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Field:
    """Train on the rows of ``labels`` (already without held-out ones) that ``docs`` holds."""
    agreed = labels.select(F.col(doc_id).cast("long").alias("key"), F.col(label).cast("int").alias("label")).where(
        "key is not null and label is not null").groupBy("key").agg(
        F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    sample = bounded_sample(agreed, "key", TRAIN_DOCS)
    texts = docs.select(F.col(doc_id).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    rows = texts.join(F.broadcast(sample), "key").select("label", "text").mapInArrow(
        _chains, "label int, numbers binary, sizes binary").collect()
    width = 3 * len(FEATURES)
    return train([(np.frombuffer(r.numbers, np.int16).reshape(-1, width).astype(np.int64),
                   np.frombuffer(r.sizes, np.int32), r.label) for r in rows])


def _scores(field: Field):
    schema = arrow_schema("doc_id long, held_out boolean, score double, lines int, bad_lines int")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                data, lines, text = lines_of(strings(piece.column("text")))
                counts = np.bincount(text, minlength=piece.num_rows)
                numbers = neighbourhood(features(data, lines), text)
                good, _ = marginals(field.weights[numbers].sum(axis=1), field.moves, counts)
                slope, intercept = field.scale
                value = 1 / (1 + np.exp(-(slope * weighted(good, (lines[1] - lines[0]).astype(float), counts) + intercept)))
                value[counts == 0] = field.prior
                bad = np.bincount(text, good < 0.5, minlength=piece.num_rows)
                yield batch_of(schema, [piece.column("doc_id"), piece.column("held_out"), value,
                                        counts.astype(np.int32), bad.astype(np.int32)])
    return score


def _good(field: Field, text: str):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scores(field)
        for batch in batches:
            own = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), pa.array([False] * batch.num_rows), strings(batch.column(text))],
                                             ["doc_id", "held_out", "text"])
            value = np.concatenate([np.zeros(0), *(b.column("score").to_numpy() for b in score(iter([own])))])
            yield batch.filter(pa.array(value >= 0.5))
    return keep


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """``docs`` without the documents of poor quality; all columns stay, nothing is shuffled."""
    return docs.mapInArrow(_good(fit(docs, labels, doc_id, text, label), text), docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1,
                   doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted, lines, bad_lines for every row of ``docs``."""
    field = fit(docs, labels.where(fold(doc_id, modulus) != held), doc_id, text, label)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(fold(doc_id, modulus) == held, F.lit(False)).alias("held_out"),
                       F.col(text).cast("string").alias("text"))
    scored = rows.mapInArrow(_scores(field), "doc_id long, held_out boolean, score double, lines int, bad_lines int")
    return scored.withColumn("predicted", F.expr("int(score >= 0.5)"))

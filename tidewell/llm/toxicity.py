"""Toxic passages as maximum-scoring segments of token log-odds.

A token's score is the log-odds of its word between toxic and other training
documents under an informative Dirichlet prior (the words' frequency in all training
texts).  Words too rare for that take the score of their opening letters.  Tokens
without evidence cost a constant, so that the expected score of ordinary text is
negative.  A linear-time scan finds all maximal segments of a text; how surprising the
best ones are for a text of that length follows from the extreme-value law of segment
scores (expected number ``K n exp(-lambda S)``), whose lambda solves the characteristic
equation on ordinary training text.  A logistic fit on the training documents puts
that surprise on the label's scale.  Every segment of a text counts towards it; above ``MOST_SURPRISE`` it rises no more.
A text's score depends on that text and the model alone.

The lexicon is trained on a bounded sample (``TRAIN_DOCS`` labelled documents with the
smallest hashed ids; at most ``LEXICON`` units).  Every token of every text is scored;
labels, language, source and id enter no score.  Null and empty texts have no segment
and get the score of no evidence.  Rows with null id are scored and never train.
Contradicting repeated labels do not train; repeated rows get equal results.  Without
labels of both kinds every score is 0.  Segments of equal score are all kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_schema, batch_of, bounded_sample, fold, mix, packed, signed, slices, span_hashes, strings, words_of
from tidewell.llm.quality_crf import logistic

TRAIN_DOCS, LEXICON = 12000, 20000
#: Weight of the prior as a share of all tokens, least z-score of a unit, cost of a token without evidence.
PRIOR, LEAST_Z, COST = 0.03, 2.5, 0.25
#: Opening bytes of a word that stand for it where the word itself is too rare.
STEMS = (7, 6, 5, 4)
#: Segments expected less often than this per text are reported.
EXPECTED = 0.01
#: Surprise beyond this, a chance of 1e-60, counts as this.
MOST_SURPRISE = 60.0

SEGMENTS = "doc_id long, held_out boolean, n_tokens long, surprise double, n_segments int, starts binary, ends binary, sums binary"


@dataclass
class Model:
    """Sorted hashes of scored units and their scores, the law's constants, the scale of the result."""

    units: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0))
    rate: float = 1.0
    constant: float = 1.0
    scale: tuple[float, float] = (0.0, -30.0)


MARK = np.zeros(256, bool)
MARK[33:48] = MARK[58:65] = MARK[91:97] = MARK[123:127] = True


def bare_words(texts: pa.Array, sizes: tuple[int, ...] = ()):
    """Words of texts, hashes of the words without ASCII marks around them, and of their stems of given sizes."""
    words = words_of(texts)
    data = words.data
    starts, ends = words.starts.copy(), words.ends.copy()
    at = np.flatnonzero(MARK[data[starts]]) if len(starts) else starts
    for _ in range(4):
        at = at[(ends[at] - starts[at] > 1) & MARK[data[starts[at]]]]
        starts[at] += 1
    at = np.flatnonzero(MARK[data[ends - 1]]) if len(ends) else ends
    for _ in range(4):
        at = at[(ends[at] - starts[at] > 1) & MARK[data[ends[at] - 1]]]
        ends[at] -= 1
    whole, *heads = span_hashes(data, starts, ends, *(np.minimum(starts + size, ends) for size in sizes))
    stems = [np.where(ends - starts > size, mix(head + np.uint64(size)), np.uint64(0)) for size, head in zip(sizes, heads)]
    return words, whole, stems


def _unit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and stems in toxic and other texts; unit 0 counts all tokens."""
    schema = arrow_schema("unit long, toxic long, other long, stem int")
    for batch in batches:
        for piece in slices(batch, "text"):
            words, whole, stems = bare_words(strings(piece.column("text")), STEMS)
            line = np.repeat(np.arange(piece.num_rows), words.counts)
            label = piece.column("label").to_numpy()[line]
            for kind, units in enumerate([whole, *stems]):
                # A unit counts once a line, so that a word said over and over is one observation.
                _, once = np.unique(mix(units ^ mix(line.astype(np.uint64) + np.uint64(1))), return_index=True)
                if not kind:
                    yield batch_of(schema, [[0], [int(label[once].sum())], [int(len(once) - label[once].sum())], [0]])
                once = once[units[once] != 0]
                keys, place = np.unique(units[once], return_inverse=True)
                toxic = np.bincount(place, label[once], len(keys)).astype(np.int64)
                every = np.bincount(place, minlength=len(keys))
                yield batch_of(schema, [signed(keys), toxic, every - toxic, np.full(len(keys), kind, np.int32)])


def log_odds(toxic: np.ndarray, other: np.ndarray, all_toxic: float, all_other: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of each unit under a Dirichlet prior with its overall frequency, and its z-score."""
    prior, mass = PRIOR * (toxic + other), PRIOR * (all_toxic + all_other)
    odds = lambda y, n: np.log((y + prior) / np.maximum(n + mass - y - prior, 1e-9))
    delta = odds(toxic, all_toxic) - odds(other, all_other)
    return delta, delta / np.sqrt(1 / (toxic + prior) + 1 / (other + prior))


def token_scores(model: Model, whole: np.ndarray, stems: list[np.ndarray], first: np.ndarray) -> np.ndarray:
    """Score of each token: its word's, else the longest scored stem's, else the cost; ``first`` marks the texts' first tokens."""
    scores = np.full(len(whole), -COST)
    if not len(model.units):
        return scores
    for units in [*reversed(stems), whole]:
        at = np.minimum(np.searchsorted(model.units, units), len(model.units) - 1)
        hit = model.units[at] == units
        scores[hit] = model.scores[at[hit]]
    scores[1:][(whole[1:] == whole[:-1]) & ~first[1:]] = -COST  # said again at once: no new evidence
    return scores


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, sum) in time linear in the scores above zero.

    Each candidate remembers the prefix sum left of it and the one at its end; a new one is
    merged backwards over those it dominates.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    candidates: list[tuple[int, int, float, float]] = []
    for at in np.flatnonzero(scores > 0).tolist():
        start, left, right = at, float(sums[at]), float(sums[at + 1])
        while True:
            j = len(candidates) - 1
            while j >= 0 and candidates[j][2] >= left:
                j -= 1
            if j < 0 or candidates[j][3] >= right:
                break
            start, left = candidates[j][0], candidates[j][2]
            del candidates[j:]
        candidates.append((start, at + 1, left, right))
    return [(s, e, right - left) for s, e, left, right in candidates]


def surprise_of(segments: list[tuple[int, int, float]], tokens: int, model: Model) -> tuple[float, list]:
    """Surprise of a text, and its significant segments.

    The surprise is minus the log10 of the probability that ordinary text of this length
    has as many segments as good: the best over r of the r-th segment's Poisson tail.
    """
    if not segments or not tokens:
        return 0.0, []
    expected = np.log(model.constant * tokens) - model.rate * np.sort([s[2] for s in segments])[::-1]
    r = np.arange(1, len(segments) + 1)
    # P(Poisson(e) >= r) is close to e^r / r! for small e.
    tail = r * expected - np.cumsum(np.log(r))
    limit = np.log(EXPECTED)
    return (float(np.clip(-tail.min() / np.log(10), 0, MOST_SURPRISE)),
            [s for s in segments if np.log(model.constant * tokens) - model.rate * s[2] <= limit])


def _scan(model: Model, label: bool = False):
    schema = arrow_schema(SEGMENTS + (", label int" if label else ""))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                words, whole, stems = bare_words(strings(piece.column("text")), STEMS)
                first = np.zeros(len(whole) + 1, bool)
                first[words.offsets] = True
                scores = token_scores(model, whole, stems, first[:-1])
                held = np.add.reduceat(np.append(scores > 0, False), words.offsets[:-1]) * (words.counts > 0) if piece.num_rows else []
                surprise, found = np.zeros(piece.num_rows), [[] for _ in range(piece.num_rows)]
                for i in np.flatnonzero(held):
                    a, b = words.offsets[i], words.offsets[i + 1]
                    surprise[i], found[i] = surprise_of(maximal_segments(scores[a:b]), int(b - a), model)
                columns = [piece.column("doc_id"), piece.column("held_out"), words.counts, surprise,
                           [len(f) for f in found], packed([np.array([s[0] for s in f], np.int32) for f in found]),
                           packed([np.array([s[1] for s in f], np.int32) for f in found]),
                           packed([np.array([s[2] for s in f]) for f in found])]
                yield batch_of(schema, columns + ([piece.column("label")] if label else []))
    return scan


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Train on the rows of ``labels`` (already without held-out ones) that ``docs`` holds."""
    agreed = labels.select(F.col(doc_id).cast("long").alias("key"), F.col(label).cast("int").alias("label")).where(
        "key is not null and label is not null").groupBy("key").agg(
        F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    sample = bounded_sample(agreed, "key", TRAIN_DOCS)
    rows = docs.select(F.col(doc_id).cast("long").alias("key"), F.col(text).cast("string").alias("text")).join(
        F.broadcast(sample), "key").select(F.col("key").alias("doc_id"), F.lit(False).alias("held_out"), "label", "text")
    # Copies share their lines: each distinct line counts once per label, or copied words would look telling.
    lines = rows.select("label", F.explode(F.split("text", "\n")).alias("text")).distinct()
    counts = lines.mapInArrow(_unit_counts, "unit long, toxic long, other long, stem int").groupBy(
        "unit", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    # Only units seen several times and oftener than by chance in toxic texts can pass the z-score.
    kept = counts.where("unit = 0 or toxic >= 3").orderBy(
        F.expr("unit = 0").desc(), F.expr("toxic / (toxic + other + 3)").desc(), F.desc("toxic"), "unit").limit(4 * LEXICON).toPandas()
    total = kept[kept.unit == 0]
    model = Model()
    if not len(total) or not total.toxic.iloc[0] or not total.other.iloc[0]:
        return model
    all_toxic, all_other = float(total.toxic.iloc[0]), float(total.other.iloc[0])
    kept = kept[kept.unit != 0]
    delta, z = log_odds(kept.toxic.to_numpy(float), kept.other.to_numpy(float), all_toxic, all_other)
    good = np.flatnonzero((z >= LEAST_Z) & (delta > 1.0))
    good = good[np.argsort(-z[good], kind="stable")][:LEXICON]
    units = kept.unit.to_numpy(np.int64)[good].view(np.uint64)
    order = np.argsort(units)
    # Ordinary text: how often each unit occurs there fixes lambda.
    chance = (kept.other.to_numpy(float)[good] + 0.5) / (all_other + 1)
    model = Model(units[order], delta[good][order])
    model.rate = characteristic(delta[good], chance)
    model.constant = float(min(1.0, chance.sum() + 1e-6))
    seen = rows.mapInArrow(_scan(model, label=True), SEGMENTS + ", label int").select("surprise", "label").toPandas()
    model.scale = logistic(np.sqrt(seen.surprise.to_numpy(float)), seen.label.to_numpy(float))
    return model


def characteristic(scores: np.ndarray, chance: np.ndarray) -> float:
    """Lambda > 0 with expected exp(lambda * score) of one for ordinary tokens."""
    if not len(scores):
        return 1.0
    rest = max(1.0 - chance.sum(), 1e-9)
    value = lambda x: (chance * np.exp(np.minimum(x * scores, 700))).sum() + rest * np.exp(-x * COST) - 1
    low, high = 1e-6, 1.0
    while value(high) < 0 and high < 64:
        high *= 2
    if value(low) > 0:  # not negative on average: segments of ordinary text are long; be strict
        return 0.05
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return float(low)


def toxic_segments(docs: DataFrame, model: Model, modulus: int = 4, held: int = 2, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """One row per document with its score and its significant segments (token bounds, end excluded)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(fold(doc_id, modulus) == held, F.lit(False)).alias("held_out"),
                       F.col(text).cast("string").alias("text"))
    slope, intercept = model.scale
    scanned = rows.mapInArrow(_scan(model), SEGMENTS)
    return scanned.withColumn("score", F.expr(f"1 / (1 + exp(-({slope!r} * sqrt(surprise) + {intercept!r})))"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2, doc_id: str = "doc_id",
                    text: str = "text", label: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted, n_segments, surprise for every row of ``docs``."""
    model = fit(docs, labels.where(fold(doc_id, modulus) != held), doc_id, text, label)
    return toxic_segments(docs, model, modulus, held, doc_id, text).select(
        "doc_id", "held_out", "score", F.expr("int(score >= 0.3)").alias("predicted"), "n_segments", "surprise")

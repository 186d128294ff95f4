"""Toxicity scores depend on the document alone and equal a plain computation."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest

from tidewell.llm import toxicity
from tidewell.llm.toxicity import COST, EXPECTED, MOST_SURPRISE, STEMS, Model, bare_words

TEXTS = ["x y idiot", "idiot a b", "idiot", "idiot idiot idiot", "", "A b c d!", "stupid idiot moron and a b c d e f stupid", "(idiot), stupid.",
         "a b " * 40 + "moron " + "c d " * 40 + "stupid moron", "moron", " \n\t", "stupids stupid idiots", ("x y moron z " * 60).strip()]


@pytest.fixture(scope="module")
def model():
    units = np.concatenate([bare_words(pa.array([w]))[1] for w in ("idiot", "stupid", "moron")])
    order = np.argsort(units)
    return Model(units[order], np.array([5.0, 3.0, 2.0])[order], 0.9, 0.05, (2.0, -4.0))


def scanned(model, texts):
    rows = [(i, False, t) for i, t in enumerate(texts)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows], pa.string())],
                                       ["doc_id", "held_out", "text"])
    out = pa.Table.from_batches(list(toxicity._scan(model)(iter([batch])))).to_pydict()
    return list(zip(out["surprise"], out["n_segments"], out["sums"]))


def by_hand(model, text):
    """Surprise and number of significant segments from the definitions, word by word."""
    known = dict(zip(model.units.tolist(), model.scores.tolist()))
    scores, before = [], None
    for word in (text or "").split():
        _, whole, stems = bare_words(pa.array([word]), STEMS)
        hits = [known[int(u[0])] for u in (whole, *stems) if int(u[0]) in known]
        scores.append(-COST if int(whole[0]) == before or not hits else hits[0])
        before = int(whole[0])
    segments = []

    def split(a, b):
        """The best segment of a part, then the best of what lies left and right of it."""
        spans = [(sum(scores[i:j]), i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
        best = max(spans, default=(0, 0, 0), key=lambda s: (round(s[0], 9), s[1] - s[2]))
        if best[0] > 0:
            segments.append(best[0])
            split(a, best[1])
            split(best[2], b)

    split(0, len(scores))
    tail, n = 0.0, len(scores)
    ranked = sorted(segments, reverse=True)
    for r, score in enumerate(ranked, 1):
        tail = max(tail, -(r * (math.log(model.constant * n) - model.rate * score) - math.lgamma(r + 1)) / math.log(10))
    return min(tail, MOST_SURPRISE), sum(model.constant * n * math.exp(-model.rate * s) <= EXPECTED for s in ranked)


def test_a_text_scores_the_same_alone_and_in_any_company(model):
    alone = [scanned(model, [t])[0] for t in TEXTS]
    assert scanned(model, TEXTS) == alone
    rng = np.random.default_rng(0)
    for _ in range(20):
        order = rng.permutation(len(TEXTS) * 2) % len(TEXTS)
        assert scanned(model, [TEXTS[i] for i in order]) == [alone[i] for i in order]


def test_scores_equal_the_definition(model):
    for text, (surprise, count, _) in zip(TEXTS, scanned(model, TEXTS)):
        expected, n = by_hand(model, text)
        assert surprise == pytest.approx(expected, abs=1e-9) and count == n


def test_every_segment_counts(model):
    """Sixty mild passages are stronger evidence than twenty of them in a text of the same length."""
    few, many = ("x y z stupid " * 20 + "x y z x " * 40), "x y z stupid " * 60
    weak = Model(model.units, model.scores, 0.9, 0.1, model.scale)
    (low, *_), (high, *_) = scanned(weak, [few, many])
    assert high > low + 3 and high == pytest.approx(by_hand(weak, many)[0])


def test_partitioning_does_not_change_scores(spark):
    texts = [(i, TEXTS[i % len(TEXTS)] + (" idiot" if i % 7 == 0 else "")) for i in range(300)]
    labels = spark.createDataFrame([(i, int("idiot" in t)) for i, t in texts], "doc_id long, toxic int")
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    runs = [sorted((r.doc_id, round(r.score, 12)) for r in toxicity.toxicity_scores(f, labels).collect())
            for f in (frame.coalesce(1), frame.repartition(9), frame.orderBy("text"))]
    assert runs[0] == runs[1] == runs[2]
    same: dict[str, set] = {}
    for (_, score), (_, text) in zip(runs[0], texts):
        same.setdefault(text, set()).add(score)
    assert all(len(s) == 1 for s in same.values())

"""What the filters before the exact checks must not lose."""

from __future__ import annotations

import numpy as np

from tidewell.llm import decontamination, neighbours


def prose(rng: np.random.Generator, n: int) -> list[str]:
    """Words, two in five of them common."""
    return [f"v{i}" for i in np.where(rng.random(n) < 0.4, rng.integers(0, 30, n), rng.integers(30, 6000, n))]


def test_decontamination_beyond_the_rank(spark):
    """More benchmark parts than the latent space has dimensions: every exact copy is found, at any offset."""
    rng = np.random.default_rng(17)
    items = [prose(rng, int(rng.integers(15, 60))) for _ in range(700)]
    docs = [(k, " ".join(prose(rng, int(rng.integers(0, 40))) + item + prose(rng, 50))) for k, item in enumerate(items)]
    benchmark = spark.createDataFrame([(k, " ".join(item)) for k, item in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.benchmark_matches(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()}
    assert {(k, k) for k in range(700)} <= found


def in_order(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        old = 0
        for j, y in enumerate(b):
            old, row[j + 1] = row[j + 1], old + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def accepted(text: list[str], item: list[str], width: int) -> bool:
    """Whether any stretch of ``width`` words, at any place, passes the checks of words in order and answer."""
    answer = item[-max(1, len(item) // 4):]
    for k in range(max(1, len(text) - width + 1)):
        shared = in_order(text[k:k + width], item) / len(item)
        if shared >= 0.8 or shared >= 0.6 and in_order(text[k:k + width], answer) / len(answer) >= 0.75:
            return True
    return False


def test_decontamination_of_replaced_words(spark):
    """Paraphrases that keep 60 to 75% of the words, at every offset of the windows, against brute force."""
    rng = np.random.default_rng(23)
    items = [prose(rng, n) for n in (12, 21, 32)]
    texts = []
    for item in items:
        kept = len(item) - max(1, len(item) // 4)
        for share in (0.6, 0.65, 0.7, 0.75):
            for offset in range(len(item) // 4 + 1):
                text = list(item)
                # Plain words stay and rare ones go first in half of the texts: the weights say nothing about the words in order.
                order = rng.permutation(kept) if offset % 2 else np.argsort([-int(x[1:]) for x in item[:kept]])
                for k in order[:int(len(item) * (1 - share) + 1e-9)]:
                    text[k] = f"other{rng.integers(9000)}"
                texts.append(prose(rng, 40 + offset) + text + prose(rng, 25))
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.benchmark_matches(docs, benchmark).collect()}
    pairs = [(d, i) for d in range(len(texts)) for i in range(len(items))]
    sure = {(d, i) for d, i in pairs if accepted(texts[d], items[i], len(items[i]))}
    assert len(sure) >= 0.9 * len(texts)
    assert sure <= found <= {(d, i) for d, i in pairs if accepted(texts[d], items[i], 2 * len(items[i]))}


def test_neighbours_of_repeated_ids(spark):
    """Every row twice, one id hundreds of times with the same vector and one with many vectors: lists stay full and right."""
    rng = np.random.default_rng(29)
    rows = [(i, x.tolist()) for i, x in enumerate(rng.normal(size=(40, 8)))] * 2
    near = np.array(rows[0][1])
    rows += [(101, (near * 2).tolist())] * 400
    rows += [(102, (near * 1.5 + x).tolist()) for x in rng.normal(size=(300, 8)) * 0.01]
    assert len(rows) < neighbours.BLOCK
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = {}
    for r in neighbours.nearest_neighbours(frame, count=20, every=20).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for query in (0, 20):
        best = {}
        for i, x in rows:
            best[i] = max(best.get(i, -np.inf), float(np.dot(x, rows[query][1]))) if i != query else -np.inf
        expected = sorted((i for i in best if i != query), key=lambda i: -best[i])[:20]
        got = sorted(found[query])
        assert [g[0] for g in got] == list(range(1, 21)) and [g[1] for g in got] == expected
        assert np.allclose([g[2] for g in got], [best[i] for i in expected])

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewell.llm import decontamination, language_model, licence_scan, packing, quality_crf, toxicity
from tests.llm.conftest import words
from tests.llm.test_near_dup import SPLIT, lower

SF_DIR = "/root/testdata/sf0.01"
VOCABULARY = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels", "benchmark")}


@pytest.fixture(scope="module")
def labels(spark):
    """Labels with nulls, unknown ids, repeats and contradictions."""
    rows = [(i, i % 2, int(i % 3 == 0)) for i in range(10, 60)] + [(None, 1, 1), (10, 0, 1), (10, 1, 1), (999, 1, 1), (11, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def fold(i, m):
    return zlib.crc32(str(i).encode()) % m


def test_quality_accuracy(tables):
    rows = quality_crf.quality_scores(tables["documents"], tables["labels"]).join(tables["labels"], "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) for r in rows)


def test_quality_edges(docs, corpus, labels, empty):
    rows = quality_crf.quality_scores(docs, labels).collect()
    assert len(rows) == len(corpus) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (5, 6)}) == 1
    assert all(r.score == 0.5 for r in quality_crf.quality_scores(docs, labels.where("1 = 0")).where("lines = 0").collect())
    assert quality_crf.quality_scores(empty, labels).count() == 0
    assert quality_crf.keep_good(docs, labels).columns == docs.columns


def test_marginals_match_enumeration():
    rng = np.random.default_rng(5)
    moves = rng.normal(size=(2, 2))
    counts = np.array([3, 1, 5])
    scores = rng.normal(size=9)
    good, joint = quality_crf.marginals(scores, moves, counts)
    expected, pairs, at = [], np.zeros((2, 2)), 0
    for n in counts:
        total, ones, both = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2 ** n):
            y = [(code >> k) & 1 for k in range(n)]
            p = math.exp(sum(scores[at + k] * y[k] for k in range(n)) + sum(moves[a, b] for a, b in zip(y, y[1:])))
            total += p
            ones += p * np.array(y)
            for a, b in zip(y, y[1:]):
                both[a, b] += p
        expected += list(ones / total)
        pairs += both / total
        at += n
    assert np.allclose(good, expected) and np.allclose(joint, pairs)


def test_toxicity_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    rows = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.95 * len(rows)
    assert sum(r.predicted for r in rows if r.toxic) >= 0.85 * sum(r.toxic for r in rows)


def test_toxicity_edges(docs, corpus, labels, empty):
    rows = toxicity.toxicity_scores(docs, labels).collect()
    assert len(rows) == len(corpus) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.predicted == 0 for r in toxicity.toxicity_scores(docs, labels.where("1 = 0")).collect())
    assert toxicity.toxicity_scores(empty, labels).count() == 0


def test_maximal_segments():
    """Against the definition: repeatedly split at the best segment."""
    def define(scores, low=0):
        best = max(((sum(scores[i:j]), -(j - i), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0,))
        if best[0] <= 0:
            return []
        _, _, i, j = best
        return define(scores[:i], low) + [(low + i, low + j)] + define(scores[j:], low + j)

    rng = np.random.default_rng(1)
    for _ in range(200):
        scores = rng.choice([-3.3, -1.7, -0.9, 1.13, 2.41, 4.07], size=12)
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(scores)] == define(list(scores))


def test_language_model(docs, corpus, empty):
    held = 1
    tokens = [(i, [*SPLIT.findall(lower(t)), "\n"]) for i, t in corpus]
    counts = Counter(w for i, ws in tokens if i is not None and fold(i, 5) != held for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    base = lambda ws: sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in ws)
    expected = sorted((i if i is not None else -1, len(ws), sum(counts[w] > 0 for w in ws), round(base(ws), 6)) for i, ws in tokens)
    rows = language_model.language_scores(docs).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == expected
    assert all(r.train_tokens == total and r.score < 0 for r in rows)
    assert language_model.language_scores(empty).count() == 0


def test_language_model_helps(tables):
    rows = language_model.language_scores(tables["documents"]).where("held_out").collect()
    assert sum(r.score for r in rows) > 0.95 * sum(r.base_score for r in rows)


def test_weights_by_expectation_maximisation():
    ratio = {k: math.exp((k - language_model.RATIOS // 2 + 0.5) / language_model.BINS) for k in range(1, language_model.RATIOS)}
    cells = {3 * language_model.RATIOS: 700, 3 * language_model.RATIOS + 200: 300}
    best = max(np.linspace(0.001, 0.999, 999), key=lambda x: 700 * math.log(1 - x) + 300 * math.log(x * ratio[200] + 1 - x))
    assert abs(language_model.learn_weights(cells)[3] - best) < 0.01


def pieces_by_hand(rows):
    encode = Tokenizer.from_file(VOCABULARY[0]).encode
    out = []
    for i, t in rows:
        ids = encode(t or "", add_special_tokens=False).ids + [0]
        edges = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        out += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    return out


def test_packing(docs, corpus, empty):
    rows = packing.pack_documents(docs, *VOCABULARY).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(pieces_by_hand(corpus), key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) == -(-sum(r.length for r in rows) // 2048)
    assert packing.pack_documents(empty, *VOCABULARY).count() == 0


def test_ids_equal_the_tokenizers():
    encoder, plain = packing.Encoder(*VOCABULARY), Tokenizer.from_file(VOCABULARY[0])
    texts = ["", " ", "a  b\n\n c", "it's we'll I'M", "é\u00a0ü\u3000x \u200b", "12345 67 $$$ ###", "a <|endoftext|> b", "x" * 5000, "日本語 テキスト 🙂", "\ttab\r\nend  "]
    for text in texts:
        assert encoder.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids, text


def optimum(items, capacity):
    best = [len(items)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for room in set(bins):
            if room >= items[k]:
                j = bins.index(room)
                bins[j] -= items[k]
                place(k + 1, bins)
                bins[j] += items[k]
        place(k + 1, [*bins, capacity - items[k]])

    place(0, [])
    return best[0]


def test_dominance_keeps_the_optimum():
    rng = np.random.default_rng(4)
    for _ in range(200):
        capacity = int(rng.choice([10, 20, 30]))
        items = sorted((int(x) for x in rng.integers(1, capacity + 1, rng.integers(1, 9))), reverse=True)
        sizes, fixed = packing.Sizes(Counter(items)), 0
        for length in sorted(set(items), reverse=True):
            while sizes.count.get(length):
                chosen = packing.dominant_set(sizes, length, capacity)
                if chosen is None:
                    break
                for part in chosen:
                    sizes.take(part, 1)
                fixed += 1
        left = sorted((k for k, n in sizes.count.items() for _ in range(n)), reverse=True)
        assert fixed + optimum(left, capacity) == optimum(items, capacity)


def test_decontamination(spark, docs, corpus, empty):
    item = words(300, 40)
    near = item.split(" ")
    near[5], near[17], near[22] = "one", "two", "three"
    plain = spark.createDataFrame([*corpus, (800, words(301, 70) + " " + item.upper() + " " + words(302, 80)), (801, words(303, 20) + "\n" + " ".join(near)),
                                   (802, words(304, 90) + " " + " ".join(item.split(" ")[:14]))], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item), (2, words(305, 30)), (3, None), (None, "x y"), (4, ""), (5, item)], "item_id long, text string")
    rows = decontamination.benchmark_matches(plain, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(800, 1), (800, 5), (801, 1), (801, 5)}
    assert decontamination.decontaminate(docs, benchmark).columns == docs.columns
    assert decontamination.decontaminate(docs, benchmark).count() == len(corpus)
    assert decontamination.benchmark_matches(empty, benchmark).count() == 0
    assert decontamination.benchmark_matches(docs, benchmark.where("1 = 0")).count() == 0


def test_decontamination_finds_all_exact_passages(tables):
    plain = lambda x: " " + " ".join(re.findall(r"\w+", x.lower())) + " "
    items = [(r.item_id, plain(r.text)) for r in tables["benchmark"].collect()]
    expected = {(r.doc_id, i) for r in tables["documents"].collect() for i, t in items if t in plain(r.text)}
    found = {(r.doc_id, r.item_id) for r in decontamination.benchmark_matches(tables["documents"], tables["benchmark"]).collect()}
    assert found == expected


def test_common_subsequences():
    def plain(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    rng = np.random.default_rng(2)
    pairs = [(rng.integers(1, 8, rng.integers(1, 90)).astype(np.uint64), rng.integers(1, 8, n).astype(np.uint64)) for n in (1, 5, 40, 63, 64)]
    assert decontamination.common_subsequences(pairs).tolist() == [plain(a, b) for a, b in pairs]


def test_licences(spark, tables, docs, empty):
    model = licence_scan.fit(tables["documents"])
    found = licence_scan.scan_licences(tables["documents"], model)
    rows = {(r.doc_id, r.paragraph, r.family) for r in found.collect()}
    known = {"Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
             "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "All rights reserved.": "proprietary"}
    expected = {(r.doc_id, k, known[line]) for r in tables["documents"].collect() for k, line in enumerate(r.text.split("\n")) if line in known}
    assert rows == expected
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().toString())
    other = spark.createDataFrame([(1, "Licensed under the Unheard Of License, Version 9."), (2, None), (3, "of the and in"), (None, "MIT License")], "doc_id long, text string")
    assert {r.family for r in licence_scan.scan_licences(other, model).collect()} <= {"unknown"}
    assert licence_scan.scan_licences(docs, model).count() == 0 and licence_scan.scan_licences(empty, model).count() == 0


def test_licence_gate_loses_nothing(tables):
    """The telling words are needed by every notice, by the model's own weights."""
    model = licence_scan.fit(tables["documents"])
    lines = licence_scan.paragraphs(tables["documents"], "doc_id", "text").selectExpr("struct(doc_id, paragraph) AS key", "content")
    scored = licence_scan.score_words(lines.select("key", licence_scan.features(licence_scan.words_of(lines.content)).alias("features")), model, "key")
    slope, intercept = model.scale
    probable = {tuple(r.key) for r in scored.where(f"{slope} * margin + {intercept} >= 0").collect()}
    assert probable == {(r.doc_id, r.paragraph) for r in licence_scan.scan_licences(tables["documents"], model).collect()}

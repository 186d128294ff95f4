"""Collocations against a plain count of all phrases."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql.classic.dataframe import DataFrame

from tidewell.llm.collocations import activations, collocations, phrase_counts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts_by_hand(rows):
    found, totals = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    found[lang or "und", n, " ".join(words[i:i + n])] += 1
    return found, totals


def by_hand(rows, least, top, share):
    found, totals = counts_by_hand(rows)
    frequent = {(lang, p): f for (lang, n, p), f in found.items() if f >= least}
    out = []
    for lang in totals:
        kept = []
        for (held, p), a in frequent.items():
            words = p.split(" ")
            if held != lang or len(words) < 2:
                continue
            longer = [f for (other, q), f in frequent.items() if other == lang and len(q.split(" ")) > len(words) and f" {p} " in f" {q} "]
            if any(100 * f >= share * a for f in longer):
                continue
            cuts = []
            for k in range(1, len(words)):
                left, right = frequent[lang, " ".join(words[:k])], frequent[lang, " ".join(words[k:])]
                cuts.append((2_000_000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            kept.append((-score, -a, p.encode(), (p, a, left, right, totals[lang], score)))
        out += [(lang, i + 1, *row[3]) for i, row in enumerate(sorted(kept)[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    words = ["Red", "red", "ö", "new", "York", "city", "of", "the", "x-1", "É"]
    rows = []
    for i in range(600):
        chosen = rng.choice(words, rng.integers(0, 30), p=[.05, .1, .1, .15, .15, .15, .1, .1, .05, .05])
        gaps = rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "! "], len(chosen))
        rows.append(("".join(w + g for w, g in zip(chosen, gaps)), ["en", "en", "en", "de", None][i % 5]))
    rows += [("new york city of the new york city of", "en")] * 40 + [("rare pair", "fr")] * 29 + [("one two", "fr")] * 30
    return rows + [(None, "en"), ("", "de"), (None, None), (" \t\n", "es"), ("a " * 5000, "en"), (". , ; new york", None)]


@pytest.mark.parametrize("bits", [16, 20])
def test_counts_are_exact_whatever_shares_a_counter(spark, texts, bits):
    frame = spark.createDataFrame(texts, "text string, lang string").repartition(7)
    found, totals = counts_by_hand(texts)
    rows = {(r.lang, r.n, r.phrase): r.f for r in phrase_counts(frame, 30, bits=bits).collect()}
    assert {k: f for k, f in rows.items() if k[1]} == {k: f for k, f in found.items() if f >= 30}
    assert {k[0]: f for k, f in rows.items() if not k[1]} == dict(totals)


@pytest.mark.parametrize("least, top, share", [(30, 2000, 80), (10, 7, 60)])
def test_collocations_equal_brute_force(spark, texts, least, top, share):
    frame = spark.createDataFrame([(i, t, lang, 1, 2) for i, (t, lang) in enumerate(texts)], "doc_id long, text string, lang string, n int, score int").repartition(5)
    done = sorted(tuple(r) for r in collocations(frame, least, top, share, bits=18).collect())
    assert done == by_hand(texts, least, top, share)
    assert len(done) > 10


def test_phrases_complete_one_cycle_after_their_subphrases(spark, path):
    """Phrases whose words become frequent in the last shard are counted in a second cycle."""
    for s in range(3):
        rows = [("late come phrase",)] * (2 if s < 2 else 30)
        spark.createDataFrame(rows, "text string").selectExpr("text", "'en' AS lang").write.parquet(f"{path('shards')}/shard={s}")
    reached = activations(spark, path("shards"), 30, 3, 16)
    times = [sorted(set(t[t > 0].tolist())) for t in reached.times]
    # Words after scan 2; pairs, counted in scans 3 to 5, with the last shard in scan 5; the triple in scans 6 to 8.
    assert times == [[3], [6], [9], []]


def test_tasks_send_ranges_of_phrases_not_a_row_each(spark, monkeypatch):
    """The exact pass sends a bounded number of rows from each task, however many phrases the task meets."""
    sent, plain = spark.sparkContext.accumulator(0), DataFrame.mapInArrow

    def counting(frame, function, schema, *more):
        if function.__qualname__ != "exact_counts.<locals>.count":
            return plain(frame, function, schema, *more)

        def counted(batches):
            for batch in function(batches):
                sent.add(batch.num_rows)
                yield batch
        return plain(frame, counted, schema, *more)

    monkeypatch.setattr(DataFrame, "mapInArrow", counting)
    text = " ".join(f"w{i}" for i in range(20_000))
    frame = spark.createDataFrame([(text, "en")] * 6, "text string, lang string").repartition(2)
    rows = phrase_counts(frame, 6, bits=20).where("f = 6 AND n > 0").count()
    assert rows == 20_000 + 19_999 + 19_998 + 19_997
    assert 0 < sent.value <= 8 * (4 * 512 + 1)


def test_equal_phrases_of_other_languages_stay_apart(spark):
    """One range of hashes holds words of many languages; their texts and counts are not mixed."""
    texts = [("same words here", f"l{i:03}") for i in range(120) for _ in range(2)]
    frame = spark.createDataFrame(texts, "text string, lang string").repartition(5)
    found, totals = counts_by_hand(texts)
    rows = {(r.lang, r.n, r.phrase): r.f for r in phrase_counts(frame, 2, bits=16).collect()}
    assert rows == {**found, **{(lang, 0, ""): n for lang, n in totals.items()}}


def test_empty_table_and_tables_without_phrases(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations(none, bits=16).collect() == []
    lone = spark.createDataFrame([("word.", "en")] * 50 + [(None, None)], "text string, lang string")
    assert collocations(lone, bits=16).collect() == []


def test_counts_pass_64_bits_in_scores(spark):
    expression = "(cast({0}L AS decimal(20, 0)) * cast(2000000 AS decimal(7, 0))) div (cast({0}L AS decimal(20, 0)) + {0}L)".format(2 * 10 ** 14)
    assert spark.sql(f"SELECT {expression} AS s").head().s == 1_000_000

from __future__ import annotations

import re
import tracemalloc
from itertools import combinations
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tidewell.llm import decontamination, line_dedup, near_dup, rarity
from tidewell.llm.components import connected_components
from tidewell.session import BATCH_BYTES_KEY, bounded_batches
from tests.llm.conftest import words

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, k):
    w = SPLIT.findall(lower(text))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k, percent):
    """component of each (id, set)."""
    items = {(i, shingles(t, k)) for i, t in rows if i is not None}
    parent = {x: x for x in items}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(items, 2):
        shared = len(a[1] & b[1])
        if a[1] and b[1] and 100 * shared >= percent * len(a[1] | b[1]):
            parent[root(a)] = root(b)
    least = {}
    for x in items:
        least[root(x)] = min(least.get(root(x), x[0]), x[0])
    return {x: least[root(x)] for x in items}


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_components_match_brute_force(docs, corpus, k, percent):
    expected = brute(corpus, k, percent)
    found = near_dup.near_duplicates(docs, words=k, percent=percent).collect()
    assert len(found) == len(corpus)
    by_id = {}
    for (i, s), c in expected.items():
        by_id.setdefault(i, set()).add((len(s), c))
    for row in found:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert (row.n_shingles, row.component_id) in by_id[row.doc_id]
            assert row.kept == (row.doc_id == row.component_id)


def test_group_of_varied_copies(spark):
    """Copies that differ from each other more than from their original."""
    base = words(9, 200).split(" ")
    rows = []
    for i in range(150):
        text = list(base)
        for j in range(i % 6):
            text[(37 * i + 61 * j) % 200] = f"edit{i}x{j}"
        rows.append((1000 + i, " ".join(text)))
    rows += [(i, words(500 + i, 50)) for i in range(100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in near_dup.near_duplicates(frame, words=3, percent=85).collect()}
    assert found == {i: c for (i, _), c in brute(rows, 3, 85).items()}


def test_drop_keeps_one_of_each_group(docs, corpus):
    kept = near_dup.drop_near_duplicates(docs, words=5, percent=80)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert ids.count(None) == 2 and ids.count(71) == 1 and 1 in ids and 2 not in ids and 4 not in ids
    assert {5, 6, 7} <= set(ids)


def test_empty_tables(empty):
    assert near_dup.near_duplicates(empty).count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0


def test_prefix_never_misses():
    """Two sketches of sets this similar always share a listed value, whatever the order."""
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        pool = rng.integers(0, 2 ** 63, 2 * n).astype(np.uint64)
        a = np.unique(pool[:n])
        drop = int(len(a) * 0.07)
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[drop:]], pool[n:n + drop]]))
        shared = len(np.intersect1d(a, b))
        if 100 * shared < 85 * (len(a) + len(b) - shared):
            continue
        lists = []
        for s in (a, b):
            sketch = s[:near_dup.INDEX]
            order = np.argsort(sketch * np.uint64(0x9E3779B97F4A7C15))
            lists.append(set(sketch[order][:near_dup.prefix_length(len(s), 85)].tolist()))
        assert lists[0] & lists[1]


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (200, 100), (7, 7)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in found} == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 102: 100, 200: 100}


def brute_lines(rows, percent):
    first, lines = {}, []
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] or "")):
        for k, line in enumerate((t or "").split("\n")):
            s = frozenset(SPLIT.findall(lower(line)))
            if s:
                lines.append((i, k, s))
                first[s] = min(first.get(s, (i, k)), (i, k))
    late = {s for s in first for o in first if first[o] < first[s] and 100 * len(s & o) >= percent * len(s | o)}
    return {(i, k) for i, k, s in lines if s in late or first[s] != (i, k)}


def test_lines_match_brute_force(docs, corpus):
    removed = line_dedup.removed_lines(docs).collect()
    assert {(r.doc_id, k) for r in removed for k in r.removed} == brute_lines(corpus, 80)
    report = line_dedup.line_report(docs).collect()
    assert len(report) == len(corpus) and {(r.doc_id, k) for r in report for k in r.removed} == brute_lines(corpus, 80)
    assert all(r.n_removed == len(r.removed) and r.n_removed <= r.n_lines for r in report)
    cleaned = line_dedup.dedup_lines(docs)
    assert cleaned.columns == docs.columns
    gone = brute_lines(corpus, 80)
    expected = sorted(((i, t if t is None or i is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)) for i, t in corpus), key=str)
    assert sorted(((r.doc_id, r.text) for r in cleaned.select("doc_id", "text").collect()), key=str) == expected


def test_emptied_documents_go_on_request(spark):
    line = words(21, 12)
    rows = [(1, line), (2, line), (3, line + "\n" + words(22, 12)), (4, ""), (5, None), (6, " \n" + line.upper())]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in line_dedup.dedup_lines(frame).collect()} == {1, 2, 3, 4, 5, 6}
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(frame, drop_emptied=True).collect()} == {1: line, 3: words(22, 12), 4: "", 5: None}


def test_sets_of_all_sizes_and_shared_words(spark):
    """Lines on both sides of the width at which parity bits double, in texts cut into several pieces."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(260):
        size = int(rng.choice([2, 4, 5, 9, 60, 95, 97, 110, 118]))
        line = [f"w{x}" for x in rng.choice(130, size, replace=False)] if i % 3 else [f"z{size}x{x}" for x in range(size)]
        for x in rng.choice(size, int(rng.integers(0, max(2, size // 7))), replace=False):
            line[x] = f"n{i}y{x}"
        rows.append((i // 2, " ".join(line) if i % 2 else " ".join(line) + "\n" + " ".join(reversed(line))))
    texts = {}
    for i, t in rows:
        texts[i] = texts[i] + "\n" + t if i in texts else t
    frame = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").repartition(4)
    removed = line_dedup.removed_lines(frame).collect()
    assert {(r.doc_id, k) for r in removed for k in r.removed} == brute_lines(sorted(texts.items()), 80)


def test_many_variants_of_a_line(spark):
    base = words(11, 40).split(" ")
    rows = []
    for i in range(120):
        line = list(base)
        for j in range(i % 9):
            line[(7 * i + 11 * j) % 40] = f"v{i}y{j}"
        rows.append((i, words(900 + i, 25) + "\n" + " ".join(line)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    removed = line_dedup.removed_lines(frame).collect()
    assert {(r.doc_id, k) for r in removed for k in r.removed} == brute_lines(rows, 80)


def test_line_entries_are_sent_in_small_batches():
    """A task packs many entries together, but sends them a few MB at a time, and all of them."""
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 48, 40, dtype=np.uint64)) for _ in range(30_000)]
    column = pa.array([s.view(np.uint8).reshape(-1, 8)[:, :line_dedup.WORD_BYTES].tobytes() for s in sets], pa.binary())
    batch = pa.record_batch({"k1": pa.array(range(30_000), pa.int64()), "doc_id": pa.array(range(30_000), pa.int64()),
                             "line": pa.array([0] * 30_000, pa.int32()), "words": column})
    ranks, blocks = (SimpleNamespace(value=np.ones(line_dedup.BUCKETS, t)) for t in (np.uint8, np.uint16))
    batches = list(line_dedup._entries(ranks, blocks, 80, 50, None)(iter([batch])))
    assert max(b.nbytes for b in batches) < 6 << 20
    rows = sorted(zip(*(sum((b.column(i).to_pylist() for b in batches), []) for i in range(3))))
    found = [line_dedup.unpack_entries(n, data) for _, n, data in rows]
    assert all((f["name"] % np.uint64(50) == np.uint64(part)).all() for (part, _, _), f in zip(rows, found))
    listed = np.concatenate([f["doc"] for f in found])
    assert np.array_equal(np.bincount(listed, minlength=30_000), [line_dedup.prefix_sizes(np.array(len(s)), 80) for s in sets])


def test_line_sets_are_written_packed():
    """The sets of a piece are a few rows, whatever the number of its lines; each class has one, with its number of lines."""
    texts = ["\n".join(f"a{i} b{j} c{i * j} A{i}" for j in range(2000)) + "\n \na0 b0 c0" for i in range(3)]
    batch = pa.record_batch({"doc_id": pa.array([7, 3, 5], pa.int64()), "text": pa.array(texts)})
    rows = pa.Table.from_batches(list(line_dedup._lines(iter([batch]))))
    blobs = [b for b in rows.column("sets").to_pylist() if b is not None]
    assert rows.num_rows == 6003 and len(blobs) < 3
    lines = [(i, k, frozenset(SPLIT.findall(lower(x)))) for i, t in zip((7, 3, 5), texts) for k, x in enumerate(t.split("\n")) if x.strip()]
    copies = {}
    for i, k, s in sorted(lines, key=lambda r: r[:2]):
        copies.setdefault(s, [(i, k), 0])[1] += 1
    assert {(r["doc_id"], r["line"]): r["copies"] for r in rows.to_pylist() if r["copies"]} == dict(copies.values())
    found = pa.Table.from_batches([line_dedup.unpack_sets(b) for b in blobs])
    numbers = {tuple(line_dedup.unpacked_words(pa.array([w], pa.binary()))[0].tolist()) for w in found.column("words").to_pylist()}
    assert len(numbers) == found.num_rows == len(copies)
    assert {(r["doc_id"], r["line"]): len(r["words"]) // line_dedup.WORD_BYTES for r in found.to_pylist()} == {at: len(s) for s, (at, _) in copies.items()}


def test_packed_sets_are_cut():
    n = np.array([200_000, 3, 100_000, 100_000, 1])
    values = np.random.default_rng(2).integers(0, 1 << 63, n.sum(), dtype=np.uint64)
    at = np.arange(5, dtype=np.int64)
    blobs = line_dedup.pack_sets(at, -at, n.astype(np.int32), at, at.astype(np.int32), values)
    rows = pa.Table.from_batches([line_dedup.unpack_sets(b) for b in blobs]).to_pylist()
    assert len(blobs) == 2 and [(r["k1"], r["k2"], r["doc_id"], r["line"]) for r in rows] == [(i, -i, i, i) for i in range(5)]
    unpacked = [line_dedup.unpacked_words(pa.array([r["words"]], pa.binary()))[0] for r in rows]
    assert [len(u) for u in unpacked] == n.tolist() and np.array_equal(np.concatenate(unpacked), values >> np.uint64(16))


def test_entries_are_ordered_by_list_and_class():
    """Copies of a class are neighbours, the earliest first, also where classes agree in the bits that are sorted first."""
    rng = np.random.default_rng(6)
    size = 40_000
    kind = rng.integers(0, 20_000, size)
    e = {"name": np.where(kind % 50 == 0, 3, np.where(kind % 50 < 49, 9, kind + 20)).astype(np.uint64), "key": (kind % 5000).astype(np.uint32),
         "fold": kind.astype(np.uint64) * np.uint64(77), "n": np.where(kind % 3 == 0, (1 << 31) - 1, 5).astype(np.int32),
         "doc": rng.integers(-9, 9, size), "line": rng.integers(0, 90, size).astype(np.int32)}
    order = line_dedup.by_list_and_class(e)
    rows = list(zip(*(e[c][order].tolist() for c in ("name", "n", "key", "fold", "doc", "line"))))
    assert [r[:2] for r in rows] == sorted(r[:2] for r in rows)
    classes = [r[:4] for r in rows]
    cuts = [i for i in range(len(rows)) if not i or classes[i] != classes[i - 1]]
    assert len({classes[i] for i in cuts}) == len(cuts)
    assert all(rows[a:b] == sorted(rows[a:b]) for a, b in zip(cuts, [*cuts[1:], len(rows)]))
    names, counts = np.unique(e["name"], return_counts=True)
    assert len(rows) == counts[counts > 1].sum()
    for doc in (e["doc"], e["doc"] << 58):
        assert line_dedup.place_order(doc, e["line"]).tolist() != [] and np.array_equal(
            doc[line_dedup.place_order(doc, e["line"])], doc[np.lexsort((e["line"], doc))])


def test_slots_of_places(spark):
    ids = [0, 1, -1, 5 << 33, (1 << 63) - 1, -(1 << 63)]
    rows = [(i, k) for i in ids for k in (0, 1, 77, (1 << 31) - 1)]
    found = [r[0] for r in spark.createDataFrame(rows, "doc_id long, line int").coalesce(1).select(line_dedup.place_slot()).collect()]
    assert found == line_dedup.place_slots(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.int32)).tolist()


def test_lines_of_repeated_ids(spark):
    """A class whose first lines stand at several places of one id, in rows of different tasks."""
    a, b, c = words(31, 20), words(32, 20), words(33, 20)
    rows = [(5, f"{b}\n{a}"), (5, f"{a}\n{c}"), (5, f"{c}\n\n{a}\n{a}"), (9, a), (9, f"{a}\n{b}"), (-4, c), (5, f"{b}\n{a}")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    report = line_dedup.line_report(frame).collect()
    assert len(report) == len(rows)
    assert {(r.doc_id, k) for r in report for k in r.removed} == brute_lines(rows, 80)


def test_document_entries_are_sent_in_small_batches():
    rng = np.random.default_rng(4)
    sketches = [np.unique(rng.integers(0, 1 << 63, near_dup.INDEX, dtype=np.uint64)) for _ in range(10_000)]
    numbers = pa.array(range(10_000), pa.int64())
    batch = pa.record_batch({"c": numbers, "rep": numbers, "n": pa.array([300] * 10_000, pa.int64()), "copies": pa.array([1] * 10_000, pa.int64()),
                             "sketch": pa.array([s.tobytes() for s in sketches], pa.binary())})
    batches = list(near_dup._entries(SimpleNamespace(value=np.ones(near_dup.BUCKETS, np.uint8)), 80)(iter([batch])))
    assert max(b.nbytes for b in batches) < 6 << 20
    counts = np.bincount(np.concatenate([b.column(1).to_numpy() for b in batches]), minlength=10_000)
    assert (counts == near_dup.prefix_length(300, 80)).all()


def test_counts_are_sent_in_small_batches():
    size = 1 << 21
    count = rarity.counted(lambda b: [np.arange(size, dtype=np.uint64)], size)
    batches = list(count(iter([pa.record_batch({"x": pa.array([1])})])))
    assert max(b.nbytes for b in batches) < 4 << 20
    assert sum((b.column("segment").to_pylist() for b in batches), []) == list(range(size // rarity.SEGMENT))


def test_pipeline_bounds_the_bytes_of_batches(spark):
    held = spark.conf.get(BATCH_BYTES_KEY, None)
    spark.conf.unset(BATCH_BYTES_KEY)

    def sizes(batches):
        for b in batches:
            yield pa.record_batch({"bytes": pa.array([b.nbytes], pa.int64())})

    try:
        rows = spark.range(0, 9000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 400) AS text")
        corpus_pipeline.near_duplicates(spark, rows.limit(1), "")
        assert max(r.bytes for r in rows.mapInArrow(sizes, "bytes long").collect()) < 5 << 20
        spark.conf.set(BATCH_BYTES_KEY, "123456")
        bounded_batches(spark)
        assert spark.conf.get(BATCH_BYTES_KEY) == "123456"
    finally:
        spark.conf.unset(BATCH_BYTES_KEY)
        if held is not None:
            spark.conf.set(BATCH_BYTES_KEY, held)


def test_sparse_sums_hold_few_products():
    """Sums over runs are those of all products at once, in a fraction of their memory."""
    rng = np.random.default_rng(5)
    row = np.sort(rng.integers(0, 2000, 60_000))
    column, value = rng.integers(0, 500, 60_000), rng.random(60_000).astype(np.float32)
    matrix = rng.standard_normal((500, 272)).astype(np.float32)
    expected = np.zeros((2000, 272), np.float32)
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    expected[row[first]] = np.add.reduceat(matrix[column] * value[:, None], first, axis=0)
    tracemalloc.start()
    found = decontamination.times(row, column, value, 2000, matrix)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(found, expected)
    assert peak < 40 << 20
    assert not decontamination.times(row[:0], column[:0], value[:0], 3, matrix).any()

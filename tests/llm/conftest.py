from __future__ import annotations

import pytest

WORDS = [f"w{i}" for i in range(400)]


def words(seed: int, n: int) -> str:
    """Reproducible text of n words."""
    state = seed * 7919 + 13
    out = []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2 ** 31
        out.append(WORDS[(state >> 8) % len(WORDS)])
    return " ".join(out)


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text): nulls, empty and long texts, copies, near copies, repeated rows."""
    long = words(1, 6000)
    near = words(2, 120).split(" ")
    rows = [(i, words(100 + i, 30 + i)) for i in range(10, 60)]
    rows += [(1, words(2, 120)), (2, words(2, 120)), (3, " ".join(near[:60] + ["changed"] + near[61:])), (4, words(2, 120).upper()),
             (5, ""), (6, None), (None, "text without id"), (None, None), (7, " \t\n "), (8, long), (9, long + " end"),
             (70, words(3, 40) + "\n" + words(4, 40)), (71, words(5, 40) + "\n" + words(4, 40)), (71, words(5, 40) + "\n" + words(4, 40)),
             (72, "\n\n" + words(4, 39) + " other\n"), (73, "a b"), (74, "b a"), (75, "a b c d")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with columns whose names the operators use themselves."""
    rows = [(i, t, "x", 1, None, 2.0, "n", 1) for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n int, component_id long, score double, value string, removed_from int").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, n int")

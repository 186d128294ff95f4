from __future__ import annotations

import fnmatch

import numpy as np
import pytest

import corpus_pipeline
from tests.oracle import connect, differences
from tidewell.llm import neighbours, url_filter
from tidewell.llm.queries import REGISTRY, SQL
from tidewell.llm.url_filter import Rule

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    assert differences(REGISTRY[name](spark, SF_DIR), connect(SF_DIR), SQL[name]) is None


def test_urls(spark):
    urls = [None, "", "no scheme", "http://A.com/x", "https://www.Example.com/en/?q", "ftp://example.com#x/en/", "http://user@b.net:80/fr/a?b://c", "http://xnet/es/",
            "http://net/es/", "http://x.org/a.com/", "a://" + "h" * 3000 + ".com/" + "p" * 3000, "http://"]
    frame = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    rules = [Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"), Rule("net", "/es/", "block"), Rule("net", "/fr/", "block")]
    rows = {r.page_id: r for r in url_filter.judge_urls(frame, rules).collect()}
    assert [rows[i].rule for i in range(len(urls))] == [None, None, None, "com/", "www.example.com/en/", None, None, None, "net/es/", None, "com/", None]
    assert (rows[5].host, rows[5].path, rows[6].host, rows[6].path) == ("example.com", "", "user@b.net:80", "/fr/a")
    assert url_filter.judge_urls(frame.where("1 = 0"), rules).count() == 0


def test_wildcards_match_globs():
    rng = np.random.default_rng(3)
    letters = list("ab./")
    rules = [Rule("".join(rng.choice(list("ab.*?"), 4)), "/" + "".join(rng.choice(list("ab/*?"), 3)), "block") for _ in range(60)]
    automaton = url_filter.Automaton(rules)
    assert automaton.words > 1
    for _ in range(300):
        host, path = "".join(rng.choice(letters[:3], 5)), "/" + "".join(rng.choice(letters, 6))
        fits = [k for k, r in enumerate(automaton.rules) if fnmatch.fnmatchcase("." + host, "*." + r.host) and fnmatch.fnmatchcase(path, r.path + "*")]
        url = b"." + host.encode() + bytes([url_filter.SEPARATOR]) + path.encode()
        assert automaton.first_match([url])[0] == (fits[0] if fits else -1)


def brute(ids, x, count, every):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        scores = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:count]
        out[int(ids[i])] = [(int(ids[j]), scores[j]) for j in order]
    return out


def test_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = table.toPandas()
    ids, x = data.vec_id.to_numpy(), np.stack(data.embedding).astype(float)
    expected, hit, total, found = brute(ids, x, 20, 20), 0, 0, {}
    for r in neighbours.nearest_neighbours(table).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == set(expected)
    for query, near in expected.items():
        rows = sorted(found[query])
        assert [r[0] for r in rows] == list(range(1, len(near) + 1))
        hit += len({r[1] for r in rows} & {n[0] for n in near})
        total += len(near)
        known = dict(near)
        assert all(abs(known[r[1]] - r[2]) < 1e-12 for r in rows if r[1] in known)
    assert hit >= 0.9 * total


def test_vectors_that_take_no_part(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(0, 60)] + [(60, [1.0, 0.0, 0.0]), (61, None), (62, [0.0, 0.0, 0.0]), (63, [1.0, None, 1.0]), (64, [float("nan"), 1.0, 1.0]),
                                                (65, [float("inf"), 1.0, 1.0]), (66, [1.0]), (67, []), (None, same), (80, None), (40, same)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, part string")
    found = {}
    for r in neighbours.nearest_neighbours(frame, count=5, every=20).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert {q: [v for _, v in sorted(f)] for q, f in found.items()} == {0: [1, 2, 3, 4, 5], 20: [0, 1, 2, 3, 4], 40: [0, 1, 2, 3, 4], 60: [0, 1, 2, 3, 4]}
    few = neighbours.nearest_neighbours(frame.where("vec_id < 3"), count=5, every=20).collect()
    assert [(r.rank, r.vec_id) for r in sorted(few)] == [(1, 1), (2, 2)]
    assert neighbours.nearest_neighbours(frame.where("1 = 0")).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, SF_DIR), name)
        ids = [r.doc_id for r in docs.collect()]
        assert docs.columns == columns and set(ids) <= before and len(ids) == len(set(ids))
        before = set(ids)
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == before

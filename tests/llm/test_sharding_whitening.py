"""Uniform shuffle into exact shards, and whitening of embeddings."""

from __future__ import annotations

from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm.sharding import FAN, communication_matrix, hypergeometric, shard_sizes, shuffle_shards, uniform, write_shards
from tidewell.llm.whitening import fit_whitening, integers, whiten


@pytest.mark.parametrize("good, bad, draws", [(5, 7, 6), (30, 70, 40), (3, 2, 4), (0, 5, 3), (5, 0, 3), (4, 4, 0), (100, 3, 50)])
def test_hypergeometric_draws_follow_the_law(spark, good, bad, draws):
    rows = 20_000
    counts = [F.lit(x).cast("long") for x in (good, bad, draws)]
    drawn = spark.range(rows).select(hypergeometric(*counts, uniform(3, F.col("id"))).alias("k")).groupBy("k").count().collect()
    assert sum(r["count"] for r in drawn) == rows
    for r in drawn:
        share = comb(good, r.k) * comb(bad, draws - r.k) / comb(good + bad, draws)
        assert abs(r["count"] - rows * share) <= 5 * (rows * share * (1 - share)) ** 0.5 + 3


def test_large_hypergeometric_draws_have_mean_and_spread(spark):
    n = 3 * 10 ** 10
    counts = [F.lit(x).cast("long") for x in (n // 8, n - n // 8, n // 16)]
    drawn = [r.k for r in spark.range(12).select(hypergeometric(*counts, uniform(9, F.col("id"))).alias("k")).collect()]
    deviation = (n / 16 * (1 / 8) * (7 / 8) * (15 / 16)) ** 0.5
    assert all(abs(k - n / 128) < 6 * deviation for k in drawn) and len(set(drawn)) == 12


@pytest.mark.parametrize("sizes", [[5], [0, 7, 1], [100] * (FAN + 3), list(range(300))])
def test_matrix_has_the_given_sums(spark, sizes):
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(sizes) if n], "part long, n long")
    matrix = {r.part: r.counts for r in communication_matrix(frame, 8, 4).collect()}
    assert {p: sum(c) for p, c in matrix.items()} == {i: n for i, n in enumerate(sizes) if n}
    assert np.sum(list(matrix.values()), axis=0).tolist() == shard_sizes(sum(sizes), 8)
    assert min(min(c) for c in matrix.values()) >= 0


def test_every_row_gets_one_slot(spark, docs):
    done = shuffle_shards(docs, 4, seed=2)
    rows = done.collect()
    assert sorted(map(str, (r[:-2] for r in rows))) == sorted(map(str, (tuple(r) for r in docs.collect())))
    sizes = shard_sizes(len(rows), 4)
    for shard, size in enumerate(sizes):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(size))


def test_shuffle_is_uniform_over_shards_and_slots(spark):
    """One key with a third of the rows: each shard holds its share of it, early slots as many as late ones."""
    frame = spark.range(12_000).select(F.when(F.col("id") % 3 == 0, -7).otherwise(F.col("id")).alias("key")).repartition(11)
    rows = shuffle_shards(frame, 3, seed=6).where("key = -7").collect()
    assert len(rows) == 4000
    for shard in range(3):
        slots = [r.slot for r in rows if r.shard == shard]
        assert abs(len(slots) - 4000 / 3) < 6 * 30
        assert abs(np.mean(slots) - 2000) < 6 * 1155 / len(slots) ** 0.5


def test_seeds_and_empty_tables(spark, empty):
    frame = spark.range(400).repartition(5)
    same = [sorted((r.id, r.shard, r.slot) for r in shuffle_shards(frame, 8, seed).collect()) for seed in (1, 1, 2)]
    assert same[0] == same[1] != same[2]
    assert shuffle_shards(empty, 8).collect() == []
    assert sorted(r.shard for r in shuffle_shards(spark.range(2), 8).collect()) == [0, 1]


def test_clashing_names_and_written_shards(spark, path):
    frame = spark.createDataFrame([(i, i, f"t{i}", 0.5) for i in range(50)], "shard long, slot long, `a.b` string, __key double")
    done = shuffle_shards(frame, 3)
    assert set(done.columns) == {"a.b", "__key", "shard", "slot"} and done.count() == 50
    write_shards(frame, path("out"), 3)
    assert sorted((r["a.b"]) for r in spark.read.parquet(path("out")).collect()) == sorted(f"t{i}" for i in range(50))


def test_no_python_runs_in_tasks(spark, docs):
    plan = shuffle_shards(docs, 4)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def vectors(spark, matrix, **more):
    rows = [(i, [float(c) for c in row], i % 3, 1.0) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n long, whitened double").repartition(5)


def brute_force(matrix):
    x = np.floor(64 * np.float32(matrix).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    c = (n * x - sums) / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    return x, n * x - sums, c, values[::-1], axes[:, ::-1]


@pytest.mark.parametrize("rows, width", [(400, 64), (90, 24), (700, 110)])
def test_components_equal_a_dense_solution(spark, rows, width):
    rng = np.random.default_rng(rows)
    matrix = rng.standard_normal((rows, width)) * np.linspace(3, 0.2, width) @ np.linalg.qr(rng.standard_normal((width, width)))[0]
    x, off, c, values, axes = brute_force(matrix)
    done = whiten(vectors(spark, matrix)).toPandas().sort_values(["vec_id", "component"])
    count = min(32, width)
    assert len(done) == rows * count and done.n.unique().tolist() == [rows]
    assert done.identity_error.nunique() == 1 and done.identity_error.iloc[0] < 1e-9
    found = done.whitened.to_numpy().reshape(rows, count)
    expected = c @ axes[:, :count] / np.sqrt(values[:count])
    expected *= np.sign((expected * found).sum(axis=0))
    assert np.abs(found - expected).max() < 1e-8
    assert np.allclose(done.explained.to_numpy()[:count], values[:count] / values.sum(), rtol=1e-10)
    assert done.deviation.to_numpy()[::count].tolist() == (off * off).sum(axis=1).tolist()


def test_filter_works_when_the_block_is_small(spark):
    """More columns than the block: the polynomial has to damp most of the spectrum."""
    rng = np.random.default_rng(1)
    matrix = rng.standard_normal((500, 80)) * np.linspace(3, 1, 80)
    fit = fit_whitening(integers(vectors(spark, matrix), "vec_id", "embedding"), count=5, guard=3)
    values = brute_force(matrix)[3]
    assert np.allclose(fit.values, values[:5], rtol=1e-12) and fit.residual < 1e-11 and fit.passes > 20


def test_a_vector_that_is_a_third_of_all_rows(spark):
    """Its direction dominates the spectrum by far and must not drown the others."""
    rng = np.random.default_rng(2)
    matrix = np.vstack([rng.standard_normal((300, 60)), np.tile(40 * rng.standard_normal(60), (150, 1))])
    fit = fit_whitening(integers(vectors(spark, matrix), "vec_id", "embedding"), count=20, guard=10)
    values = brute_force(matrix)[3]
    assert values[0] > 1000 * values[1]
    assert np.allclose(fit.values, values[:20], rtol=1e-9) and fit.passes < 400


def test_rows_that_take_no_part(spark, empty):
    rng = np.random.default_rng(5)
    good = [(i, [float(v) for v in rng.standard_normal(4)]) for i in range(20)] + [(3, [1.0, 2.0, 0.0, 1.0])] * 2 + [(None, [0.0] * 4)]
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0, 3.0]), (93, [float("nan")] * 4), (94, [float("inf"), 0.0, 0.0, 0.0]), (95, [1.0, 2.0])]
    frame = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>")
    done = whiten(frame).toPandas()
    assert set(done.n) == {23} and len(done) == 23 * 4 and done.vec_id.isna().sum() == 4 and not done.vec_id.isin(range(90, 96)).any()
    assert whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<float>")).collect() == []
    assert whiten(spark.createDataFrame(bad, "vec_id long, embedding array<double>").where("vec_id < 92")).collect() == []


def test_rank_below_the_number_of_columns_and_huge_entries(spark):
    rng = np.random.default_rng(8)
    low = rng.integers(-50, 50, (60, 3)) @ rng.integers(-5, 5, (3, 10))
    done = whiten(vectors(spark, low)).toPandas()
    assert done.component.max() == 3 and done.identity_error.iloc[0] < 1e-8
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")
    assert whiten(huge).select("deviation").distinct().count() >= 1

"""Hot keys: results stay exact and the work is really divided."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewell.functions.hashing import add_row_hashes
from tidewell.operators import skew
from tidewell.operators.cdc import classify_changes
from tidewell.operators.scd import scd1, scd2
from tidewell.operators.sets import dedup
from tidewell.plans.reconcile import mismatch_rows


@pytest.fixture
def skewed(spark):
    rng = random.Random(5)
    rows = [(None if rng.random() < 0.05 else "hot" if rng.random() < 0.4 else f"k{rng.randrange(40)}",
             rng.randrange(900), rng.randrange(5)) for _ in range(4000)]
    return spark.createDataFrame(rows, "k string, at int, v int").repartition(4)


@pytest.mark.parametrize("forward", [True, False])
@pytest.mark.parametrize(("budget", "min_rows"), [(10, 1), (100, 1), (4000, 1), (16_384, 500_000)])
def test_neighbour_matches_a_plain_window(skewed, forward, budget, min_rows):
    tool = skew.next_in_order if forward else skew.previous_in_order
    actual = tool(skewed, ["k"], ["at"], "v", "other", budget=budget, min_rows=min_rows)
    window = Window.partitionBy("k").orderBy("at", "v")
    plain = skewed.withColumn("other", (F.lead("v") if forward else F.lag("v")).over(window))
    assert actual.columns == plain.columns
    assert actual.exceptAll(plain).isEmpty() and plain.exceptAll(actual).isEmpty()


def test_hot_key_is_divided(skewed):
    ranked = skew._ranked(skewed, ["at"], "v")
    split = skew._with_pieces(ranked, ranked.select("k", "__rank"), ["k"], True, 40, 1)
    pieces = split.groupBy("k", "__piece").count().collect()
    hot = [row["count"] for row in pieces if row["k"] == "hot"]
    assert len(hot) > 10 and max(hot) < sum(hot) / 4
    cold = {row["__piece"] for row in pieces if row["k"] not in ("hot", None)}
    assert cold == {0}


def test_hot_keys_are_few(skewed):
    found = {r["k"]: r["__pieces"] for r in skew.hot_keys(skewed, ["k"], 10, 1).collect()}
    assert set(found) == {"hot"} and found["hot"] in (4, 5)
    assert skew.hot_keys(skewed, ["k"], 10, 100_000).isEmpty()
    assert skew.hot_keys(skewed.where("false"), ["k"], 10, 1).isEmpty()


def test_neighbour_of_null_values(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, None)], "k string, at int, v int")
    rows = {r["at"]: r["nxt"] for r in skew.next_in_order(df, ["k"], ["at"], "v", "nxt", min_rows=1).collect()}
    assert rows == {1: 5, 2: None, 3: None}


def test_version_history_of_a_hot_key(spark, skewed):
    log = skewed.groupBy("k", "at").agg(F.max("v").alias("v"))
    split = scd2(log, ["k"], ["at"], piece_rows=1)
    plain = scd2(log, ["k"], ["at"])
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


@pytest.fixture
def small_partitions(spark):
    """Sizes at which AQE treats the test data as it treats large data."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_rows(spark, key, shift=0):
    """Rows of which a third share one key."""
    rows = spark.range(0, 60_000, 1, 8)
    shared = F.when(F.col("id") % 3 == 0, key).otherwise(F.col("id"))
    return add_row_hashes(rows.select(shared.alias("k"), (F.col("id") + shift).alias("v")), ["k"])


def test_update_join_splits_a_hot_key(spark, small_partitions):
    changes = classify_changes(hot_rows(spark, -1), hot_rows(spark, -1, shift=1), incremental=True)
    assert {r["change_op"]: r["count"] for r in changes.groupBy("change_op").count().collect()} == {"UPDATE": 60_000}
    assert "skew=true" in executed(changes)


def test_delete_join_splits_a_hot_key(spark, small_partitions):
    changes = classify_changes(hot_rows(spark, -1), hot_rows(spark, -2))
    counts = {r["change_op"]: r["count"] for r in changes.groupBy("change_op").count().collect()}
    assert counts == {"INSERT": 20_000, "DELETE": 20_000}
    assert executed(changes).count("skew=true") >= 2


def test_mismatch_join_splits_copies(spark, small_partitions):
    # Copies compress well, so few other rows are kept for the copies to stand out.
    rows = hot_rows(spark, -1).where("k < 3000")
    copies = rows.withColumn("row_hash", F.when(F.col("k") == -1, "same").otherwise(F.col("row_hash")))
    found = mismatch_rows(copies, hot_rows(spark, -2).where("k between 0 and 2999"))
    assert found.count() == 20_000
    assert "skew=true" in executed(found)


def test_only_candidates_leave_the_map_side(skewed):
    for df in (scd1(skewed, ["k"], ["at"]), dedup(skewed, ["k"], order=["at"])):
        plan = executed(df)
        shuffle = plan.index("Exchange hashpartitioning")
        assert "WindowGroupLimit" in plan[shuffle:] and "Partial" in plan[shuffle:]

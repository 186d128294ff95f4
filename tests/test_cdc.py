from __future__ import annotations

from datetime import datetime
from collections import Counter

import pytest

from pyspark.sql import functions as F

from tidewell.operators import cdc
from tidewell.operators.scd import scd1
from tidewell.functions.hashing import add_row_hashes
from tidewell.operators.cdc import classify_changes, initial_changes
from tidewell.operators.transforms import ColumnSpec
from tidewell.plans.raw_load import change_log


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def changes(spark, source, target, keys=("k",), **options):
    return classify_changes(add_row_hashes(frame(spark, source), keys), add_row_hashes(frame(spark, target), keys),
                            keyed=bool(keys), **options)


def ops(df):
    return Counter((r["change_op"], r["k"], r["v"]) for r in df.collect())


SOURCE = [(1, "same"), (2, "new"), (3, "added"), (None, "nullkey")]
TARGET = [(1, "same"), (2, "old"), (4, "gone")]


@pytest.mark.parametrize(("keys", "incremental", "expected"), [
    (("k",), False, {("UPDATE", 2, "new"), ("INSERT", 3, "added"), ("INSERT", None, "nullkey"), ("DELETE", 4, "gone")}),
    (("k",), True, {("UPDATE", 2, "new"), ("INSERT", 3, "added"), ("INSERT", None, "nullkey")}),
    ((), False, {("INSERT", 2, "new"), ("INSERT", 3, "added"), ("INSERT", None, "nullkey"), ("DELETE", 2, "old"),
                 ("DELETE", 4, "gone")}),
    ((), True, {("INSERT", 2, "new"), ("INSERT", 3, "added"), ("INSERT", None, "nullkey")}),
])
def test_modes(spark, keys, incremental, expected):
    assert ops(changes(spark, SOURCE, TARGET, keys, incremental=incremental)) == Counter(expected)


def test_duplicate_keys_do_not_multiply(spark):
    source = [(1, "a"), (1, "b"), (1, "b"), (2, "x")]
    target = [(1, "a"), (1, "c"), (1, "c"), (2, "x"), (2, "x")]
    found = changes(spark, source, target, count_matches=True)
    assert ops(found) == Counter({("UPDATE", 1, "a"): 1, ("UPDATE", 1, "b"): 2})
    # The counts are those of a join on the key with differing rows.
    pairs = sum(1 for k, v in source for q, w in target if k == q and v != w)
    assert sum(r["changed_matches"] for r in found.collect()) == pairs


@pytest.mark.parametrize("incremental", [False, True])
@pytest.mark.parametrize("least", [1, 500_000])
def test_counted_changes_equal_a_join(spark, incremental, least):
    """Repeated keys, keys of one side, null keys, null hashes and hashes that are no md5; with all keys too large and with none."""
    def side(seed, rows):
        number = F.xxhash64("id", F.lit(seed))
        key = F.pmod(number, F.lit(60)) + F.when(F.pmod(number, F.lit(7)) == 0, 100 * seed).otherwise(0)
        v = F.pmod(F.xxhash64(number), F.lit(3)).cast("string")
        df = add_row_hashes(spark.range(rows).select(key.cast("int").alias("k"), v.alias("v")), ["k"])
        return df.withColumns({"row_key_hash": F.when(F.col("k") % 10 == 3, None).when(F.col("k") % 10 == 4, F.concat(F.lit("é"), "k")).otherwise(F.col("row_key_hash")),
                               "row_hash": F.when(F.col("k") % 10 == 5, None).when(F.col("k") % 10 == 6, F.col("v")).otherwise(F.col("row_hash"))})

    source, target = side(1, 300), side(2, 200)
    actual = cdc._counted_changes(source, target, incremental, "row_key_hash", "row_hash", "change_op", min_rows=least)
    expected = cdc._joined_changes(source, target, True, incremental, "row_key_hash", "row_hash", "change_op", True)
    assert actual.schema.simpleString() == expected.schema.simpleString()
    assert Counter(map(tuple, actual.collect())) == Counter(map(tuple, expected.collect()))


def test_counted_changes_move_each_row_once(spark):
    source, target = add_row_hashes(frame(spark, SOURCE), ["k"]), add_row_hashes(frame(spark, TARGET), ["k"])
    found = classify_changes(source, target, count_matches=True)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(row_key_hash" in line and "Reused" not in line]
    assert len(moved) == 1


def test_empty_target_gives_inserts(spark):
    assert ops(changes(spark, SOURCE, [])) == Counter(("INSERT", k, v) for k, v in SOURCE)
    assert ops(changes(spark, [], TARGET)) == Counter(("DELETE", k, v) for k, v in TARGET)


def test_initial(spark):
    assert ops(initial_changes(frame(spark, SOURCE))) == Counter(("INSERT", k, v) for k, v in SOURCE)


def test_applying_changes_rebuilds_the_source(spark):
    found = {(r["k"]): (r["change_op"], r["v"]) for r in changes(spark, SOURCE, TARGET).collect()}
    state = dict(TARGET)
    for key, (op, value) in found.items():
        state.pop(key, None) if op == "DELETE" else state.update({key: value})
    assert state == dict(SOURCE)


SPECS = [ColumnSpec("id", "k", "bigint"), ColumnSpec("v", "v", "string")]


def test_loads_compare_with_the_folded_history(spark, path):
    def load(source, history, batch, day):
        log = change_log(frame(spark, source), history, SPECS, ["id"], batch_id=batch, loaded_at=datetime(2024, 1, day),
                         deduplicate=True, dedup_key=[""], staged=True)
        log.write.mode("append").parquet(path("log"))
        return {(r["change_op"], r["id"]) for r in spark.read.parquet(path("log")).where(f"batch_id = '{batch}'").collect()}

    def history():
        log = spark.read.parquet(path("log"))
        return scd1(log, ["row_key_hash"], ["loaded_at"], op="change_op", exclude=["change_op"]).drop("batch_id", "loaded_at")

    assert {op for op, _ in load(TARGET, None, "b1", 1)} == {"INSERT"}
    assert load(SOURCE, history(), "b2", 2) == {("UPDATE", 2), ("INSERT", 3), ("INSERT", None), ("DELETE", 4)}
    assert load(SOURCE, history(), "b3", 3) == set() and load(SOURCE, history(), "b4", 4) == set()
    with pytest.raises(ValueError, match="folded history"):
        change_log(frame(spark, SOURCE), spark.read.parquet(path("log")), SPECS, ["id"])

from __future__ import annotations

import glob
import os
from collections import Counter
from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from tidewell.operators import sets
from tidewell.plans import loads
from tidewell.operators.expectations import Rule, mark_failures, passing_rows, quarantined_rows, rule_counts, split_rows
from tidewell.operators.merge import bucket_of, merge_upsert, upsert_table
from tidewell.operators.scd import scd1, scd2
from tidewell.operators.transforms import (
    ColumnSpec,
    clean_names,
    drop_types,
    lineage_columns,
    rename_columns,
    select_columns,
    transform_map,
)
from pyspark.sql import types as T


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_transform_map_order_and_casts(spark):
    df = spark.createDataFrame([("1", "x", "dropped")], "a string, b string, c string")
    specs = [ColumnSpec("n", "a", "int"), ColumnSpec("twice", derived="n * 2", type="string"),
             ColumnSpec("b", "b", "varchar(5)", derived=None)]
    out = transform_map(df, specs)
    assert out.dtypes == [("n", "int"), ("twice", "int"), ("b", "string")]
    assert transform_map(df, specs, cast_derived=True).dtypes[1] == ("twice", "string")


def test_transform_map_swaps_and_shadows(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    specs = [ColumnSpec("b", "a"), ColumnSpec("a", "b"), ColumnSpec("sum", derived="a * 10 + b"),
             ColumnSpec("c", derived="c + 1"), ColumnSpec("old_c", "c"), ColumnSpec("after", derived="c + sum")]
    assert tuple(transform_map(df, specs).first()) == (1, 2, 21, 4, 3, 25)
    with pytest.raises(ValueError, match="no source column"):
        transform_map(df, [ColumnSpec("x", "nope")])


def test_transform_map_is_one_projection(spark):
    df = spark.range(1).selectExpr(*[f"id AS c{i}" for i in range(60)])
    out = transform_map(df, [ColumnSpec(f"d{i}", f"c{i}", "string") for i in range(60)])
    assert out._jdf.queryExecution().analyzed().toString().count("Project") == 2


def test_transform_map_failing_cast(spark):
    df = spark.createDataFrame([("oops",)], "a string")
    specs = [ColumnSpec("a", "a", "int")]
    with pytest.raises(PySparkException):
        transform_map(df, specs).collect()
    assert transform_map(df, specs, on_error="null").first()[0] is None


@pytest.mark.parametrize("text", ["F.current_timestamp()", "lit(current_date())"])
def test_python_expressions_are_refused(spark, text):
    with pytest.raises(ValueError, match="SQL text"):
        transform_map(spark.range(1), [ColumnSpec("x", derived=text)])


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], ["a (b)|,", "c\t d-é"])
    assert clean_names(df).columns == ["ab", "cd-é"]
    assert clean_names(df, "snake").columns == ["a_b", "c_d"]
    with pytest.raises(ValueError, match="share"):
        clean_names(spark.createDataFrame([(1, 2)], ["a b", "ab"]))
    assert rename_columns(df.toDF("x", "y"), None, {"x": "z"}).columns == ["z", "y"]
    assert select_columns(df.toDF("x", "y"), {"y": True, "x": False, "q": True}).columns == ["y"]
    assert drop_types(spark.sql("SELECT 1 a, binary('x') b"), T.BinaryType).columns == ["a"]


def test_lineage_default_time(spark):
    row = lineage_columns(spark.range(1), "b7").first()
    assert row["batch_id"] == "b7" and row["loaded_at"] is not None


def test_dedup_variants(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 4), (1, "b", 4), (2, "c", 1)], "k int, v string, o int")
    assert rows(sets.dedup(df, ["k"], order=["o"])) == Counter([(1, "b", 4), (2, "c", 1)])
    assert sets.dedup(df, ["k", "v"], exclude=["v"]).count() == 2
    assert sets.dedup(df, exclude=["o"]).count() == 3
    assert sets.dedup(df, [""]).count() == sets.dedup(df).count() == 3


def test_union_of_nothing_but_empties(spark):
    empty = spark.createDataFrame([], "a int, b string")
    out = sets.union_by_name(empty, empty.select("b", "a"))
    assert out.columns == ["a", "b"] and out.isEmpty()


def test_difference_with_nulls_and_copies(spark):
    left = spark.createDataFrame([(1,), (1,), (None,), (2,)], "a int")
    right = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    assert rows(sets.difference(left, right)) == Counter([("left", 2), ("right", 3)])
    assert rows(sets.difference(left, right, every_copy=True)) == Counter(
        [("left", 1, 1), ("left", 2, 1), ("right", 3, 1)])


LOG = [("a", 1, "UPSERT", "x"), ("a", 3, "DELETE", None), ("a", 5, "UPSERT", "y"), ("b", 2, "UPSERT", "z"),
       ("b", 4, "DELETE", None), ("c", 9, "DELETE", None)]


def log(spark, items=LOG):
    return spark.createDataFrame(items, "k string, seq int, op string, v string")


def test_scd1_and_scd2(spark):
    assert rows(scd1(log(spark), ["k"], ["seq"], "op", ["op"])) == Counter([("a", 5, "y")])
    history = scd2(log(spark), ["k"], ["seq"], "op", ["op"]).select("k", "v", "start_at", "end_at")
    assert rows(history) == Counter([("a", "x", 1, 3), ("a", "y", 5, None), ("b", "z", 2, 4)])


def test_scd_with_two_sequence_columns(spark):
    df = spark.createDataFrame([("a", 1, 2, "old"), ("a", 2, 1, "new"), ("a", 1, 3, "mid")],
                               "k string, s1 int, s2 int, v string")
    assert [r["v"] for r in scd1(df, ["k"], ["s1", "s2"]).collect()] == ["new"]
    ends = {r["v"]: r["end_at"] for r in scd2(df, ["k"], ["s1", "s2"]).collect()}
    assert tuple(ends["old"]) == (1, 3) and tuple(ends["mid"]) == (2, 1) and ends["new"] is None


def test_equal_sequence_is_settled_the_same_way(spark):
    items = [("a", 1, "UPSERT", v) for v in "pqrs"]
    picks = {scd1(log(spark, order).repartition(3), ["k"], ["seq"], "op").first()["v"]
             for order in (items, items[::-1], items[2:] + items[:2])}
    assert len(picks) == 1
    assert scd2(log(spark, items), ["k"], ["seq"], "op").count() == 1


def test_merge_upsert(spark):
    target = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (2, "c", 2), (None, "n", 0)], "k int, v string, n int")
    updates = spark.createDataFrame([(1, "new", None), (3, "add", 9), (None, "null", 7)], "k int, v string, n int")
    out = merge_upsert(target, updates, ["k"], ["n"], insert_columns=["k", "v"])
    assert rows(out) == Counter([(1, "a", None), (1, "b", None), (2, "c", 2), (None, "n", 0), (3, "add", None),
                                 (None, "null", None)])
    twice = updates.union(updates)
    with pytest.raises(PySparkException, match="More than one update"):
        merge_upsert(target, twice.where("k = 1"), ["k"], ["n"]).collect()


RULES = [Rule("positive", "a > 0", "error"), Rule("small", "a < 10")]


def test_expectations(spark):
    df = spark.createDataFrame([(5,), (-1,), (50,), (None,)], "a int")
    assert [r["failed_rules"] for r in mark_failures(df, RULES).collect()] == [
        [], ["positive"], ["small"], ["positive", "small"]]
    assert sorted(r["a"] for r in passing_rows(df, RULES).collect()) == [5, 50]
    assert {r["a"] for r in quarantined_rows(df, RULES).collect()} == {-1, None}
    assert rows(rule_counts(df, RULES)) == Counter([("positive", "error", 4, 2), ("small", "warn", 4, 2)])
    assert mark_failures(df, []).first()["failed_rules"] == []
    with pytest.raises(ValueError):
        Rule("x", "true", "fatal")


def test_lineage_fixed_time(spark):
    assert lineage_columns(spark.range(1), "b", datetime(2024, 1, 1)).first()["loaded_at"] == datetime(2024, 1, 1)


def test_split_rows_in_one_pass(spark, path):
    df = spark.createDataFrame([(1, 1), (-1, 2), (None, 3), (200, 4)], "v int, id int")
    rules = [Rule("positive", "v > 0", "error"), Rule("small", "v < 100")]
    good, bad, counts = split_rows(df, rules, path("split"))
    assert good.columns == ["v", "id"] and {r["id"] for r in good.collect()} == {1, 4}
    assert {(r["id"], tuple(r["failed_rules"])) for r in bad.collect()} == {(2, ("positive",)), (3, ("positive", "small"))}
    assert counts == {"checked": 4, "positive": 2, "small": 2}


def test_second_newest_load(spark, path):
    log = spark.sql("SELECT * FROM VALUES ('a', 1, 10, 'MERGE'), ('b', 2, 20, 'MERGE'), ('b', 2, 25, 'MERGE'), ('c', 3, 5, 'WRITE'), "
                    "('d', 4, 30, 'MERGE') AS t(batch, at, mark, op)")
    loads.record_load(loads.load_history(log, "batch", "at", "mark", "op"), path("loads"))
    history = spark.read.parquet(path("loads"))
    assert [(r["batch_id"], r["watermark"], r["rows"]) for r in loads.previous_load(history).collect()] == [("b", 25, 2)]
    assert loads.previous_load(history.where("batch_id = 'a'")).count() == 0


def test_previous_watermark_is_the_tables_as_of_that_load(spark):
    """A late load brings old rows: the greatest watermark seen until then stays the scope."""
    rows = [("a", "MERGE", 1, 10, 5), ("b", "MERGE", 2, 5, 5), ("c", "WRITE", 3, 11, 5), ("d", "MERGE", 4, 12, 5)]
    history = spark.createDataFrame(rows, "batch_id string, operation string, loaded_at int, watermark int, rows long")
    assert [(r.batch_id, r.watermark) for r in loads.previous_load(history).collect()] == [("b", 10)]
    later = history.unionByName(spark.createDataFrame([("e", "MERGE", 5, 9, 1), ("f", "MERGE", 6, None, 1)], history.schema))
    assert [(r.batch_id, r.watermark) for r in loads.previous_load(later).collect()] == [("e", 12)]
    assert loads.previous_load(history, "WRITE").collect() == [] and loads.previous_load(history.limit(0)).collect() == []


def test_upsert_writes_touched_buckets_only(spark, path):
    """What was written reads back, and files of other buckets stay as they are."""
    first = spark.createDataFrame([(i, f"n{i}", 0) for i in range(200)], "id long, name string, size int")
    assert upsert_table(first, path("t"), ["id"], ["name"], buckets=16) == 16
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path('t')}/*/*.parquet")}
    changes = spark.createDataFrame([(3, "new", 7), (1000, "added", 8)], "id long, name string, size int")
    touched = upsert_table(changes, path("t"), ["id"], ["name"], buckets=16)
    assert touched == len({r[0] for r in changes.select(bucket_of(["id"], 16)).collect()}) <= 2
    rows = {r.id: (r["name"], r["size"]) for r in spark.read.parquet(path("t")).collect()}
    assert len(rows) == 201 and rows[3] == ("new", 0) and rows[1000] == ("added", 8) and rows[4] == ("n4", 0)
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path('t')}/*/*.parquet")}
    gone = {os.path.dirname(f) for f in set(before) - set(after)}
    assert len(gone) <= touched and all(after.get(f) == t for f, t in before.items() if os.path.dirname(f) not in gone)
    assert upsert_table(changes.limit(0), path("t"), ["id"], ["name"], buckets=16) == 0
    # Repeating a load changes nothing.
    upsert_table(changes, path("t"), ["id"], ["name"], buckets=16)
    assert spark.read.parquet(path("t")).count() == 201

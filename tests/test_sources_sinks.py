from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tidewell.session import scratch_path, shared_root
from tidewell.sinks import writers
from tidewell.sources import files, tables


def test_incremental_scan_is_strict_and_pushed(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    out = tables.incremental_scan(df, ["o_orderkey", "o_orderdate"], {"o_orderdate": "Day"}, "day ", "1998-01-01")
    assert out.columns == ["o_orderkey", "Day"]
    assert out.where("Day <= timestamp_ntz'1998-01-01'").isEmpty()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in plan and "o_totalprice" not in plan
    assert tables.incremental_scan(df, ["o_orderkey"], {"o_orderdate": "day"}, "day").count() == df.count()
    with pytest.raises(ValueError):
        tables.incremental_scan(df, ["o_orderkey"], {}, "day", "1998-01-01")


def test_watermark_types(spark):
    df = spark.createDataFrame([(1, "a"), (5, "b")], "n bigint, s string")
    assert tables.incremental_scan(df, ["s"], {"n": "n"}, "n", 1).first()["s"] == "b"


def test_high_watermark(spark, path):
    df = spark.createDataFrame([(3,), (None,), (9,)], "w int")
    assert tables.high_watermark(df, "w") == 9
    assert tables.high_watermark(df.where("w is null"), "w", 4) == 4
    assert tables.high_watermark(None, "w", 4) == 4
    assert tables.high_watermark(df) is None
    assert tables.open_table(spark, path("absent")) is None
    assert tables.open_table(spark, "absent_table") is None


def test_current_rows(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "k int, end_at int")
    assert [r["k"] for r in tables.current_rows(df).collect()] == [1]
    assert tables.current_rows(df.drop("end_at")).count() == 2


def test_stage_freezes_rows(spark, path):
    spark.range(3).write.parquet(path("live"))
    live = spark.read.parquet(path("live"))
    staged = tables.stage(live)
    spark.range(7).write.mode("append").parquet(path("live"))
    assert staged.count() == 3
    assert tables.stage(live, enabled=False) is live
    with tables.staged_table(live, "stage_check") as frame:
        assert frame.count() == 3  # the frame listed its files before the append
    assert not spark.catalog.tableExists("stage_check")


def test_shared_root_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_root(spark))


def put(path, name, text, age):
    full = os.path.join(path, name)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "w") as handle:
        handle.write(text)
    os.utime(full, (1_700_000_000 - age, 1_700_000_000 - age))


def test_file_selection(spark, tmp_path):
    root = str(tmp_path)
    put(root, "a/one.csv", "x\n1\n", 10)
    put(root, "a/two.csv", "x\n2\n", 5)
    put(root, "b/three.csv", "x\n3\n", 1)
    put(root, "b/skip_four.csv", "x\n4\n", 0)
    put(root, "a/.hidden.csv", "x\n9\n", 0)

    def names(chosen):
        return sorted(r["name"] for r in chosen.collect())

    assert names(files.select_files(spark, root, "newest_per_dir", ["skip"])) == ["three.csv", "two.csv"]
    assert names(files.select_files(spark, f"{root}/a", "newest")) == ["two.csv"]
    assert names(files.select_files(spark, f"{root}/a", "all")) == ["one.csv", "two.csv"]
    assert names(files.select_files(spark, [f"{root}/a/one.csv", f"{root}/b/three.csv"], "list")) == [
        "one.csv", "three.csv"]
    assert names(files.select_files(spark, f"{root}/a/one.csv", "single")) == ["one.csv"]
    with pytest.raises(ValueError):
        files.select_files(spark, root, "oldest")


def test_read_files(spark, tmp_path):
    root = str(tmp_path)
    put(root, "c/a.csv", 'x,y\n1,"say ""hi"""\n', 0)
    put(root, "c/b.csv", "x,y\n2,z\n", 0)
    df = files.read_files(spark, f"{root}/c")
    assert dict(df.dtypes)["x"] == "int"
    assert {(r["x"], r["y"]) for r in df.collect()} == {(1, 'say "hi"'), (2, "z")}
    put(root, "j/a.json", '[{"a": 1},\n {"a": 2}]', 0)
    assert files.read_files(spark, f"{root}/j/a.json").count() == 2
    put(root, "t/a.txt", "l1\nl2\n", 0)
    assert files.read_files(spark, f"{root}/t").columns == ["value"]
    put(root, "u/a.xyz", "?", 0)
    for bad in (f"{root}/u", f"{root}/u/a.xyz"):
        with pytest.raises(ValueError):
            files.read_files(spark, bad)
    os.makedirs(f"{root}/empty")
    with pytest.raises(ValueError, match="No readable file"):
        files.read_files(spark, f"{root}/empty")


def test_writers_check_their_arguments(spark, path):
    df = spark.range(5).withColumn("g", F.col("id") % 2)
    for columns, layout in ((["nope"], "partition"), (["nope"], "cluster"), (["g"], ""), (["id"] * 5, "cluster")):
        with pytest.raises(ValueError):
            writers.write(df, path("out"), columns, layout)
    assert not os.path.exists(path("out"))
    writers.write(df, path("out"))
    writers.write(df, path("out"))
    assert spark.read.parquet(path("out")).count() == 10


def test_partitioned_and_clustered_layout(spark, path):
    df = spark.range(0, 4000, 1, 8).withColumn("g", F.col("id") % 3)
    writers.write(df, path("p"), ["g"], "partition")
    assert sorted(d for d in os.listdir(path("p")) if d.startswith("g=")) == ["g=0", "g=1", "g=2"]
    hot = df.withColumn("c", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tiny partitions would be merged
    try:
        parts = writers.clustered(hot, ["c"]).withColumn("p", F.spark_partition_id())
        spread = parts.where("c = 7").groupBy("p").count().collect()
        ranges = parts.groupBy("p").agg(F.min("c").alias("a"), F.max("c").alias("b")).orderBy("p").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(spread) > 1  # one frequent value does not fill one task
    assert all(x["b"] <= y["a"] for x, y in zip(ranges, ranges[1:]))


def test_create_empty(spark, path):
    schema = spark.range(1).schema
    writers.create_empty(spark, path("e"), schema)
    assert spark.read.parquet(path("e")).dtypes == [("id", "bigint")] and spark.read.parquet(path("e")).isEmpty()
    writers.create_empty(spark, "made_empty", schema)
    assert spark.table("made_empty").count() == 0
    writers.append(spark.range(2), "made_empty")
    writers.create_empty(spark, "made_empty", schema)
    assert spark.table("made_empty").count() == 2

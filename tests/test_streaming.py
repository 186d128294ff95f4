from __future__ import annotations

import os
import random
from collections import Counter

import pytest

from tidewell.functions.types import declared_schema
from tidewell.operators.scd import scd1, scd2
from tidewell.operators.sets import dedup_stream
from tidewell.operators.transforms import ColumnSpec
from tidewell.sources.files import file_stream
from tidewell.streaming.apply_changes import ChangeApplier
from tidewell.streaming.ingest import ingest_stream, write_stream

SCHEMA = "k string, seq int, op string, v string"


def rows(df):
    return Counter(tuple(r) for r in df.select("k", "seq", "v").collect())


def make_log(seed, size=120):
    rng = random.Random(seed)
    return [(f"k{rng.randrange(12)}", seq, "DELETE" if rng.random() < 0.3 else "UPSERT", f"v{seq}")
            for seq in range(size)]


@pytest.mark.parametrize("mode", ["SCD_1", "SCD_2"])
def test_any_arrival_order_gives_the_batch_answer(spark, path, mode):
    items = make_log(1)
    whole = spark.createDataFrame(items, SCHEMA)
    expected = (scd1 if mode == "SCD_1" else scd2)(whole, ["k"], ["seq"], "op", ["op"])
    for seed in (2, 3):
        shuffled = items[:]
        random.Random(seed).shuffle(shuffled)
        applier = ChangeApplier(spark, path(f"{mode}{seed}"), ["k"], ["seq"], mode, "op", ["op"])
        for i in range(0, len(shuffled), 45):
            applier.apply(spark.createDataFrame(shuffled[i:i + 45], SCHEMA), str(i), "q")
        applier.apply(spark.createDataFrame(shuffled[45:90], SCHEMA), "45", "q")  # delivered again
        if seed == 3:
            applier.compact()
            applier.apply(spark.createDataFrame(shuffled[:45], SCHEMA), "0", "q")  # even after it was compacted
        found = applier.table()
        assert rows(found) == rows(expected)
        if mode == "SCD_2":
            ends = Counter((r["k"], r["start_at"], r["end_at"]) for r in found.collect())
            assert ends == Counter((r["k"], r["start_at"], r["end_at"]) for r in expected.collect())


def test_delete_before_its_change(spark, path):
    applier = ChangeApplier(spark, path("s"), ["k"], ["seq"], "SCD_1", "op", ["op"])
    applier.apply(spark.createDataFrame([("a", 5, "DELETE", None)], SCHEMA))
    applier.apply(spark.createDataFrame([("a", 3, "UPSERT", "late")], SCHEMA))
    assert applier.table().isEmpty()
    applier.compact()
    applier.apply(spark.createDataFrame([("a", 4, "UPSERT", "late too")], SCHEMA))
    assert applier.table().isEmpty()  # the delete outlives compaction
    applier.apply(spark.createDataFrame([("a", 7, "UPSERT", "back")], SCHEMA))
    assert rows(applier.table()) == Counter([("a", 7, "back")])


def test_modes_are_checked(spark, path):
    with pytest.raises(ValueError):
        ChangeApplier(spark, path("s"), ["k"], ["seq"], "append")


def test_stream_restart_resumes(spark, path):
    items = make_log(4)
    applier = ChangeApplier(spark, path("store"), ["k"], ["seq"], "SCD_2", "op", ["op"])
    assert applier.table() is None
    for part in (items[60:], items[:60]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path("in"))
        stream = file_stream(spark, path("in"), schema=spark.createDataFrame([], SCHEMA).schema)
        applier.run(stream, path("cp"), "restarted")
    expected = scd2(spark.createDataFrame(items, SCHEMA), ["k"], ["seq"], "op", ["op"])
    assert rows(applier.table()) == rows(expected)
    assert len(applier.folders()) == 2


def files_of(root):
    return {os.path.join(at, name): os.stat(os.path.join(at, name)).st_mtime_ns
            for at, _, names in os.walk(root) for name in names}


@pytest.mark.parametrize("mode", ["SCD_1", "SCD_2"])
def test_a_small_batch_leaves_older_files_alone(spark, path, mode):
    applier = ChangeApplier(spark, path("h"), ["k"], ["seq"], mode, "op", ["op"])
    for i in range(3):
        applier.apply(spark.createDataFrame(make_log(i), SCHEMA), str(i), "a/b: c")
    before = files_of(path("h"))
    applier.apply(spark.createDataFrame([("k0", 500, "UPSERT", "new")], SCHEMA), "3", "a/b: c")
    after = files_of(path("h"))
    assert {name: after.get(name) for name in before} == before and len(after) > len(before)
    whole = spark.createDataFrame([row for i in range(3) for row in make_log(i)] + [("k0", 500, "UPSERT", "new")], SCHEMA)
    expected = (scd1 if mode == "SCD_1" else scd2)(whole, ["k"], ["seq"], "op", ["op"])
    assert Counter(map(tuple, applier.table().collect())) == Counter(map(tuple, expected.collect()))
    applier.compact()
    applier.compact()
    assert len(applier.folders()) == 1
    assert Counter(map(tuple, applier.table().collect())) == Counter(map(tuple, expected.collect()))


def test_two_streams_and_an_empty_batch(spark, path):
    applier = ChangeApplier(spark, path("h"), ["k"], ["seq"], "SCD_1")
    applier.apply(spark.createDataFrame([], SCHEMA), "0", "left")
    assert applier.table().isEmpty()
    applier.apply(spark.createDataFrame([("a", 1, "UPSERT", "x"), (None, 1, "UPSERT", "no key")], SCHEMA), "0", "right")
    applier.apply(spark.createDataFrame([("a", None, "UPSERT", "no sequence")], SCHEMA), "1", "left")
    assert rows(applier.table()) == Counter([("a", 1, "x"), (None, 1, "no key")])


SPECS = [ColumnSpec("k", "k", "string"), ColumnSpec("n", "seq", "bigint")]


def test_ingest_is_exactly_once_per_checkpoint(spark, path):
    df = spark.createDataFrame(make_log(6), SCHEMA)
    df.write.parquet(path("in"))

    def run():
        stream = file_stream(spark, path("in"), {"cloudFiles.format": "parquet", "cloudFiles.maxFilesPerTrigger": "1"},
                             df.schema)
        ingest_stream(stream, SPECS, path("out"), "b1", ["k"], options={"checkpointLocation": path("cp")})
        return spark.read.parquet(path("out")).count()

    assert run() == run() == 120
    df.write.mode("append").parquet(path("in"))
    assert run() == 240


def test_csv_stream_with_declared_schema(spark, path):
    spark.sql("SELECT 1 AS id, 'a,b' AS name, '2024-01-01 00:00:00' AS at").write.option("header", "true").csv(path("in"))
    schema = declared_schema([("id", "int"), ("name", "varchar(9)"), ("at", "timestamp")])
    options = {"cloudFiles.format": "csv", "header": "true"}
    stream = file_stream(spark, path("in"), options, schema)
    ingest_stream(stream, [ColumnSpec("id", "id", "bigint"), ColumnSpec("who", derived="upper(name)")], path("out"), "b",
                  trigger="once", options={"checkpointLocation": path("cp")})
    row = spark.read.parquet(path("out")).first()
    assert (row["id"], row["who"], row["batch_id"]) == (1, "A,B", "b") and row["loaded_at"] is not None


def test_stream_to_table_and_arguments(spark, path):
    df = spark.createDataFrame(make_log(6), SCHEMA)
    df.write.parquet(path("in"))
    stream = file_stream(spark, path("in"), schema=df.schema)
    with pytest.raises(KeyError):
        write_stream(stream, "streamed")
    for trigger in ("hourly", "processingTime"):
        with pytest.raises(ValueError):
            write_stream(stream, "streamed", trigger=trigger, options={"checkpointLocation": path("cp")})
    write_stream(stream, "streamed", options={"checkpointLocation": path("cp")})
    assert spark.table("streamed").count() == 120


def test_streaming_dedup(spark, path):
    df = spark.sql("SELECT id % 5 AS k, timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id) AS at FROM range(50)")
    df.coalesce(1).write.parquet(path("in"))
    stream = dedup_stream(file_stream(spark, path("in"), schema=df.schema), ["k"], "at", "10 minutes")
    write_stream(stream, path("out"), options={"checkpointLocation": path("cp")})
    assert spark.read.parquet(path("out")).count() == 5

"""Upsert without a table format: the merged table as one DataFrame, or written back where it changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.errors import AnalysisException

from tidewell.operators.skew import apart, distinct_apart, drop_apart
from tidewell.session import scratch_path

BUCKET_COLUMN = "key_bucket"


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                 update_columns: Sequence[str], insert_columns: Sequence[str] | None = None) -> DataFrame:
    """Target rows with ``update_columns`` taken from the matching update.

    Updates without a match are added with ``insert_columns`` (default: all of
    theirs), other columns null.  Two updates for one key are an error, raised
    while the job runs.  Null keys match nothing.
    """
    insert_columns = list(insert_columns or updates.columns)
    carried = [name for name in updates.columns if name not in keys]
    single = drop_apart(apart(updates, keys).agg(
        F.first(F.struct(*carried)).alias("__new"), F.count(F.lit(1)).alias("__n")))
    keyed = F.lit(True)
    for key in keys:
        keyed = keyed & F.col(key).isNotNull()
    repeated = keyed & (F.col("__n") > 1)
    single = single.where(keyed).withColumn("__new", F.when(
        repeated, F.raise_error(F.lit("More than one update for a key"))).otherwise(F.col("__new"))).drop("__n")

    matched = target.join(single, list(keys), "left").select(*[
        F.when(F.col("__new").isNotNull(), F.col("__new")[name]).otherwise(F.col(name)).alias(name)
        if name in update_columns else F.col(name)
        for name in target.columns
    ])
    known = distinct_apart(target, keys)
    fresh = updates.join(known, list(keys), "left_anti").select(*[
        (F.col(name) if name in insert_columns else F.lit(None)).cast(target.schema[name].dataType).alias(name)
        for name in target.columns
    ])
    return matched.unionByName(fresh)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET_COLUMN)


def upsert_table(updates: DataFrame, path: str, keys: Sequence[str], update_columns: Sequence[str],
                 insert_columns: Sequence[str] | None = None, buckets: int = 64) -> int:
    """:func:`merge_upsert` into the parquet table at ``path``, created if absent; returns the number of buckets rewritten.

    The table is partitioned by a bucket of the keys' hash, the same ``buckets`` at every call.  Only buckets that an update falls into are
    read and, by dynamic partition overwrite, replaced; all others keep their files.  The merged rows are
    first written to the shared scratch folder, as a table cannot be read while it is overwritten; a
    job that fails before that leaves the table as it was, and repeating an upsert changes nothing.
    """
    spark = updates.sparkSession
    placed = updates.select(bucket_of(keys, buckets)).distinct()
    touched = [row[0] for row in placed.collect()]
    if not touched:
        return 0
    try:
        target = spark.read.parquet(path)
    except AnalysisException:
        target = updates.where("false").withColumn(BUCKET_COLUMN, F.lit(0))
    merged = merge_upsert(target.where(F.col(BUCKET_COLUMN).isin(touched)).drop(BUCKET_COLUMN), updates, keys, update_columns, insert_columns)
    staged = scratch_path(spark, "upsert")
    merged.write.parquet(staged)
    (spark.read.schema(merged.schema).parquet(staged).withColumn(BUCKET_COLUMN, bucket_of(keys, buckets))
     .hint("rebalance", F.col(BUCKET_COLUMN)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET_COLUMN).parquet(path))
    return len(touched)

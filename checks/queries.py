"""Registered queries: each runs one operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import frames
from checks.frames import table
from tidewell.functions.hashing import add_row_hashes, canonical_strings
from tidewell.functions.types import declared_schema
from tidewell.operators import cdc, scd, sets
from tidewell.operators.expectations import Rule, mark_failures, quarantined_rows, rule_counts
from tidewell.operators.merge import merge_upsert, upsert_table
from tidewell.operators.transforms import (
    ColumnSpec,
    add_constants,
    clean_names,
    derive_columns,
    lineage_columns,
    rename_columns,
    select_columns,
    transform_map,
)
from tidewell.plans import keys, loads, profile, reconcile, usage
from tidewell.plans.alerts import evaluate_alerts
from tidewell.plans.raw_load import change_log
from tidewell.plans.runs import freshness, run_status
from tidewell.session import scratch_path
from tidewell.sinks import writers
from tidewell.sources import files, tables
from tidewell.streaming.apply_changes import ChangeApplier
from tidewell.streaming.ingest import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

LOADED_AT = datetime(2024, 2, 1, 12, 0, 0)
CUTOFF = datetime(1998, 1, 1)
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDER_ALIASES = {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderdate": "ordered_at"}


def query(function: Query) -> Query:
    """Register a query under its function name, less a trailing underscore."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    REGISTRY[function.__name__.rstrip("_")] = run
    return function


# --- scans and files ---------------------------------------------------------

@query
def scan_aliased(spark, sf_dir):
    return tables.aliased_scan(table(spark, sf_dir, "orders"), ORDER_COLUMNS, ORDER_ALIASES)


@query
def scan_incremental(spark, sf_dir):
    return tables.incremental_scan(table(spark, sf_dir, "orders"), ORDER_COLUMNS, ORDER_ALIASES,
                                   " Ordered_At ", "1998-01-01")


@query
def high_watermark(spark, sf_dir):
    return tables.high_watermark_frame(frames.orders_yesterday(spark, sf_dir), "o_orderdate", "1990-01-01")


@query
def staged_scan(spark, sf_dir):
    return tables.stage(tables.aliased_scan(table(spark, sf_dir, "orders"), ORDER_COLUMNS, ORDER_ALIASES))


@query
def current_rows(spark, sf_dir):
    return tables.current_rows(scd2(spark, sf_dir))


def _written_customers(spark, sf_dir, fmt, **options):
    path = scratch_path(spark, f"customer-{fmt}")
    table(spark, sf_dir, "customer").write.format(fmt).options(**options).save(path)
    return path


@query
def typed_read(spark, sf_dir):
    schema = declared_schema([("c_custkey", "long"), ("c_name", "nvarchar(40)"), ("c_nationkey", "short"),
                              ("c_acctbal", "decimal(19,2)"), ("c_mktsegment", "varchar(10)", False)])
    path = _written_customers(spark, sf_dir, "csv", header="true")
    return files.read_files(spark, path, schema=schema)


@query
def read_files_csv(spark, sf_dir):
    return files.read_files(spark, _written_customers(spark, sf_dir, "csv", header="true"))


@query
def read_files_json(spark, sf_dir):
    path = _written_customers(spark, sf_dir, "json")
    return files.read_files(spark, path, options={"multiline": "false"})


@query
def latest_file_per_dir(spark, sf_dir):
    path = scratch_path(spark, "waves")
    customers = table(spark, sf_dir, "customer").withColumn("nation", F.col("c_nationkey"))
    for wave in (1, 2):
        wave_rows = customers.withColumn("wave", F.lit(wave))
        wave_rows.repartition("nation").write.mode("append").partitionBy("nation").parquet(path)
    newest = [row["path"] for row in files.select_files(spark, path, "newest_per_dir").select("path").collect()]
    return spark.read.parquet(*newest).select("c_custkey", "c_nationkey", "c_acctbal", "wave")


# --- column work -------------------------------------------------------------

CUSTOMER_MAP = [
    ColumnSpec("customer_id", "c_custkey", "int"),
    ColumnSpec("name", "c_name", "varchar(25)"),
    ColumnSpec("balance", "c_acctbal", "decimal(19,2)"),
    ColumnSpec("segment", derived="upper(c_mktsegment)"),
    ColumnSpec("label", derived="concat(segment, '-', customer_id)"),
]


@query
def transform_map_(spark, sf_dir):
    return transform_map(table(spark, sf_dir, "customer"), CUSTOMER_MAP)


@query
def transform_derived_only(spark, sf_dir):
    specs = [ColumnSpec("segment", derived="lower(c_mktsegment)"), ColumnSpec("in_debt", derived="c_acctbal < 0"),
             ColumnSpec("ignored", "c_name", "string")]
    return derive_columns(table(spark, sf_dir, "customer"), specs)


@query
def select_columns_(spark, sf_dir):
    keep = {"o_orderpriority": True, "o_orderkey": True, "o_totalprice": True, "o_custkey": False}
    return select_columns(table(spark, sf_dir, "orders"), keep)


@query
def clean_names_(spark, sf_dir):
    messy = table(spark, sf_dir, "customer").toDF("c (key)", "c, name", "c|nation", "c acct bal", "c_mktsegment")
    return clean_names(messy)


@query
def rename_columns_(spark, sf_dir):
    return rename_columns(table(spark, sf_dir, "customer"), {"c_custkey": "id", "c_name": "name"}, {"c_custkey": "no"})


@query
def add_constants_(spark, sf_dir):
    return add_constants(table(spark, sf_dir, "customer"), {"origin": "upper(c_name)", "rank": 7})


@query
def lineage_cols(spark, sf_dir):
    return lineage_columns(table(spark, sf_dir, "orders"), "job-1", F.lit(LOADED_AT).cast("timestamp_ntz"))


@query
def canonical_strings_(spark, sf_dir):
    return canonical_strings(frames.mixed_types(spark, sf_dir))


@query
def row_hashes(spark, sf_dir):
    return add_row_hashes(frames.mixed_types(spark, sf_dir), ["priority", "o_orderkey"])


# --- change capture ----------------------------------------------------------

def _sides(spark, sf_dir, keys=("o_orderkey",)):
    return (add_row_hashes(table(spark, sf_dir, "orders"), keys),
            add_row_hashes(frames.orders_yesterday(spark, sf_dir), keys))


def _recent(df):
    return df.where(F.col("o_orderdate") > F.lit(CUTOFF).cast("timestamp_ntz"))


@query
def cdc_snapshot(spark, sf_dir):
    source, target = _sides(spark, sf_dir)
    return cdc.classify_changes(source, target)


@query
def cdc_incremental(spark, sf_dir):
    source, target = _sides(spark, sf_dir)
    return cdc.classify_changes(_recent(source), target, incremental=True)


@query
def cdc_no_key(spark, sf_dir):
    source, target = _sides(spark, sf_dir, ())
    return cdc.classify_changes(source, target, keyed=False)


@query
def cdc_no_key_incremental(spark, sf_dir):
    source, target = _sides(spark, sf_dir, ())
    return cdc.classify_changes(_recent(source), target, keyed=False, incremental=True)


@query
def cdc_initial(spark, sf_dir):
    return cdc.initial_changes(_sides(spark, sf_dir)[0])


@query
def cdc_duplicate_keys(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    source = add_row_hashes(table(spark, sf_dir, "lineitem"), keys)
    target = add_row_hashes(frames.lineitem_yesterday(spark, sf_dir), keys)
    return cdc.classify_changes(source, target, count_matches=True)


@query
def raw_change_log(spark, sf_dir):
    target = add_row_hashes(transform_map(frames.orders_yesterday(spark, sf_dir), ORDER_MAP), ["order_id"])
    return change_log(table(spark, sf_dir, "orders"), target, ORDER_MAP, ["order_id"], batch_id="job-1",
                      loaded_at=F.lit(LOADED_AT).cast("timestamp_ntz"), deduplicate=True)


@query
def load_unchanged(spark, sf_dir):
    """Rows of three loads into the log: all, what changed, and nothing for an unchanged source."""
    def history(log):
        folded = scd.scd1(log, ["row_key_hash"], ["loaded_at"], op="change_op", exclude=["change_op"])
        return folded.drop("batch_id", "loaded_at")

    def load(source, known, batch, day):
        return change_log(source, known, ORDER_MAP, ["order_id"], batch_id=batch,
                          loaded_at=F.lit(LOADED_AT + timedelta(days=day)).cast("timestamp_ntz"))

    today = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "log")
    for day, (batch, source) in enumerate((("first", frames.orders_yesterday(spark, sf_dir)), ("second", today), ("third", today))):
        known = history(spark.read.parquet(path)) if day else None
        load(source, known, batch, day).write.mode("append").parquet(path)
    return spark.read.parquet(path).groupBy("batch_id", "change_op").agg(F.count(F.lit(1)).alias("rows"))


ORDER_MAP = [
    ColumnSpec("order_id", "o_orderkey", "bigint"),
    ColumnSpec("status", "o_orderstatus", "char(1)"),
    ColumnSpec("price", "o_totalprice", "decimal(19,2)"),
    ColumnSpec("is_open", derived="status = 'O'"),
]


# --- sets --------------------------------------------------------------------

@query
def union_by_name(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    turned = frames.orders_yesterday(spark, sf_dir).select(*reversed(ORDER_COLUMNS))
    return sets.union_by_name(orders, orders.where("false"), turned)


@query
def dedup_key(spark, sf_dir):
    return sets.dedup(table(spark, sf_dir, "documents"), ["text", ""], order=["doc_id"])


@query
def dedup_exclude(spark, sf_dir):
    return sets.dedup(table(spark, sf_dir, "documents"), exclude=["doc_id", "source"], order=["doc_id"])


@query
def dedup_all(spark, sf_dir):
    return sets.dedup(table(spark, sf_dir, "documents").drop("doc_id"), [""])


# --- history -----------------------------------------------------------------

@query
def scd1(spark, sf_dir):
    return scd.scd1(frames.change_events(spark, sf_dir), ["user_id"], ["ts"], "change_op", ["change_op"])


@query
def scd1_no_op(spark, sf_dir):
    log = frames.change_events(spark, sf_dir).drop("change_op")
    return scd.scd1(log, ["user_id"], ["ts"], "change_op")


@query
def scd2(spark, sf_dir):
    return scd.scd2(frames.change_events(spark, sf_dir), ["user_id"], ["ts"], "change_op", ["change_op"])


@query
def scd_sequence_ties(spark, sf_dir):
    """Orders as changes of their customers: several may fall on one day."""
    return scd.sequence_ties(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate"])


@query
def merge_upsert_(spark, sf_dir):
    target = table(spark, sf_dir, "customer").select(
        F.lit("main").alias("catalog"), F.col("c_custkey").alias("table_id"), F.col("c_name").alias("primary_key"),
        F.col("c_mktsegment").alias("unique_columns"), F.lit(0).cast("bigint").alias("record_count"))
    updates = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") * 2).alias("table_id")).agg(
        F.max("o_orderpriority").alias("primary_key"), F.min("o_orderpriority").alias("unique_columns"),
        F.count(F.lit(1)).alias("record_count")).withColumn("catalog", F.lit("main"))
    # Both are written: the table first, then the buckets that the updates touch.
    path = scratch_path(spark, "report")
    upsert_table(target, path, ["catalog", "table_id"], [])
    upsert_table(updates, path, ["catalog", "table_id"], ["primary_key", "record_count"])
    return spark.read.parquet(path).select(*target.columns)


def _load_history(spark, sf_dir):
    """Monthly loads of orders, one append per operation: every fifth month counts as a rewrite."""
    orders = table(spark, sf_dir, "orders").withColumn("batch", F.date_format("o_orderdate", "yyyy-MM"))
    path = scratch_path(spark, "loads")
    merged = F.when(F.month("o_orderdate") % 5 == 0, "WRITE").otherwise("MERGE")
    history = loads.load_history(orders, "batch", "o_orderdate", "o_orderdate", merged)
    for operation in ("WRITE", "MERGE"):
        loads.record_load(history.where(F.col("operation") == operation), path)
    return spark.read.parquet(path)


@query
def previous_version(spark, sf_dir):
    return loads.previous_load(_load_history(spark, sf_dir)).select("batch_id", "operation")


@query
def previous_watermark(spark, sf_dir):
    return loads.previous_load(_load_history(spark, sf_dir)).select("watermark", "rows")


@query
def qc_incremental(spark, sf_dir):
    mark = loads.previous_load(_load_history(spark, sf_dir)).first()
    source, target = reconcile.qc_scope(frames.orders_yesterday(spark, sf_dir), table(spark, sf_dir, "orders"), "o_orderdate",
                                        mark["watermark"] if mark else None, first_load=mark is None)
    return reconcile.compare_layers(add_row_hashes(source, ["o_orderkey"]), add_row_hashes(target, ["o_orderkey"]))


# --- reconciliation ----------------------------------------------------------

@query
def qc_counts(spark, sf_dir):
    source, target = _sides(spark, sf_dir)
    return reconcile.count_check(source, target.unionByName(target))


@query
def qc_subtract(spark, sf_dir):
    return reconcile.hash_differences(*_sides(spark, sf_dir))


@query
def qc_mismatch_rows(spark, sf_dir):
    return reconcile.mismatch_rows(*_sides(spark, sf_dir))


@query
def diff_rows_strings(spark, sf_dir):
    return reconcile.text_differences(table(spark, sf_dir, "orders"), frames.orders_yesterday(spark, sf_dir))


@query
def diff_rows_copies(spark, sf_dir):
    left = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount")
    right = frames.lineitem_yesterday(spark, sf_dir).select(*left.columns)
    return reconcile.text_differences(left, right, every_copy=True)


@query
def diff_rows_whole_copies(spark, sf_dir):
    """Whole line items, every copy counted."""
    return reconcile.text_differences(table(spark, sf_dir, "lineitem"), frames.lineitem_yesterday(spark, sf_dir), every_copy=True)


def _missing():
    raise ValueError("no such table")


@query
def qc_results(spark, sf_dir):
    source, target = _sides(spark, sf_dir)
    checks = [
        reconcile.TableCheck("orders", "orders_history", lambda: source, lambda: target, "o_orderdate"),
        reconcile.TableCheck("orders", "orders_copy", lambda: source, lambda: source),
        reconcile.TableCheck("nowhere", "orders_history", _missing, lambda: target),
    ]
    path = scratch_path(spark, "results")
    reconcile.append_results(reconcile.run_qc(spark, checks[:1], "run-1", LOADED_AT), path)
    reconcile.append_results(reconcile.run_qc(spark, checks[1:], "run-1", LOADED_AT), path)
    return spark.read.parquet(path).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query
def qc_durations(spark, sf_dir):
    return reconcile.check_durations(frames.qc_log(spark, sf_dir))


@query
def qc_duration_buckets(spark, sf_dir):
    return reconcile.duration_buckets(qc_durations(spark, sf_dir))


RULES = [Rule("balance_known", "c_acctbal >= 0", "error"), Rule("not_machinery", "c_mktsegment <> 'MACHINERY'"),
         Rule("segment_listed", "nullif(c_mktsegment, 'BUILDING') IS NOT NULL", "error"),
         Rule("unknown_is_bad", "nullif(c_nationkey, 5) > 0")]


@query
def expectations(spark, sf_dir):
    marked = mark_failures(table(spark, sf_dir, "customer"), RULES)
    return marked.withColumn("failed_rules", F.concat_ws(",", "failed_rules"))


@query
def expectation_counts(spark, sf_dir):
    return rule_counts(table(spark, sf_dir, "customer"), RULES)


@query
def quarantine(spark, sf_dir):
    bad = quarantined_rows(table(spark, sf_dir, "customer"), RULES)
    return bad.withColumn("failed_rules", F.concat_ws(",", "failed_rules"))


# --- usage and operations reports --------------------------------------------

@query
def daily_utilisation(spark, sf_dir):
    return usage.daily_utilisation(frames.node_samples(spark, sf_dir), (3, 6))


@query
def clip_intervals(spark, sf_dir):
    return usage.daily_utilisation(frames.node_samples(spark, sf_dir), (3, 6), clip=True).select(
        "date", "cluster_id", "instance_id", "total_active_minutes")


@query
def threshold_counts(spark, sf_dir):
    return usage.threshold_counts(usage.daily_utilisation(frames.node_samples(spark, sf_dir), (3, 6), clip=True))


@query
def idle_minutes(spark, sf_dir):
    return usage.idle_minutes(frames.node_samples(spark, sf_dir), (3, 6))


@query
def active_per_minute(spark, sf_dir):
    samples = frames.node_samples(spark, sf_dir).withColumn("start_time", F.date_trunc("MINUTE", "start_time").cast("timestamp_ntz"))
    return usage.active_nodes(samples, (5, 30), (9, 12))


@query
def run_bounds(spark, sf_dir):
    return usage.run_bounds(frames.run_periods(spark, sf_dir), ["run_id", "cluster_id"])


@query
def samples_in_run(spark, sf_dir):
    bounds = run_bounds(spark, sf_dir)
    return usage.samples_in_spans(frames.node_samples(spark, sf_dir), bounds, ["cluster_id"])


@query
def run_quartiles(spark, sf_dir):
    found = usage.run_quartiles(frames.node_samples(spark, sf_dir), run_bounds(spark, sf_dir), workers_only=True)
    return found.select("run_id", "start_time", "instance_id", "quadrant")


@query
def quartile_by_interval(spark, sf_dir):
    found = usage.quartile_by_interval(frames.node_samples(spark, sf_dir))
    return found.select("cluster_id", "instance_id", "start_time", "min_start_time", "max_end_time", "quadrant")


@query
def bucket_report(spark, sf_dir):
    found = usage.run_quartiles(frames.node_samples(spark, sf_dir), run_bounds(spark, sf_dir))
    return usage.bucket_report(found, ["run_id", "quadrant"])


@query
def cluster_idle_peak(spark, sf_dir):
    return usage.idle_and_peak(frames.cluster_changes(spark, sf_dir))


@query
def run_status_(spark, sf_dir):
    return run_status(frames.task_runs(spark, sf_dir), hidden="notify_teams")


@query
def freshness_(spark, sf_dir):
    return freshness(table(spark, sf_dir, "events"), "ts", datetime(2024, 1, 31, 4, 30), "America/Chicago")


@query
def alerts(spark, sf_dir):
    return evaluate_alerts(*frames.alert_frames(spark, sf_dir))


# --- keys and profiles -------------------------------------------------------

@query
def declared_keys(spark, sf_dir):
    return keys.declared_keys(*frames.constraint_frames(spark, sf_dir))


@query
def key_check(spark, sf_dir):
    lines = keys.key_checks(table(spark, sf_dir, "lineitem"), [["l_orderkey", "l_linenumber"], ["l_orderkey"]])
    orders = keys.key_checks(table(spark, sf_dir, "orders"), [["o_orderkey"], ["o_custkey", "o_orderdate"]])
    return lines.unionByName(orders).unionByName(
        keys.key_check(frames.mixed_types(spark, sf_dir), ["o_orderkey", "priority"]))


KEY_TABLES = ("customer", "nation", "orders")


@query
def ucc_discovery(spark, sf_dir):
    found = [keys.unique_sets_frame(spark, keys.find_unique_sets(table(spark, sf_dir, name)))
             .withColumn("table_name", F.lit(name)) for name in KEY_TABLES]
    return sets.union_by_name(*found)


@query
def ucc_discovery_lineitem(spark, sf_dir):
    """Its 2,047 column sets are too many for SQL; tests compare the search with brute force."""
    return keys.unique_sets_frame(spark, keys.find_unique_sets(table(spark, sf_dir, "lineitem")))


def _dependencies(spark, sf_dir, name):
    return keys.dependencies_frame(spark, keys.find_dependencies(table(spark, sf_dir, name)))


@query
def fd_discovery(spark, sf_dir):
    return sets.union_by_name(*[_dependencies(spark, sf_dir, name).withColumn("table_name", F.lit(name))
                                for name in KEY_TABLES])


@query
def fd_discovery_lineitem(spark, sf_dir):
    """Dependencies of any size; too many candidates for SQL, so tests compare the search with brute force."""
    return _dependencies(spark, sf_dir, "lineitem")


@query
def key_ranking(spark, sf_dir):
    found = [
        keys.rank_keys(keys.unique_sets_frame(spark, keys.find_unique_sets(table(spark, sf_dir, name))),
                       _dependencies(spark, sf_dir, name)).withColumn("table_name", F.lit(name))
        for name in KEY_TABLES
    ]
    return sets.union_by_name(*found)


@query
def profile_keys(spark, sf_dir):
    rows = [(name, *keys.recommend_key(table(spark, sf_dir, name)).values()) for name in KEY_TABLES]
    return spark.createDataFrame(rows, "table_name string, unique_columns string, primary_key string, message string")


@query
def watermark_discovery(spark, sf_dir):
    events = frames.timed_events(spark, sf_dir)
    now = datetime(2024, 6, 1)
    chosen, _ = profile.find_watermark_column(events, now)
    return profile.watermark_measures(events, now).withColumn("chosen", F.col("column_name") == chosen)


@query
def table_profile(spark, sf_dir):
    readers = {"events": lambda: frames.timed_events(spark, sf_dir), "orders": lambda: table(spark, sf_dir, "orders"),
               "customer": lambda: table(spark, sf_dir, "customer"),
               "empty": lambda: table(spark, sf_dir, "orders").where("false"),
               "missing": lambda: table(spark, sf_dir, "no_such_table")}
    found = profile.profile_tables(spark, readers, "main", "sales", "watermark", now=datetime(2024, 6, 1))
    keyed = profile.profile_tables(spark, {"customer": readers["customer"]}, "main", "sales", "keys")
    return merge_upsert(found, keyed, ["catalog", "schema", "table_name"],
                        ["primary_key", "unique_columns", "key_message", "record_count"])


@query
def column_stats(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    names = profile.stats_columns(orders.schema, required=["o_orderkey"], exclude=["o_totalprice"])
    return profile.column_stats(orders, F.year("o_orderdate"), names)


# --- sinks -------------------------------------------------------------------

@query
def sink_append(spark, sf_dir):
    path = scratch_path(spark, "append")
    writers.append(table(spark, sf_dir, "orders"), path)
    writers.append(frames.orders_yesterday(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def sink_overwrite(spark, sf_dir):
    path = scratch_path(spark, "overwrite")
    writers.overwrite(frames.orders_yesterday(spark, sf_dir), path)
    writers.overwrite(table(spark, sf_dir, "orders"), path)
    return spark.read.parquet(path)


@query
def sink_partitioned(spark, sf_dir):
    path = scratch_path(spark, "partitioned")
    writers.write(table(spark, sf_dir, "orders"), path, ["o_orderpriority", "o_orderstatus"], "partition")
    return spark.read.parquet(path)


@query
def sink_clustered(spark, sf_dir):
    path = scratch_path(spark, "clustered")
    writers.write(table(spark, sf_dir, "orders"), path, ["o_custkey", "o_orderdate"], "cluster")
    return spark.read.parquet(path)


@query
def sink_empty_schema(spark, sf_dir):
    path = scratch_path(spark, "created")
    orders = table(spark, sf_dir, "orders")
    writers.create_empty(spark, path, orders.schema)
    writers.append(orders, path)
    writers.create_empty(spark, path, orders.schema)
    return spark.read.parquet(path)


# --- streams -----------------------------------------------------------------

def _event_files(spark, sf_dir, columns=None):
    """Events as four files whose times overlap, so arrival is out of order."""
    path = scratch_path(spark, "event-files")
    events = table(spark, sf_dir, "events") if columns is None else columns(spark, sf_dir)
    events.repartition(4, F.xxhash64("ts")).write.parquet(path)
    return path, events.schema


@query
def stream_file_ingest(spark, sf_dir):
    path, schema = _event_files(spark, sf_dir)
    target = scratch_path(spark, "ingested")
    specs = [ColumnSpec("event_id", "event_id", "bigint"), ColumnSpec("seen_at", "ts", "timestamp_ntz"),
             ColumnSpec("kind", derived="upper(event_type)"), ColumnSpec("amount", "value", "double")]
    options = {"checkpointLocation": scratch_path(spark, "ingest-checkpoint")}
    for _ in range(2):  # the second run finds nothing new
        stream = files.file_stream(spark, path, {"cloudFiles.format": "parquet", "maxFilesPerTrigger": "1"}, schema)
        ingest_stream(stream, specs, target, "job-1", ["event_id"], F.lit(LOADED_AT).cast("timestamp_ntz"),
                      options=options)
    return spark.read.parquet(target)


def _applied(spark, sf_dir, mode, op="change_op"):
    path, schema = _event_files(spark, sf_dir, frames.change_events)
    applier = ChangeApplier(spark, scratch_path(spark, "history"), ["user_id"], ["ts"], mode, op, ["change_op"])
    stream = files.file_stream(spark, path, {"maxFilesPerTrigger": "2"}, schema)
    applier.run(stream, scratch_path(spark, "history-checkpoint"), "changes")
    return applier


@query
def stream_scd1(spark, sf_dir):
    return _applied(spark, sf_dir, "SCD_1").table()


@query
def stream_scd2(spark, sf_dir):
    return _applied(spark, sf_dir, "SCD_2").table()


@query
def stream_scd2_late(spark, sf_dir):
    applier = _applied(spark, sf_dir, "SCD_2")
    moved = frames.change_events(spark, sf_dir).withColumn("ts", F.col("ts") - F.lit(timedelta(days=40)))
    applier.apply(moved, "late", "late-changes")
    applier.apply(moved, "late", "late-changes")  # delivered twice, counted once
    return applier.table()

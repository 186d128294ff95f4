"""Frames derived from the given tables, shaped like the operators' inputs.

Each covers its whole table.  ``checks.sql`` holds the same definitions in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_yesterday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier state of orders: urgent ones under another key, late ones with another status."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").withColumns({
        "o_orderkey": F.when(F.col("o_orderpriority") == "1-URGENT", -key - 1).otherwise(key),
        "o_orderstatus": F.when(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"), "X").otherwise(status),
    })


def lineitem_yesterday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier state of line items; their keys repeat."""
    key = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").withColumns({
        "l_orderkey": F.when(F.col("l_returnflag") == "R", -key - 1).otherwise(key),
        "l_linestatus": F.when(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"), "X")
        .otherwise(F.col("l_linestatus")),
    })


def mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with nulls, a flag and a time, for the text forms."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        (F.nullif("o_orderstatus", F.lit("P")) == "F").alias("is_final"), "o_totalprice", "o_orderdate")


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of users: an error event deletes the user."""
    return table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_type", "value",
        F.when(F.col("event_type") == "error", "DELETE").otherwise("UPSERT").alias("change_op"))


def node_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("start_time"), (F.col("ts") + F.expr("INTERVAL 5 MINUTES")).alias("end_time"),
        F.col("event_type").alias("cluster_id"), F.col("user_id").alias("instance_id"),
        (value > 100).alias("driver"),
        (value / 5).alias("cpu_user_percent"), (value / 8).alias("cpu_system_percent"),
        (value % 2).alias("cpu_wait_percent"), (value / 6).alias("mem_used_percent"),
        (value / 7).alias("mem_swap_percent"),
        (F.col("event_id") * 1024).alias("network_sent_bytes"),
        (F.col("event_id") * 2048).alias("network_received_bytes"))


def run_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job run per cluster and day, reported in one-hour periods."""
    return table(spark, sf_dir, "events").select(
        F.concat_ws("/", "event_type", F.to_date("ts").cast("string")).alias("run_id"),
        F.col("event_type").alias("cluster_id"),
        (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("period_start_time"),
        (F.col("ts") + F.expr("INTERVAL 7 HOURS")).alias("period_end_time"))


def cluster_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("cluster_id"), F.col("ts").alias("change_time"),
        (F.col("event_id") % 5).alias("worker_count"), F.lit(4).cast("bigint").alias("max_workers"))


def task_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    state = (F.when(priority == "1-URGENT", "SUCCESS").when(priority == "2-HIGH", "SUCCESS_WITH_FAILURES")
             .when(priority == "3-MEDIUM", "CANCELED").when(priority == "4-NOT SPECIFIED", "UPSTREAM_FAILED")
             .when(F.col("o_totalprice") > 400000, "FAILED"))
    name = F.when(F.col("o_orderstatus") == "P", "notify_teams_").otherwise("task_")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("run_id"), F.concat(name, F.col("o_orderkey").cast("string")).alias("task_key"),
        state.alias("result_state"), F.when(state.isNotNull(), F.col("o_orderdate")).alias("end_time"),
        (F.col("o_orderkey") * 1000).alias("run_duration"))


def qc_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("run_id"), F.concat(F.lit("table_"), F.col("o_orderkey").cast("string")).alias("source_table"),
        F.timestamp_add("SECOND", F.col("o_orderkey").cast("int"), F.col("o_orderdate")).alias("created_at"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey") * 37).alias("source_count"))


def constraint_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Constraint metadata in which every customer is a table and its orders are key columns."""
    customer = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("pk_"), F.col("c_custkey").cast("string")).alias("constraint_name"),
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("table_schema"),
        F.lower("c_name").alias("table_name"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "FOREIGN KEY").otherwise("PRIMARY KEY").alias("constraint_type"),
        "c_custkey")
    usage = customer.join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey")).select(
        "constraint_name", "table_schema", "table_name",
        F.concat(F.lit("col_"), F.col("o_orderkey").cast("string")).alias("column_name"),
        F.col("o_orderkey").alias("ordinal_position"))
    return customer.drop("c_custkey"), usage


def alert_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One alert per user and event type on the value of the latest such event."""
    latest = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(
        F.max_by("value", "ts").alias("latest"))
    query = F.concat_ws("/", "event_type", F.col("user_id").cast("string"))
    names = F.array(*[F.lit(n) for n in ("EQUAL", "NOT_EQUAL", "GREATER_THAN", "GREATER_THAN_OR_EQUAL", "LESS_THAN",
                                         "LESS_THAN_OR_EQUAL", "IS_NULL")])
    operator = F.get(names, (F.col("user_id") % 7).cast("int"))
    alerts = latest.select(
        F.concat(F.lit("alert/"), query).alias("alert_id"), query.alias("query_id"),
        F.lit("value").alias("column_name"), operator.alias("operator"),
        F.when(operator != "IS_NULL", F.col("user_id").cast("double") / 2).alias("number_operand"),
        F.lit(None).cast("string").alias("text_operand"), F.lit(None).cast("boolean").alias("flag_operand"),
        (F.col("event_type") == "error").alias("empty_triggers"))
    values = latest.where(F.col("latest") >= 5).select(
        query.alias("query_id"), F.lit("value").alias("column_name"),
        F.when(F.col("event_type") != "signup", F.col("latest")).alias("number_value"),
        F.lit(None).cast("string").alias("text_value"), F.lit(None).cast("boolean").alias("flag_value"))
    return alerts, values


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with several timestamp columns, one usable as a watermark better than the rest."""
    at = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", at.alias("event_start_ts"), (at + F.expr("INTERVAL 5 MINUTES")).alias("event_end_ts"),
        F.when(F.col("event_type") != "view", at).alias("updated_ts"),
        (at + F.expr("INTERVAL 36500 DAYS")).alias("audit_ts"), at.alias("other_ts"))

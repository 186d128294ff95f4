"""The registered queries in SQL, written independently of the Spark code."""

from __future__ import annotations

from itertools import combinations

SF_TABLES = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
}
ORDERS = ", ".join(SF_TABLES["orders"])
LOADED = "TIMESTAMP '2024-02-01 12:00:00'"

YESTERDAY = """
    SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey,
           o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice, o_orderdate, o_orderpriority
    FROM orders"""
LINE_YESTERDAY = """
    SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN -l_orderkey - 1 ELSE l_orderkey END AS l_orderkey,
                      CASE WHEN l_shipdate >= TIMESTAMP '2000-01-01' THEN 'X' ELSE l_linestatus END AS l_linestatus)
    FROM lineitem"""
MIXED = """
    SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority,
           nullif(o_orderstatus, 'P') = 'F' AS is_final, o_totalprice, o_orderdate
    FROM orders"""
LOG = """
    SELECT user_id, ts, event_type, value,
           CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPSERT' END AS change_op
    FROM events"""
NODES = """
    SELECT ts AS start_time, ts + INTERVAL 5 MINUTE AS end_time, event_type AS cluster_id, user_id AS instance_id,
           value > 100 AS driver, value / 5 AS cpu_user_percent, value / 8 AS cpu_system_percent,
           value % 2 AS cpu_wait_percent, value / 6 AS mem_used_percent, value / 7 AS mem_swap_percent,
           event_id * 1024 AS network_sent_bytes, event_id * 2048 AS network_received_bytes
    FROM events"""
BOUNDS = """
    SELECT event_type || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, event_type AS cluster_id,
           min(ts) + INTERVAL 6 HOUR AS run_start, max(ts) + INTERVAL 7 HOUR AS run_end
    FROM events GROUP BY ALL"""
QC_LOG = """
    SELECT o_custkey AS run_id, 'table_' || o_orderkey AS source_table,
           o_orderdate + to_seconds(o_orderkey) AS created_at,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderkey * 37 END AS source_count
    FROM orders"""
PERCENTS = ("cpu_user_percent", "cpu_system_percent", "cpu_wait_percent", "mem_used_percent", "mem_swap_percent")


def text(column: str, kind: str = "other") -> str:
    if kind == "time":
        column = f"CAST(epoch_us({column}) // 1000000 AS VARCHAR)"
    elif kind == "flag":
        column = f"CASE WHEN {column} THEN '1' WHEN NOT {column} THEN '0' END"
    elif kind == "other":
        column = f"CAST({column} AS VARCHAR)"
    return f"coalesce({column}, 'NULL')"


def md5_of(*parts: str) -> str:
    return f"md5(concat_ws('|', {', '.join(parts)}))"


ORDER_TEXTS = [text("o_orderkey"), text("o_custkey"), text("o_orderstatus"), text("o_totalprice"),
               text("o_orderdate", "time"), text("o_orderpriority")]
LINE_NAMES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
              "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_TEXTS = [text(n, "time" if n == "l_shipdate" else "other") for n in LINE_NAMES]


def hashed(body: str, key: str, texts: list[str]) -> str:
    return f"SELECT *, {key} AS row_key_hash, {md5_of(*texts)} AS row_hash FROM ({body})"


def order_sides(keyed: bool = True, source: str = "SELECT * FROM orders") -> str:
    key = md5_of(ORDER_TEXTS[0]) if keyed else md5_of(*ORDER_TEXTS)
    return (f"WITH s AS ({hashed(source, key, ORDER_TEXTS)}), t AS ({hashed(YESTERDAY, key, ORDER_TEXTS)})")


RECENT = "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'"
INSERTS = "SELECT s.*, 'INSERT' AS change_op FROM s ANTI JOIN t USING (row_key_hash)"
UPDATES = ("SELECT s.*, 'UPDATE' AS change_op FROM s WHERE EXISTS (SELECT 1 FROM t WHERE "
           "t.row_key_hash = s.row_key_hash AND t.row_hash <> s.row_hash)")
DELETES = "SELECT t.*, 'DELETE' AS change_op FROM t ANTI JOIN s USING (row_key_hash)"


def exact_avg(name: str) -> str:
    return f"CAST(sum(CAST({name} AS DECIMAL(20,6))) AS DOUBLE) / count({name}) AS avg_{name}"


def daily(end: str) -> str:
    measures = ", ".join([exact_avg(n) for n in PERCENTS] + [f"max({n}) AS max_{n}" for n in PERCENTS])
    return f"""
    SELECT CAST(start_time AS DATE) AS date, cluster_id, instance_id,
           CAST(sum(date_sub('minute', start_time, {end})) AS BIGINT) AS total_active_minutes,
           sum(date_sub('minute', start_time, {end})) / 60 AS total_active_hours, {measures},
           CAST(sum(network_sent_bytes) AS BIGINT) AS total_network_sent_bytes,
           CAST(sum(network_received_bytes) AS BIGINT) AS total_network_received_bytes,
           CAST(sum(network_sent_bytes) AS DOUBLE) / 1073741824 AS total_network_sent_gb,
           CAST(sum(network_received_bytes) AS DOUBLE) / 1073741824 AS total_network_received_gb
    FROM ({NODES}) WHERE hour(start_time) >= 3 AND hour(start_time) < 6 GROUP BY ALL"""


CLIPPED = "least(end_time, CAST(CAST(start_time AS DATE) AS TIMESTAMP) + INTERVAL 6 HOUR)"

IN_RUN = f"""
    SELECT n.*, b.run_id, b.run_start, b.run_end
    FROM ({NODES}) n JOIN ({BOUNDS}) b
      ON n.cluster_id = b.cluster_id AND n.start_time BETWEEN b.run_start AND b.run_end"""
QUARTERED = f"""
    SELECT *, CASE
        WHEN start_time <= run_start + to_seconds(date_sub('second', run_start, run_end) // 4) THEN 'q1'
        WHEN start_time <= run_start + to_seconds(2 * date_sub('second', run_start, run_end) // 4) THEN 'q2'
        WHEN start_time <= run_start + to_seconds(3 * date_sub('second', run_start, run_end) // 4) THEN 'q3'
        ELSE 'q4' END AS quadrant
    FROM ({IN_RUN})"""

VERSIONS = f"""
    SELECT user_id, ts, event_type, value, ts AS start_at, end_at FROM (
        SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_at FROM ({LOG}))
    WHERE change_op <> 'DELETE'"""
LATEST = f"""
    SELECT user_id, ts, event_type, value FROM ({LOG})
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1 AND change_op <> 'DELETE'"""

DURATIONS = f"""
    SELECT *, CAST(1 AS BIGINT) AS copies, epoch_us(ended_at) // 1000000 - epoch_us(created_at) // 1000000 AS seconds,
           round((epoch_us(ended_at) // 1000000 - epoch_us(created_at) // 1000000) / 60, 2) AS minutes
    FROM (SELECT *, lead(created_at) OVER (PARTITION BY run_id ORDER BY created_at, source_table) AS ended_at
          FROM ({QC_LOG}))"""


def subsets(columns, least: int) -> list[tuple[str, ...]]:
    return [group for size in range(least, len(columns) + 1) for group in combinations(columns, size)]


def unique_ctes(tables: dict[str, list[str]] = SF_TABLES) -> str:
    """One row per minimal unique set of columns, without nulls."""
    parts = []
    for name, columns in tables.items():
        for place, group in enumerate(subsets(columns, 1)):
            nulls = " OR ".join(f"{c} IS NULL" for c in group)
            listed = ", ".join(group)
            parts.append(
                f"SELECT '{name}' AS table_name, '{','.join(group)}' AS columns, CAST({len(group)} AS INTEGER) AS size, "
                f"{place} AS place FROM (SELECT count(*) AS n FROM {name}) "
                f"WHERE n = (SELECT count(*) FROM (SELECT DISTINCT {listed} FROM {name})) "
                f"AND NOT EXISTS (SELECT 1 FROM {name} WHERE {nulls})")
    return f"""
    found AS ({' UNION ALL '.join(parts)}),
    uccs AS (SELECT * FROM found f WHERE NOT EXISTS (
        SELECT 1 FROM found g WHERE g.table_name = f.table_name AND g.size < f.size
        AND list_has_all(string_split(f.columns, ','), string_split(g.columns, ','))))"""


def dependency_ctes() -> str:
    """One row per minimal dependency."""
    parts = []
    for name, columns in SF_TABLES.items():
        for left in subsets(columns, 0):
            for right in columns:
                if right in left:
                    continue
                group = f"GROUP BY {', '.join(left)}" if left else ""
                parts.append(
                    f"SELECT '{name}' AS table_name, '{','.join(left)}' AS lhs, '{right}' AS rhs, {len(left)} AS size "
                    f"WHERE NOT EXISTS (SELECT 1 FROM {name} {group} HAVING count(DISTINCT {right}) > 1 "
                    f"OR (count({right}) > 0 AND count({right}) < count(*)))")
    return f"""
    holds AS ({' UNION ALL '.join(parts)}),
    fds AS (SELECT * FROM holds f WHERE NOT EXISTS (
        SELECT 1 FROM holds g WHERE g.table_name = f.table_name AND g.rhs = f.rhs AND g.size < f.size
        AND (g.lhs = '' OR list_has_all(string_split(f.lhs, ','), string_split(g.lhs, ',')))))"""


RANKED = """
    ranked AS (SELECT *, uses = max(uses) OVER (PARTITION BY table_name) AS best FROM (
        SELECT u.table_name, u.columns, u.place,
               (SELECT count(*) FROM fds f WHERE f.table_name = u.table_name AND f.lhs = u.columns) AS uses
        FROM uccs u))"""
ONE = "Only one unique value found; it is the primary key."
MANY = "Manual intervention is required to find the best candidate for primary key."
NONE = "No valid primary key could be determined."

KEY_PROFILE = f"""
    SELECT t.table_name, coalesce(string_agg(r.columns, '; ' ORDER BY r.place), '') AS unique_columns,
           coalesce(string_agg(r.columns, '; ' ORDER BY r.place) FILTER (WHERE r.best), '') AS primary_key,
           CASE count(*) FILTER (WHERE r.best) WHEN 0 THEN '{NONE}' WHEN 1 THEN '{ONE}' ELSE '{MANY}' END AS message
    FROM (VALUES ('customer'), ('nation'), ('orders')) t(table_name) LEFT JOIN ranked r USING (table_name)
    GROUP BY t.table_name"""


def key_row(name: str, columns: str, body: str) -> str:
    nulls = " OR ".join(f"{c} IS NULL" for c in columns.split(","))
    return (f"SELECT '{columns}' AS columns, (SELECT count(*) FROM {body}) AS rows, "
            f"(SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {body})) AS distinct_rows, "
            f"(SELECT count(*) FROM {body} WHERE {nulls}) AS null_rows")


def broken(rule: str, condition: str) -> str:
    return f"CASE WHEN NOT coalesce({condition}, false) THEN '{rule}' END"


RULES = {
    "balance_known": "c_acctbal >= 0", "not_machinery": "c_mktsegment <> 'MACHINERY'",
    "segment_listed": "nullif(c_mktsegment, 'BUILDING') IS NOT NULL", "unknown_is_bad": "nullif(c_nationkey, 5) > 0",
}
LEVELS = {"balance_known": "error", "segment_listed": "error"}
FAILED_RULES = f"concat_ws(',', {', '.join(broken(r, c) for r, c in RULES.items())})"

ALERT_LATEST = """
    SELECT user_id, event_type, arg_max(value, ts) AS latest,
           event_type || '/' || user_id AS query_id,
           ['EQUAL', 'NOT_EQUAL', 'GREATER_THAN', 'GREATER_THAN_OR_EQUAL', 'LESS_THAN', 'LESS_THAN_OR_EQUAL',
            'IS_NULL'][CAST(user_id % 7 AS INTEGER) + 1] AS operator,
           CAST(user_id AS DOUBLE) / 2 AS operand
    FROM events GROUP BY user_id, event_type"""
NUMBER = "CASE WHEN {0} = floor({0}) THEN CAST(CAST({0} AS BIGINT) AS VARCHAR) ELSE CAST({0} AS VARCHAR) END"

STATS = " UNION ALL ".join(
    f"SELECT year(o_orderdate) AS part, count(*) AS rows, '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min_value, "
    f"CAST(max({c}) AS VARCHAR) AS max_value, count(*) - count({c}) AS null_count FROM orders GROUP BY 1"
    for c in SF_TABLES["orders"] if c != "o_totalprice")

COMPARED = """
    SELECT (SELECT count(*) FROM s) AS source_count, (SELECT count(*) FROM t) AS target_count,
           (SELECT count(*) FROM (SELECT row_key_hash, row_hash FROM s EXCEPT SELECT row_key_hash, row_hash FROM t))
               AS only_in_source,
           (SELECT count(*) FROM (SELECT row_key_hash, row_hash FROM t EXCEPT SELECT row_key_hash, row_hash FROM s))
               AS only_in_target"""
VERDICT = """
    CASE WHEN only_in_target = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
    CASE WHEN only_in_target = 0 AND only_in_source = 0 AND source_count = target_count
         THEN 'SUCCESS' ELSE 'FAILED' END AS strict_status"""

WATERMARKS = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(*) - count(c) AS nulls, max(c) AS latest, "
    f"CAST(sum(CAST(epoch_us(c) AS HUGEINT)) AS DOUBLE) / count(c) / 1e6 AS mean_epoch, "
    f"count(*) = count(c) AND max(c) < TIMESTAMP '2024-06-01' AS valid, {name == 'event_end_ts'} AS chosen "
    f"FROM (SELECT {expr} AS c FROM events)"
    for name, expr in (("event_start_ts", "ts"), ("event_end_ts", "ts + INTERVAL 5 MINUTE"),
                       ("updated_ts", "CASE WHEN event_type <> 'view' THEN ts END"),
                       ("audit_ts", "ts + INTERVAL 36500 DAY")))

TEXT_ORDERS = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in SF_TABLES["orders"])
LINE_COLUMNS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
TEXT_LINES = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in LINE_COLUMNS.split(", "))
LINE_SIDE = "l_returnflag, l_linestatus, CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_discount AS VARCHAR) AS l_discount"

ORDER_MAP_BODY = """
    SELECT o_orderkey AS order_id, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(19,2)) AS price,
           o_orderstatus = 'O' AS is_open FROM ({0})"""
ORDER_MAP_TEXTS = [text("order_id"), text("status"), text("price"), text("is_open", "flag")]

PREVIOUS_LOAD = """
    SELECT strftime(o_orderdate, '%Y-%m') AS batch_id, max(o_orderdate) AS watermark, count(*) AS rows FROM orders
    WHERE month(o_orderdate) % 5 <> 0 GROUP BY 1 ORDER BY watermark DESC LIMIT 1 OFFSET 1"""

SQL: dict[str, str] = {
    "scan_aliased": "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus, o_totalprice, "
                    "o_orderdate AS ordered_at, o_orderpriority FROM orders",
    "scan_incremental": "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus, o_totalprice, "
                        "o_orderdate AS ordered_at, o_orderpriority FROM orders "
                        "WHERE o_orderdate > TIMESTAMP '1998-01-01'",
    "high_watermark": "SELECT max(o_orderdate) AS o_orderdate FROM orders",
    "current_rows": f"SELECT * FROM ({VERSIONS}) WHERE end_at IS NULL",
    "typed_read": "SELECT c_custkey, c_name, CAST(c_nationkey AS SMALLINT) AS c_nationkey, "
                  "CAST(c_acctbal AS DECIMAL(19,2)) AS c_acctbal, c_mktsegment FROM customer",
    "read_files_csv": "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment "
                      "FROM customer",
    "read_files_json": "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment "
                       "FROM customer",
    "latest_file_per_dir": "SELECT c_custkey, c_nationkey, c_acctbal, 2 AS wave FROM customer",
    "transform_map": "SELECT CAST(c_custkey AS INTEGER) AS customer_id, c_name AS name, "
                     "CAST(c_acctbal AS DECIMAL(19,2)) AS balance, upper(c_mktsegment) AS segment, "
                     "upper(c_mktsegment) || '-' || c_custkey AS label FROM customer",
    "transform_derived_only": "SELECT *, lower(c_mktsegment) AS segment, c_acctbal < 0 AS in_debt FROM customer",
    "select_columns": "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders",
    "clean_names": "SELECT c_custkey AS ckey, c_name AS cname, c_nationkey AS cnation, c_acctbal AS cacctbal, "
                   "c_mktsegment FROM customer",
    "rename_columns": "SELECT c_custkey AS id, c_name AS name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "add_constants": "SELECT *, 'upper(c_name)' AS origin, 7 AS rank FROM customer",
    "lineage_cols": f"SELECT *, 'job-1' AS batch_id, {LOADED} AS loaded_at FROM orders",
    "canonical_strings": f"SELECT {text('o_orderkey')} AS o_orderkey, {text('priority')} AS priority, "
                         f"{text('is_final', 'flag')} AS is_final, {text('o_totalprice')} AS o_totalprice, "
                         f"{text('o_orderdate', 'time')} AS o_orderdate FROM ({MIXED})",
    "row_hashes": f"SELECT *, {md5_of(text('o_orderkey'), text('priority'))} AS row_key_hash, "
                  + md5_of(text("o_orderkey"), text("priority"), text("is_final", "flag"), text("o_totalprice"),
                           text("o_orderdate", "time")) + f" AS row_hash FROM ({MIXED})",
    "cdc_snapshot": f"{order_sides()} {INSERTS} UNION ALL {UPDATES} UNION ALL {DELETES}",
    "cdc_incremental": f"{order_sides(source=RECENT)} {INSERTS} UNION ALL {UPDATES}",
    "cdc_no_key": f"{order_sides(keyed=False)} {INSERTS} UNION ALL {DELETES}",
    "cdc_no_key_incremental": f"{order_sides(keyed=False, source=RECENT)} {INSERTS}",
    "cdc_initial": f"{order_sides()} SELECT *, 'INSERT' AS change_op FROM s",
    "cdc_duplicate_keys": f"""
        WITH s AS ({hashed("SELECT * FROM lineitem", md5_of(LINE_TEXTS[0], LINE_TEXTS[3]), LINE_TEXTS)}),
             t AS ({hashed(LINE_YESTERDAY, md5_of(LINE_TEXTS[0], LINE_TEXTS[3]), LINE_TEXTS)}),
             per_key AS (SELECT row_key_hash, count(*) AS n FROM t GROUP BY 1),
             per_row AS (SELECT row_key_hash, row_hash, count(*) AS n FROM t GROUP BY 1, 2),
             counted AS (SELECT s.*, k.n AS total, coalesce(r.n, 0) AS same
                         FROM s JOIN per_key k USING (row_key_hash) LEFT JOIN per_row r USING (row_key_hash, row_hash))
        SELECT *, CAST(0 AS BIGINT) AS changed_matches FROM ({INSERTS})
        UNION ALL SELECT * EXCLUDE (total, same), 'UPDATE' AS change_op, total - same AS changed_matches
                  FROM counted WHERE total > same
        UNION ALL SELECT *, CAST(0 AS BIGINT) AS changed_matches FROM ({DELETES})""",
    "raw_change_log": f"""
        WITH s AS ({hashed(ORDER_MAP_BODY.format('SELECT * FROM orders'), md5_of(ORDER_MAP_TEXTS[0]), ORDER_MAP_TEXTS)}),
             t AS ({hashed(ORDER_MAP_BODY.format(YESTERDAY), md5_of(ORDER_MAP_TEXTS[0]), ORDER_MAP_TEXTS)})
        SELECT *, 'job-1' AS batch_id, {LOADED} AS loaded_at
        FROM ({INSERTS} UNION ALL {UPDATES} UNION ALL {DELETES})""",
    "load_unchanged": """
        SELECT 'first' AS batch_id, 'INSERT' AS change_op, count(*) AS rows FROM orders HAVING count(*) > 0
        UNION ALL SELECT 'second', op, count(*) FROM orders, (VALUES ('INSERT'), ('DELETE')) v(op)
        WHERE o_orderpriority = '1-URGENT' GROUP BY op
        UNION ALL SELECT 'second', 'UPDATE', count(*) FROM orders
        WHERE o_orderpriority <> '1-URGENT' AND o_orderdate >= TIMESTAMP '2000-01-01' HAVING count(*) > 0""",
    "union_by_name": f"SELECT {ORDERS} FROM orders UNION ALL SELECT {ORDERS} FROM ({YESTERDAY})",
    "dedup_key": "SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
    "dedup_exclude": "SELECT * FROM documents "
                     "QUALIFY row_number() OVER (PARTITION BY text, lang, n_chars ORDER BY doc_id) = 1",
    "dedup_all": "SELECT DISTINCT text, lang, source, n_chars FROM documents",
    "scd1": LATEST,
    "scd1_no_op": "SELECT user_id, ts, event_type, value FROM events "
                  "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1",
    "scd2": VERSIONS,
    "scd_sequence_ties": """
        SELECT count(*) AS tied_positions, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_changes
        FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate) WHERE n > 1""",
    "merge_upsert": """
        WITH u AS (SELECT o_custkey * 2 AS table_id, max(o_orderpriority) AS pk, min(o_orderpriority) AS uc,
                          count(*) AS n FROM orders GROUP BY 1)
        SELECT 'main' AS catalog, coalesce(c_custkey, table_id) AS table_id, coalesce(pk, c_name) AS primary_key,
               coalesce(c_mktsegment, uc) AS unique_columns, coalesce(n, 0) AS record_count
        FROM customer FULL JOIN u ON c_custkey = table_id""",
    "previous_version": f"SELECT batch_id, 'MERGE' AS operation FROM ({PREVIOUS_LOAD})",
    "previous_watermark": f"SELECT watermark, rows FROM ({PREVIOUS_LOAD})",
    "qc_incremental": f"""{order_sides()},
        mark AS (SELECT watermark AS m FROM ({PREVIOUS_LOAD})),
        a AS (SELECT row_key_hash, row_hash FROM t, mark WHERE o_orderdate > m),
        b AS (SELECT row_key_hash, row_hash FROM s, mark WHERE o_orderdate > m)
        SELECT *, {VERDICT} FROM (
        SELECT (SELECT count(*) FROM a) AS source_count, (SELECT count(*) FROM b) AS target_count,
               (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS only_in_source,
               (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS only_in_target)""",
    "qc_counts": "SELECT false AS counts_equal, count(*) AS source_count, 2 * count(*) AS target_count FROM orders",
    "qc_subtract": f"{order_sides()} SELECT 'left' AS side, * FROM (SELECT row_key_hash, row_hash FROM s EXCEPT "
                   "SELECT row_key_hash, row_hash FROM t) UNION ALL SELECT 'right' AS side, * FROM "
                   "(SELECT row_key_hash, row_hash FROM t EXCEPT SELECT row_key_hash, row_hash FROM s)",
    "qc_mismatch_rows": f"{order_sides()} SELECT 'left' AS side, s.* FROM s ANTI JOIN t USING (row_key_hash, row_hash) "
                        "UNION ALL SELECT 'right' AS side, t.* FROM t ANTI JOIN s USING (row_key_hash, row_hash)",
    "diff_rows_strings": f"WITH a AS (SELECT {TEXT_ORDERS} FROM orders), b AS (SELECT {TEXT_ORDERS} FROM ({YESTERDAY})) "
                         "SELECT 'left' AS side, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) "
                         "UNION ALL SELECT 'right' AS side, * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)",
    "diff_rows_copies": f"""
        WITH a AS (SELECT {LINE_SIDE}, count(*) AS n FROM lineitem GROUP BY ALL),
             b AS (SELECT {LINE_SIDE}, count(*) AS n FROM ({LINE_YESTERDAY}) GROUP BY ALL)
        SELECT CASE WHEN coalesce(a.n, 0) > coalesce(b.n, 0) THEN 'left' ELSE 'right' END AS side, l_returnflag,
               l_linestatus, l_quantity, l_discount, abs(coalesce(a.n, 0) - coalesce(b.n, 0)) AS copies
        FROM a FULL JOIN b USING (l_returnflag, l_linestatus, l_quantity, l_discount)
        WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""",
    "diff_rows_whole_copies": f"""
        WITH a AS (SELECT {TEXT_LINES}, count(*) AS n FROM lineitem GROUP BY ALL),
             b AS (SELECT {TEXT_LINES}, count(*) AS n FROM ({LINE_YESTERDAY}) GROUP BY ALL)
        SELECT CASE WHEN coalesce(n, 0) > coalesce(n_1, 0) THEN 'left' ELSE 'right' END AS side, * EXCLUDE (n, n_1),
               abs(coalesce(n, 0) - coalesce(n_1, 0)) AS copies
        FROM (SELECT a.*, b.n AS n_1 FROM a LEFT JOIN b USING ({LINE_COLUMNS})
              UNION ALL SELECT b.* REPLACE (NULL AS n), b.n FROM b ANTI JOIN a USING ({LINE_COLUMNS}))
        WHERE coalesce(n, 0) <> coalesce(n_1, 0)""",
    "qc_results": f"""{order_sides()}
        SELECT 'run-1' AS run_id, 'orders' AS source_table, 'orders_history' AS target_table,
               'o_orderdate' AS watermark_column, *, {VERDICT}, {LOADED} AS created_at FROM ({COMPARED})
        UNION ALL
        SELECT 'run-1', 'orders', 'orders_copy', NULL, count(*), count(*), 0, 0, 'SUCCESS', 'SUCCESS', {LOADED} FROM s
        UNION ALL
        SELECT 'run-1', 'nowhere', 'orders_history', NULL, NULL, NULL, NULL, NULL,
               'FAILED - Data Fetch: no such table', 'FAILED', {LOADED}""",
    "qc_durations": DURATIONS,
    "qc_duration_buckets": f"""
        SELECT CASE WHEN source_count IS NULL THEN 'Unknown' WHEN source_count < 1000 THEN '<1K'
                    WHEN source_count < 10000 THEN '1K-10K' WHEN source_count < 100000 THEN '10K-100K'
                    ELSE '>100K' END AS count_bucket,
               count(*) AS tables_processed, round(sum(seconds) / count(seconds), 2) AS avg_seconds,
               round(CAST(sum(CAST(minutes AS DECIMAL(20,2))) AS DOUBLE) / count(minutes), 2) AS avg_minutes,
               min(seconds) AS min_seconds, max(seconds) AS max_seconds
        FROM ({DURATIONS}) GROUP BY 1""",
    "expectations": f"SELECT *, {FAILED_RULES} AS failed_rules FROM customer",
    "expectation_counts": " UNION ALL ".join(
        f"SELECT '{r}' AS rule, '{LEVELS.get(r, 'warn')}' AS level, count(*) AS checked, "
        f"count(*) FILTER (WHERE NOT coalesce({c}, false)) AS violations FROM customer" for r, c in RULES.items()),
    "quarantine": f"SELECT *, {FAILED_RULES} AS failed_rules FROM customer WHERE NOT coalesce(c_acctbal >= 0, false) "
                  "OR c_mktsegment = 'BUILDING'",
    "daily_utilisation": daily("end_time"),
    "clip_intervals": f"SELECT date, cluster_id, instance_id, total_active_minutes FROM ({daily(CLIPPED)})",
    "threshold_counts": " UNION ALL ".join(
        f"SELECT {i} AS s_no, '{c} greater_than_50' AS aggregation_type, count(*) FILTER (WHERE {c} > 50) AS n "
        f"FROM ({daily(CLIPPED)})"
        for i, c in enumerate(("max_mem_used_percent", "max_cpu_system_percent", "max_cpu_user_percent"), 1)),
    "idle_minutes": f"""
        SELECT *, idle_time_minutes / 60 AS idle_time_hours FROM (
        SELECT CAST(start_time AS DATE) AS date, cluster_id,
               CAST(sum(CASE WHEN cpu_user_percent + cpu_system_percent + cpu_wait_percent < 1
                             THEN date_sub('minute', start_time, end_time) ELSE 0 END) AS BIGINT) AS idle_time_minutes
        FROM ({NODES}) WHERE hour(start_time) BETWEEN 3 AND 5 GROUP BY ALL)""",
    "active_per_minute": """
        SELECT start_time, start_time + INTERVAL 330 MINUTE AS local_time, count(DISTINCT user_id) AS active_nodes
        FROM (SELECT date_trunc('minute', ts) AS start_time, user_id FROM events)
        WHERE hour(start_time + INTERVAL 330 MINUTE) BETWEEN 9 AND 11 GROUP BY start_time""",
    "run_bounds": BOUNDS,
    "samples_in_run": IN_RUN,
    "run_quartiles": f"SELECT run_id, start_time, instance_id, quadrant FROM ({QUARTERED}) WHERE NOT driver",
    "quartile_by_interval": f"""
        SELECT cluster_id, instance_id, start_time, lo AS min_start_time, hi AS max_end_time,
               CASE WHEN epoch_us(start_time) - epoch_us(lo) <= round(CAST(epoch_us(hi) - epoch_us(lo) AS DECIMAL(20,2)) * 0.25) THEN 'Q1'
                    WHEN epoch_us(start_time) - epoch_us(lo) <= round(CAST(epoch_us(hi) - epoch_us(lo) AS DECIMAL(20,2)) * 0.50) THEN 'Q2'
                    WHEN epoch_us(start_time) - epoch_us(lo) <= round(CAST(epoch_us(hi) - epoch_us(lo) AS DECIMAL(20,2)) * 0.75) THEN 'Q3'
                    ELSE 'Q4' END AS quadrant
        FROM (SELECT *, min(start_time) OVER (PARTITION BY cluster_id) AS lo,
                     max(end_time) OVER (PARTITION BY cluster_id) AS hi FROM ({NODES}))""",
    "bucket_report": f"""
        SELECT run_id, quadrant, count(DISTINCT instance_id) AS active_nodes,
               {', '.join(f'{exact_avg(n)}, min({n}) AS min_{n}, max({n}) AS max_{n}' for n in PERCENTS)},
               CAST(sum(network_sent_bytes) AS BIGINT) AS total_network_sent_bytes,
               CAST(sum(network_received_bytes) AS BIGINT) AS total_network_received_bytes
        FROM ({QUARTERED}) GROUP BY run_id, quadrant""",
    "cluster_idle_peak": """
        SELECT user_id AS cluster_id,
               CAST(sum(CASE WHEN event_id % 5 = 0 THEN gap ELSE 0 END) AS BIGINT) AS idle_time_seconds,
               CAST(sum(CASE WHEN event_id % 5 = 4 THEN gap ELSE 0 END) AS BIGINT) AS peak_utilization_time_seconds
        FROM (SELECT *, epoch_us(ts) // 1000000
                  - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) // 1000000 AS gap FROM events)
        GROUP BY user_id""",
    "run_status": """
        WITH tasks AS (
            SELECT o_custkey AS run_id,
                   CASE WHEN o_orderstatus = 'P' THEN 'notify_teams_' ELSE 'task_' END || o_orderkey AS task_key,
                   CASE WHEN o_orderpriority = '1-URGENT' THEN 'SUCCESS'
                        WHEN o_orderpriority = '2-HIGH' THEN 'SUCCESS_WITH_FAILURES'
                        WHEN o_orderpriority = '3-MEDIUM' THEN 'CANCELED'
                        WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'UPSTREAM_FAILED'
                        WHEN o_totalprice > 400000 THEN 'FAILED' END AS state,
                   o_orderdate, o_orderkey FROM orders)
        SELECT run_id, task_key, coalesce(state, '') AS status,
               CASE state WHEN 'SUCCESS' THEN 'Good' WHEN 'SUCCESS_WITH_FAILURES' THEN 'Warning'
                          WHEN 'CANCELED' THEN 'Warning' WHEN 'FAILED' THEN 'Attention' ELSE 'Default' END AS colour,
               CASE WHEN state IS NOT NULL THEN o_orderdate END AS end_time,
               CASE WHEN o_orderkey >= 3600
                    THEN printf('%d:%02d:%02d', o_orderkey // 3600, o_orderkey // 60 % 60, o_orderkey % 60)
                    ELSE printf('%02d:%02d', o_orderkey // 60 % 60, o_orderkey % 60) END AS duration,
               run_id IN (SELECT run_id FROM tasks WHERE state = 'FAILED') AS run_has_errors
        FROM tasks WHERE task_key NOT LIKE '%notify_teams%'""",
    "freshness": """
        SELECT max(ts) AS last_received_at,
               CASE WHEN date_sub('hour', max(ts), TIMESTAMP '2024-01-31 04:30:00') >= 1
                    THEN date_sub('hour', max(ts), TIMESTAMP '2024-01-31 04:30:00') || ' hours ago'
                    ELSE date_sub('minute', max(ts), TIMESTAMP '2024-01-31 04:30:00') || ' minutes ago' END AS time_ago,
               count(*) FILTER (WHERE CAST(ts AS DATE) = DATE '2024-01-30') AS rows_today
        FROM events""",
    "alerts": f"""
        SELECT 'alert/' || query_id AS alert_id, query_id, 'value' AS column_name, operator,
               CASE WHEN latest < 5 THEN event_type = 'error' WHEN operator = 'IS_NULL' THEN event_type = 'signup'
                    WHEN event_type = 'signup' THEN false
                    WHEN operator = 'EQUAL' THEN latest = operand WHEN operator = 'NOT_EQUAL' THEN latest <> operand
                    WHEN operator = 'GREATER_THAN' THEN latest > operand
                    WHEN operator = 'GREATER_THAN_OR_EQUAL' THEN latest >= operand
                    WHEN operator = 'LESS_THAN' THEN latest < operand ELSE latest <= operand END AS triggered,
               CASE WHEN latest < 5 THEN NULL WHEN event_type = 'signup' THEN 'value IS NULL'
                    ELSE 'value = ' || {NUMBER.format('latest')} END AS alert_result,
               CASE WHEN operator = 'IS_NULL' THEN 'value IS NULL'
                    ELSE 'value ' || CASE operator WHEN 'EQUAL' THEN '=' WHEN 'NOT_EQUAL' THEN '≠'
                        WHEN 'GREATER_THAN' THEN '>' WHEN 'GREATER_THAN_OR_EQUAL' THEN '≥' WHEN 'LESS_THAN' THEN '<'
                        ELSE '≤' END || ' ' || {NUMBER.format('operand')} END AS condition_text
        FROM ({ALERT_LATEST})""",
    "declared_keys": """
        SELECT 'nation_' || c_nationkey AS table_schema, upper(c_name) AS table_name, 'col_' || o_orderkey AS column_name,
               o_orderkey AS ordinal_position,
               CASE WHEN count(*) OVER (PARTITION BY c_custkey) > 1 THEN 'Composite Primary Key' ELSE 'Primary Key' END
                   AS key_type
        FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_mktsegment <> 'MACHINERY'""",
    "key_check": "SELECT *, rows = distinct_rows AND null_rows = 0 AS is_key FROM (" + " UNION ALL ".join([
        key_row("lineitem", "l_orderkey,l_linenumber", "lineitem"), key_row("lineitem", "l_orderkey", "lineitem"),
        key_row("orders", "o_orderkey", "orders"), key_row("orders", "o_custkey,o_orderdate", "orders"),
        key_row("mixed", "o_orderkey,priority", f"({MIXED})")]) + ")",
    "ucc_discovery": f"WITH {unique_ctes()} SELECT table_name, columns, size FROM uccs",
    "fd_discovery": f"WITH {dependency_ctes()} SELECT table_name, lhs, rhs FROM fds",
    "key_ranking": f"WITH {unique_ctes()}, {dependency_ctes()}, {RANKED} SELECT table_name, columns, uses, best FROM ranked",
    "profile_keys": f"WITH {unique_ctes()}, {dependency_ctes()}, {RANKED} {KEY_PROFILE}",
    "watermark_discovery": WATERMARKS,
    "table_profile": f"""
        WITH {unique_ctes()}, {dependency_ctes()}, {RANKED}, keyed AS ({KEY_PROFILE})
        SELECT 'main' AS catalog, 'sales' AS schema, t.table_name, k.primary_key, k.unique_columns,
               k.message AS key_message,
               CASE t.table_name WHEN 'events' THEN 'event_end_ts' ELSE 'NA' END AS watermark_column,
               CASE t.table_name WHEN 'events' THEN '' ELSE 'No column found which is matching with priority column '
                   || 'list. Hence manual intervention is needed' END AS watermark_message, t.record_count
        FROM (SELECT 'events' AS table_name, count(*) AS record_count FROM events
              UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'customer', count(*) FROM customer) t
        LEFT JOIN keyed k ON k.table_name = t.table_name AND t.table_name = 'customer'""",
    "column_stats": STATS,
    "sink_append": f"SELECT {ORDERS} FROM orders UNION ALL SELECT {ORDERS} FROM ({YESTERDAY})",
    "sink_overwrite": "SELECT * FROM orders",
    "sink_partitioned": "SELECT * FROM orders",
    "sink_clustered": "SELECT * FROM orders",
    "sink_empty_schema": "SELECT * FROM orders",
    "stream_file_ingest": f"""
        SELECT event_id, seen_at, kind, amount, {md5_of(text('event_id'))} AS row_key_hash,
               {md5_of(text('event_id'), text('seen_at', 'time'), text('kind'), text('amount'))} AS row_hash,
               'job-1' AS batch_id, {LOADED} AS loaded_at
        FROM (SELECT event_id, ts AS seen_at, upper(event_type) AS kind, value AS amount FROM events)""",
    "stream_scd1": LATEST,
    "stream_scd2": VERSIONS,
    "stream_scd2_late": f"""
        SELECT user_id, ts, event_type, value, ts AS start_at, end_at FROM (
            SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_at FROM (
                SELECT * FROM ({LOG}) UNION ALL SELECT * REPLACE (ts - INTERVAL 40 DAY AS ts) FROM ({LOG})))
        WHERE change_op <> 'DELETE'""",
}
SQL["staged_scan"] = SQL["scan_aliased"]

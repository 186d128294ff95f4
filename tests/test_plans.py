from __future__ import annotations

from decimal import Decimal
from datetime import datetime
from itertools import combinations

import pytest

from tidewell.plans import keys, profile, reconcile, usage
from tidewell.plans.alerts import evaluate_alerts, first_row_values
from tidewell.plans.runs import run_status

SF = "/root/testdata/sf0.001"


def brute_unique(rows, names, size):
    found = []
    for n in range(1, size + 1):
        for group in combinations(range(len(names)), n):
            labels = tuple(names[i] for i in group)
            if any(set(f) <= set(labels) for f in found):
                continue
            values = [tuple(r[i] for i in group) for r in rows]
            if all(v is not None for value in values for v in value) and len(set(values)) == len(values):
                found.append(labels)
    return found


def brute_dependencies(rows, names, size):
    found = []
    for n in range(size + 1):
        for left in combinations(range(len(names)), n):
            for right in range(len(names)):
                if right in left:
                    continue
                labels = tuple(names[i] for i in left)
                if any(r == names[right] and set(f) <= set(labels) for f, r in found):
                    continue
                seen = {}
                for row in rows:
                    seen.setdefault(tuple(row[i] for i in left), set()).add(row[right])
                if all(len(values) == 1 for values in seen.values()):
                    found.append((labels, names[right]))
    return found


def tricky(spark):
    items = [(i, i // 2, i % 2, None if i % 5 == 0 else i % 3, "same", i % 4 if i % 5 else None) for i in range(60)]
    return spark.createDataFrame(items, "a int, b int, c int, d int, e string, f int")


def test_minimal_hitting_sets():
    """Against all sets of up to six elements."""
    state = 5
    for _ in range(200):
        edges = []
        for _ in range(4):
            state = (state * 1103515245 + 12345) % 2 ** 31
            edges.append(state >> 9 & 63)
        hitting = [t for t in range(64) if all(t & e for e in edges)]
        expected = {t for t in hitting if not any(o != t and o & t == o for o in hitting)}
        assert set(keys.minimal_hitting_sets(edges, 6)) == expected
        assert set(keys.minimal_hitting_sets(edges, 6, 2)) == {t for t in expected if t.bit_count() <= 2}


def test_unique_sets_of_whole_line_items_equal_brute_force(spark):
    """All sizes and all columns, over part of the orders; the registered query runs over the whole table."""
    df = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_orderkey <= 400")
    rows = [tuple(r) for r in df.collect()]
    assert sorted(keys.find_unique_sets(df)) == sorted(brute_unique(rows, df.columns, len(df.columns)))


def test_dependencies_of_whole_line_items_equal_brute_force(spark):
    """As above, for left sides of any size."""
    df = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_orderkey <= 200")
    rows = [tuple(r) for r in df.collect()]
    assert sorted(keys.find_dependencies(df)) == sorted(brute_dependencies(rows, df.columns, len(df.columns) - 1))


@pytest.mark.parametrize("name", ["tricky", "nation", "customer"])
def test_discovery_matches_brute_force(spark, name):
    df = tricky(spark) if name == "tricky" else spark.read.parquet(f"{SF}/{name}.parquet")
    rows = [tuple(r) for r in df.collect()]
    assert sorted(keys.find_unique_sets(df, 3)) == sorted(brute_unique(rows, df.columns, 3))
    assert sorted(keys.find_dependencies(df, 2)) == sorted(brute_dependencies(rows, df.columns, 2))


@pytest.mark.parametrize("name", ["tricky", "customer", "lineitem"])
def test_discovery_on_dealt_rows_matches_brute_force(spark, monkeypatch, name):
    """As large tables are searched: a bounded part first, then all rows dealt by hubs."""
    for limit, value in {"WHOLE": 10, "PART": 40, "DEALT": 100, "EVIDENCE": 3}.items():
        monkeypatch.setattr(keys, limit, value)
    df = tricky(spark) if name == "tricky" else spark.read.parquet(f"{SF}/{name}.parquet").limit(700).select(
        *spark.read.parquet(f"{SF}/{name}.parquet").columns[:6]).cache()
    rows = [tuple(r) for r in df.collect()]
    assert sorted(keys.find_unique_sets(df)) == sorted(brute_unique(rows, df.columns, len(df.columns)))
    assert sorted(keys.find_dependencies(df)) == sorted(brute_dependencies(rows, df.columns, len(df.columns) - 1))
    df.unpersist()


def crowded(spark, rows=400):
    """Nulls, repeated rows, a hot value, both zeros, NaN and a column that depends on another."""
    return spark.range(rows).selectExpr(
        "int(id * 7919 % 97) AS a", "int(id / 9) AS b", "IF(id % 5 = 0, NULL, int(id % 3)) AS c", "IF(id < 300, 'hot', string(id)) AS d",
        "CASE WHEN id % 4 = 0 THEN -0.0D WHEN id % 4 = 1 THEN 0.0D WHEN id % 8 = 3 THEN double('NaN') ELSE double(id % 6) END AS e",
        "string(int(id / 9) % 10) AS f", "int(id * 31 % 50) AS g")


def plain_rows(df):
    """Rows whose values are equal in Python where Spark groups them together."""
    return [tuple("nan" if value != value else value for value in row) for row in df.collect()]


HUB_TABLES = {
    "tricky": tricky,
    "crowded": crowded,
    "twice": lambda spark: crowded(spark, 150).union(crowded(spark, 150)),
    "lines": lambda spark: spark.range(500).selectExpr(
        "int(id * 7919 % 130) AS a", "int(id * 104729 % 60) AS b", "int(id * 31 % 7) AS c", "double(id * id % 83) AS d", "string(id % 3) AS e"),
}


def no_groups(*_):
    raise AssertionError("a column set was grouped for itself")


@pytest.mark.parametrize("sampled", [20, 8192])
@pytest.mark.parametrize("name", HUB_TABLES)
def test_dependencies_through_hubs_match_brute_force(spark, monkeypatch, name, sampled):
    """All pairs that agree on a hub are compared at once; no left side is grouped."""
    monkeypatch.setattr(keys, "SAMPLED", sampled)
    monkeypatch.setattr(keys, "PAIRS", 1000)
    monkeypatch.setattr(keys, "_refutations", no_groups)
    df = HUB_TABLES[name](spark)
    assert sorted(keys.find_dependencies(df)) == sorted(brute_dependencies(plain_rows(df), df.columns, len(df.columns) - 1))


@pytest.mark.parametrize("limits", [{"PAIRS": 0, "SAMPLED": 20}, {"PAIRS": 0, "SAMPLED": 20, "WHOLE": 10, "DEALT": 100, "EVIDENCE": 3},
                                    {"PAIR_COLUMNS": 2}, {"PAIR_COLUMNS": 2, "WHOLE": 10, "PART": 40, "DEALT": 100, "EVIDENCE": 3}])
def test_dependencies_without_a_hub_match_brute_force(spark, monkeypatch, limits):
    """Where too many pairs agree, and in wide tables, left sides are grouped; dealt above some rows."""
    for limit, value in limits.items():
        monkeypatch.setattr(keys, limit, value)
    df = HUB_TABLES["lines"](spark)
    assert sorted(keys.find_dependencies(df)) == sorted(brute_dependencies(plain_rows(df), df.columns, len(df.columns) - 1))


def test_dependencies_of_rows_repeated_very_often(spark, monkeypatch):
    """One row a thousand times: its pairs would leave no hub with few pairs, so rows are compared once each."""
    monkeypatch.setattr(keys, "SAMPLED", 400)
    monkeypatch.setattr(keys, "_refutations", no_groups)
    monkeypatch.setattr(keys, "PAIRS", 40)
    df = crowded(spark, 200).union(spark.range(1000).selectExpr("1", "1", "1", "'x'", "1.0D", "'y'", "1"))
    assert sorted(keys.find_dependencies(df, 3)) == sorted(brute_dependencies(plain_rows(df), df.columns, 3))


def test_pairs_of_a_hub(spark, monkeypatch):
    """Agree sets of the pairs of its groups, counted both ways, from one exchange; the session keeps its settings."""
    monkeypatch.setattr(keys, "SAMPLED", 10)
    df = spark.createDataFrame([(1, 1, None), (1, 1, None), (1, 2, "x"), (2, 2, "x"), (2, 2, None), (None, 2, "x")], "a int, b int, c string")
    pairs = keys._Pairs(df.union(df.where("false")), df.columns, 6, [False, True, False])
    assert pairs.settled(0) and pairs.settled(0b101) and 0b111 in pairs.agree
    before = spark.conf.get(keys._CLEANUP, "false")
    with keys._shuffles_dropped(spark), keys._shuffles_dropped(spark):
        assert spark.conf.get(keys._CLEANUP) == "true"
    assert spark.conf.get(keys._CLEANUP, "false") == before
    rows = df.collect()
    expected = {}
    for left in rows:
        for right in rows:
            if left["a"] == right["a"]:
                mask = sum((left[i] == right[i]) << i for i in range(3))
                expected[mask] = expected.get(mask, 0) + 1
    assert pairs._compared(df, 0b001) == expected


@pytest.mark.parametrize("sampled", [20, 8192])
@pytest.mark.parametrize("name", HUB_TABLES)
def test_unique_sets_through_hubs_match_brute_force(spark, monkeypatch, name, sampled):
    monkeypatch.setattr(keys, "SAMPLED", sampled)
    monkeypatch.setattr(keys, "_agree_sets", no_groups)
    df = HUB_TABLES[name](spark)
    assert sorted(keys.find_unique_sets(df)) == sorted(brute_unique(plain_rows(df), df.columns, len(df.columns)))


@pytest.mark.parametrize("limits", [{"PAIR_COLUMNS": 2}, {"PAIR_COLUMNS": 2, "WHOLE": 10, "PART": 40, "DEALT": 100, "EVIDENCE": 3}])
def test_unique_sets_of_wide_tables_match_brute_force(spark, monkeypatch, limits):
    for limit, value in limits.items():
        monkeypatch.setattr(keys, limit, value)
    df = HUB_TABLES["lines"](spark)
    assert sorted(keys.find_unique_sets(df)) == sorted(brute_unique(plain_rows(df), df.columns, len(df.columns)))


def test_candidates_of_a_hub_are_checked_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(keys, "DEALT", 1500)
    df = spark.range(6000).selectExpr("id % 3000 AS a", "double(id % 1500) AS b", "id % 7 AS c", "if(id < 5000, 1, id) AS hot")
    dealt = keys._Dealt(df, df.columns, 6000)
    assert dealt.hubs == [0, 1]
    for hub, mask in ((0, 0b101), (1, 0b110)):
        chosen, held = dealt.choose([mask])
        failing, _ = keys._failing_groups(held, df.columns, mask, [3])
        found = failing.collect()
        plan = failing._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].split("InMemoryRelation")[0]
        assert dealt.hub == hub and chosen == {mask} and "Exchange" not in plan
        assert len(found) == len({(r["a"] if hub == 0 else r["b"], r["c"]) for r in found})
    assert dealt.choose([0b100]) == ({0b100}, df)
    dealt.searched(True), dealt.searched(False)


def test_recommendation(spark):
    assert keys.recommend_key(spark.range(0))["message"] == keys.EMPTY_TABLE
    one = spark.createDataFrame([(1, 1), (2, 1)], "a int, b int")
    assert keys.recommend_key(one) == {"unique_columns": "a", "primary_key": "a", "message": keys.ONE_KEY}
    none = spark.createDataFrame([(1,), (1,)], "a int")
    assert keys.recommend_key(none)["message"] == keys.NO_KEY
    many = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    assert keys.recommend_key(many) == {"unique_columns": "a; b", "primary_key": "a; b", "message": keys.MANY_KEYS}
    binary = spark.sql("SELECT id, binary('x') b FROM range(3)")
    assert keys.recommend_key(binary)["primary_key"] == "id"


def test_keys_of_any_size_are_found(spark):
    wide = spark.range(81).selectExpr("id % 3 AS a", "int(id / 3) % 3 AS b", "int(id / 9) % 3 AS c", "int(id / 27) AS d")
    assert keys.find_unique_sets(wide) == [("a", "b", "c", "d")]
    assert keys.recommend_key(wide)["primary_key"] == "a,b,c,d"
    pairs = spark.range(400).selectExpr("int(id / 20) AS a", "id % 20 AS b")
    assert keys.recommend_key(pairs)["primary_key"] == "a,b"


def test_lineitem_has_no_small_key(spark):
    assert keys.find_unique_sets(spark.read.parquet(f"{SF}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_returnflag"), 3) == []


def test_key_check_on_an_empty_table(spark):
    assert keys.key_check(spark.range(0), ["id"]).first()["is_key"] is True


def test_watermark_choice(spark):
    now = datetime(2024, 6, 1)
    df = spark.sql("SELECT timestamp'2024-01-01' created_at, timestamp'2024-01-02' updated_at, timestamp'2030-01-01' ended")
    assert profile.find_watermark_column(df, now) == ("updated_at", "")
    same = df.select("created_at", df.created_at.alias("inserted"))
    column, message = profile.find_watermark_column(same, now)
    assert column == "NA" and "created_at, inserted" in message
    assert profile.find_watermark_column(df.select("ended"), now) == ("NA", profile.NO_VALID)
    assert profile.find_watermark_column(spark.range(1), now) == ("NA", profile.NO_NAME)


def test_declared_keys_spare_the_search(spark):
    declared = spark.createDataFrame([("S", "T", "b", 2), ("S", "T", "a", 1)],
                                     "table_schema string, table_name string, column_name string, ordinal_position int")
    report = profile.profile_tables(spark, {"t": lambda: spark.range(4)}, "c", "s", "keys", declared).collect()
    assert [(r["primary_key"], r["record_count"]) for r in report] == [("a,b", 4)]


def test_stats_columns(spark):
    df = spark.sql("SELECT 1 a, true b, binary('x') c, map(1, 2) m, 'z' d")
    assert profile.stats_columns(df.schema, ["b"], ["d"]) == ["a", "b"]
    wide = spark.range(1).selectExpr(*[f"id AS c{i}" for i in range(40)])
    assert profile.stats_columns(wide.schema, ["c39", "c0"]) == [f"c{i}" for i in range(len(wide.columns))]
    assert profile.stats_columns(wide.schema, ["c39", "c0"], leading_columns=32) == [f"c{i}" for i in range(32)] + ["c39"]


def test_column_stats_per_file(spark, path):
    spark.range(0, 100, 1, 2).write.parquet(path("files"))
    stats = profile.column_stats(spark.read.parquet(path("files"))).collect()
    assert sorted((r["min_value"], r["max_value"], r["rows"]) for r in stats) == [("0", "49", 50), ("50", "99", 50)]


def test_scope_choice(spark):
    source = spark.createDataFrame([(1, 5), (2, 9)], "k int, w int")
    target = spark.createDataFrame([(1, 5, None), (2, 9, None), (3, 9, 1)], "k int, w int, end_at int")

    def sizes(**options):
        return tuple(side.count() for side in reconcile.qc_scope(source, target, **options))

    assert sizes(watermark="w", previous=5) == (1, 1)
    assert sizes(watermark="w", previous=5, force_full=True) == sizes(watermark="w", previous=5, first_load=True)
    assert sizes(watermark="w", previous=None) == sizes(previous=5) == (2, 2)


def test_compare_states(spark):
    def pair(items):
        return spark.createDataFrame(items, "row_key_hash string, row_hash string")

    extra = reconcile.compare_layers(pair([("a", "1"), ("b", "2")]), pair([("a", "1")])).first()
    assert (extra["status"], extra["strict_status"], extra["only_in_source"]) == ("SUCCESS", "FAILED", 1)
    off = reconcile.compare_layers(pair([("a", "1"), ("b", "2")]), pair([("a", "9")]), source_side=False).first()
    assert (off["status"], off["only_in_source"], off["only_in_target"]) == ("FAILED", None, 1)
    empty = reconcile.compare_layers(pair([]), pair([])).first()
    assert (empty["source_count"], empty["strict_status"]) == (0, "SUCCESS")
    same = pair([("a", "1"), ("a", "1")])
    assert reconcile.mismatch_rows(same, pair([("a", "2")])).count() == 3


def test_strict_row_check(spark):
    reconcile.assert_same_rows(spark.range(3), spark.range(3))
    with pytest.raises(AssertionError, match="1 only left, 0 only right"):
        reconcile.assert_same_rows(spark.range(3), spark.range(2))


def test_qc_run_survives_failures(spark):
    broken = spark.sql("SELECT raise_error('boom') AS row_key_hash, 'x' AS row_hash")
    good = spark.sql("SELECT 'k' AS row_key_hash, 'x' AS row_hash")
    checks = [
        reconcile.TableCheck("s1", "t1", lambda: spark.read.parquet("/nowhere/at/all"), lambda: good),
        reconcile.TableCheck("s2", "t2", lambda: broken, lambda: good, "w"),
        reconcile.TableCheck("s3", "t3", lambda: good, lambda: good),
    ]
    found = reconcile.run_qc(spark, checks, reconcile.run_id_for("src"), datetime(2024, 1, 1)).collect()
    states = {r["source_table"]: r["status"] for r in found}
    assert states["s1"].startswith("FAILED - Data Fetch: ") and states["s3"] == "SUCCESS"
    assert states["s2"].startswith("FAILED - Unexpected Error: ")


def test_durations_of_copies(spark):
    rows = [("r", "t1", datetime(2024, 1, 1, 0, 0), 10)] * 3 + [("r", "t2", datetime(2024, 1, 1, 0, 2), 10)]
    log = spark.createDataFrame(rows, "run_id string, source_table string, created_at timestamp, source_count bigint")
    timed = reconcile.check_durations(log)
    assert sorted((r["source_table"], r["copies"], r["seconds"]) for r in timed.collect()) == [
        ("t1", 3, 120), ("t2", 1, None)]
    bucket = reconcile.duration_buckets(timed).first()
    assert (bucket["count_bucket"], bucket["tables_processed"], bucket["avg_seconds"], bucket["min_seconds"]) == (
        "<1K", 4, 40.0, 0)


def test_alert_operands(spark):
    result = spark.sql("SELECT 5 AS n, 'ok' AS s, true AS f, CAST(NULL AS int) AS z")
    values = first_row_values("q", result).unionByName(first_row_values("empty", result.where("false")))
    items = [
        ("1", "q", "n", "EQUAL", 5.0, None, None, False), ("2", "q", "n", "GREATER_THAN", 5.5, None, None, False),
        ("3", "q", "s", "NOT_EQUAL", None, "bad", None, False), ("4", "q", "f", "EQUAL", None, None, True, False),
        ("5", "q", "z", "IS_NULL", None, None, None, False), ("6", "q", "z", "LESS_THAN", 1.0, None, None, False),
        ("7", "empty", "n", "EQUAL", 5.0, None, None, True), ("8", "empty", "n", "IS_NULL", None, None, None, False),
        ("9", "q", "z", "EQUAL", None, None, None, False), ("10", "q", "z", "NOT_EQUAL", 1.0, None, None, False),
    ]
    alerts = spark.createDataFrame(items, "alert_id string, query_id string, column_name string, operator string, "
                                          "number_operand double, text_operand string, flag_operand boolean, "
                                          "empty_triggers boolean")
    found = {r["alert_id"]: r for r in evaluate_alerts(alerts, values).collect()}
    assert {k for k, r in found.items() if r["triggered"]} == {"1", "3", "4", "5", "7", "9"}
    assert found["1"]["condition_text"] == "n = 5" and found["2"]["condition_text"] == "n > 5.5"
    assert found["1"]["alert_result"] == "n = 5" and found["5"]["alert_result"] == "z IS NULL"
    assert found["4"]["alert_result"] == "f = True" and found["7"]["alert_result"] is None


def test_alerts_are_exact(spark):
    result = spark.sql("SELECT 9007199254740993 AS big, 2e15 AS whole, 1.50BD AS price, 0.5D AS half")
    values = first_row_values("q", result)
    alerts = spark.createDataFrame([
        ("1", "q", "big", "EQUAL", Decimal(9007199254740992), None, None, False), ("2", "q", "big", "EQUAL", Decimal(9007199254740993), None, None, False),
        ("3", "q", "whole", "GREATER_THAN", Decimal(1), None, None, False), ("4", "q", "price", "EQUAL", Decimal("1.5"), None, None, False),
        ("5", "q", "half", "LESS_THAN", Decimal(100), None, None, False)],
        "alert_id string, query_id string, column_name string, operator string, number_operand decimal(38,9), text_operand string, flag_operand boolean, "
        "empty_triggers boolean")
    found = {r["alert_id"]: r for r in evaluate_alerts(alerts, values).collect()}
    assert {k for k, r in found.items() if r["triggered"]} == {"2", "3", "4", "5"}
    assert found["1"]["alert_result"] == "big = 9007199254740993" and found["1"]["condition_text"] == "big = 9007199254740992"
    assert found["3"]["alert_result"] == "whole = 2000000000000000" and found["4"]["alert_result"] == "price = 1.5"
    assert found["5"]["alert_result"] == "half = 0.5" and found["5"]["condition_text"] == "half < 100"
    with pytest.raises(Exception, match="several values"):
        evaluate_alerts(alerts, values.unionByName(values)).collect()


def test_compute_ids(spark):
    tasks = spark.sql("SELECT * FROM VALUES (1, array('c1', 'c2')), (2, array('c2')), (3, NULL) AS t(task, compute_ids)")
    assert [r["task"] for r in usage.used_compute(tasks, "c1").collect()] == [1]


def test_run_status_verdict(spark):
    tasks = spark.createDataFrame([
        (1, "load", "SUCCESS", 10, 61_000), (1, "notify_teams_x", "FAILED", 20, 1_000), (1, "open", None, None, 0),
        (2, "load", "CANCELED", 5, 0)],
        "run_id int, task_key string, result_state string, end_time int, run_duration bigint")
    found = [tuple(r) for r in run_status(tasks, hidden="notify_teams").collect()]
    assert found == [(1, "load", "SUCCESS", "Good", 10, "01:01", True), (1, "open", "", "Default", None, "00:00", True),
                     (2, "load", "CANCELED", "Warning", 5, "00:00", False)]


def test_quartile_borders_are_whole_seconds(spark):
    df = spark.sql("""SELECT timestamp_ntz'2024-01-01 00:00:00' s, timestamp_ntz'2024-01-01 00:00:07' e,
                      explode(sequence(0, 7)) n""")
    from pyspark.sql import functions as F
    at = F.timestamp_add("SECOND", F.col("n"), F.col("s"))
    labels = [r[0] for r in df.select(usage.quartile_of_run(at, F.col("s"), F.col("e"))).collect()]
    assert labels == ["q1", "q1", "q2", "q2", "q3", "q3", "q4", "q4"]


def test_span_join_matches_brute_force(spark):
    import random
    rng = random.Random(3)
    base = datetime(2024, 1, 1).timestamp()
    samples = [(rng.choice("ab"), datetime.fromtimestamp(base + rng.randrange(900_000))) for _ in range(300)]
    spans = []
    for i in range(20):
        start = base + rng.randrange(800_000)
        spans.append((i, rng.choice("ab"), datetime.fromtimestamp(start), datetime.fromtimestamp(start + rng.randrange(300_000))))
    s = spark.createDataFrame(samples, "c string, start_time timestamp")
    p = spark.createDataFrame(spans, "run int, c string, run_start timestamp, run_end timestamp")
    expected = sorted((c, t, i) for c, t in samples for i, d, a, b in spans if c == d and a <= t <= b)
    for slot in ("6 hours", "1 day", "30 days"):
        found = usage.samples_in_spans(s, p, ["c"], slot=slot)
        assert sorted((r["c"], r["start_time"], r["run"]) for r in found.collect()) == expected


@pytest.mark.parametrize("sql, operand, operand_type, operator, triggered, shown", [
    ("cast('0.000000000001' AS decimal(38,18))", 0, "int", "EQUAL", False, "x = 0.000000000001"),
    ("cast('-0.5' AS decimal(5,2))", 0.0, "double", "LESS_THAN", True, "x = -0.5"),
    ("cast('123456789012345678901234567890' AS decimal(38,0))", 1, "int", "GREATER_THAN", True, "x = 123456789012345678901234567890"),
    ("cast('123456789012345678901234567890.5' AS decimal(38,8))", 1e30, "double", "LESS_THAN", True, "x = 123456789012345678901234567890.5"),
    ("9007199254740993L", 9007199254740992, "bigint", "EQUAL", False, "x = 9007199254740993"),
    ("cast(0.1 AS decimal(3,2))", 0.1, "double", "EQUAL", True, "x = 0.1"),
    ("cast('-3.25' AS decimal(9,4))", -3.2, "double", "LESS_THAN", True, "x = -3.25"),
    ("cast('0.00000000000000000000000000000000000001' AS decimal(38,38))", 1e-38, "double", "EQUAL", True, "x = 0." + "0" * 37 + "1"),
    ("cast('-0.00000000000000000000000000000000000001' AS decimal(38,38))", 0, "int", "LESS_THAN", True, "x = -0." + "0" * 37 + "1"),
    ("5", 1e300, "double", "LESS_THAN", True, "x = 5"),
])
def test_exact_alert_values_are_never_rounded(spark, sql, operand, operand_type, operator, triggered, shown):
    values = first_row_values("q", spark.sql(f"SELECT {sql} AS x"))
    alerts = spark.createDataFrame([("a", "q", "x", operator, operand, None, None, False)],
                                   f"alert_id string, query_id string, column_name string, operator string, number_operand {operand_type}, "
                                   "text_operand string, flag_operand boolean, empty_triggers boolean")
    found = evaluate_alerts(alerts, values).first()
    assert (found["triggered"], found["alert_result"]) == (triggered, shown)

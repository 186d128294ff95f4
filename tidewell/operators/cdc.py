"""Change capture: compare a source snapshot with the current target rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.hashing import KEY_HASH, ROW_HASH
from tidewell.operators.skew import PIECE_ROWS, apart, distinct_apart, drop_apart, hot_keys

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"
OP = "change_op"
MATCHES = "changed_matches"

#: Groups of keys that are counted to find those too large for one task.
BUCKETS = 1 << 16
_BUCKET, _SPREAD, _SIDE = "__bucket", "__spread", "__side"


def initial_changes(source: DataFrame, op: str = OP) -> DataFrame:
    """First load: every source row is an insert."""
    return source.withColumn(op, F.lit(INSERT))


def _row_marks(row_hash: str) -> list[Column]:
    """A row hash as two independent 64-bit numbers.

    Together they are as telling as the hash itself, and unlike text their least
    and greatest values are kept in place by a hash aggregate, without a sort.
    """
    return [F.xxhash64(row_hash), F.xxhash64(F.lit("second"), row_hash)]


def classify_changes(source: DataFrame, target: DataFrame, keyed: bool = True, incremental: bool = False,
                     key_hash: str = KEY_HASH, row_hash: str = ROW_HASH, op: str = OP,
                     count_matches: bool = False) -> DataFrame:
    """Change rows that turn ``target`` into ``source``; both carry row hashes.

    ================  ======================  ==================
    ..                full snapshot           incremental source
    ================  ======================  ==================
    declared key      insert, update, delete  insert, update
    no declared key   insert, delete          insert
    ================  ======================  ==================

    A source row is an update when some target row with its key has another row
    hash.  The target is reduced to one row per key (least and greatest row mark)
    before the join, so duplicate keys never multiply rows: each source row gives
    at most one change.  ``count_matches`` adds the number of differing target
    rows, which is how many pairs a plain join on the key would have produced.
    """
    if keyed and count_matches:
        return _counted_changes(source, target, incremental, key_hash, row_hash, op)
    return _joined_changes(source, target, keyed, incremental, key_hash, row_hash, op, count_matches)


def _joined_changes(source: DataFrame, target: DataFrame, keyed: bool, incremental: bool, key_hash: str, row_hash: str, op: str,
                    count_matches: bool) -> DataFrame:
    if keyed:
        marks = _row_marks(row_hash)
        ends = [end(mark).alias(f"__{name}{i}") for i, mark in enumerate(marks)
                for name, end in (("low", F.min), ("high", F.max))]
        if count_matches:
            ends.append(F.count(F.lit(1)).alias("__total"))
        versions = drop_apart(apart(target, [key_hash]).agg(*ends))
        joined = source.join(versions, key_hash, "left")
        differs = F.lit(False)
        for i, mark in enumerate(marks):
            differs = differs | (F.col(f"__low{i}") != mark) | (F.col(f"__high{i}") != mark)
        label = F.when(F.col("__low0").isNull(), INSERT).when(differs, UPDATE)
        changes = joined.withColumn(op, label).where(F.col(op).isNotNull())
        if count_matches:
            changes = _with_matches(changes, target, key_hash, row_hash, op)
    else:
        changes = source.join(distinct_apart(target, [key_hash]), key_hash, "left_anti")
        changes = changes.withColumns({op: F.lit(INSERT), MATCHES: F.lit(0).cast("bigint")})
    columns = [*source.columns, op] + ([MATCHES] if count_matches else [])
    changes = changes.select(*columns)
    if incremental:
        return changes
    gone = target.join(distinct_apart(source, [key_hash]), key_hash, "left_anti")
    gone = gone.withColumns({op: F.lit(DELETE), MATCHES: F.lit(0).cast("bigint")})
    return changes.unionByName(gone.select(*columns))


def _with_matches(changes: DataFrame, target: DataFrame, key_hash: str, row_hash: str, op: str) -> DataFrame:
    """Differing target rows: all rows of the key less those with the same row hash."""
    same = drop_apart(apart(target, [key_hash, row_hash]).agg(F.count(F.lit(1)).alias("__same")))
    differing = F.col("__total") - F.coalesce("__same", F.lit(0))
    return changes.join(same, [key_hash, row_hash], "left").withColumn(
        MATCHES, F.when(F.col(op) == UPDATE, differing).otherwise(F.lit(0)).cast("bigint"))


def _packed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` with text in ``names`` as bytes, an md5 as the 16 bytes it stands for; equal if and only if the text is."""
    def packed(name: str) -> Column:
        text = F.col(name)
        return F.when(text.rlike(r"\A[0-9a-f]{32}\z"), F.unhex(text)).when(
            text.isNotNull(), F.concat(F.lit(bytes(17)), text.cast("binary")))

    return df.withColumns({name: packed(name) for name in names})


def _unpacked(df: DataFrame, names: Sequence[str]) -> DataFrame:
    def text(name: str) -> Column:
        return F.when(F.length(name) == 16, F.lower(F.hex(name))).otherwise(
            F.substring(name, 18, 2 ** 31 - 1).cast("string"))

    return df.withColumns({name: text(name) for name in names})


def _counted_changes(source: DataFrame, target: DataFrame, incremental: bool, key_hash: str, row_hash: str, op: str,
                     min_rows: int = PIECE_ROWS) -> DataFrame:
    """Changes of keyed frames with the number of differing target rows.

    The rows of both sides meet by key in a single exchange, in which md5 texts
    travel as bytes, and windows count them.  Groups of keys too large for one
    task are found first and joined instead, so that AQE can split them.
    """
    columns = source.columns
    texts = [name for name in dict.fromkeys((key_hash, row_hash))
             if source.schema[name].dataType == target.schema[name].dataType == T.StringType()]
    held = target.select(key_hash, row_hash) if incremental else target.select(*columns)

    def placed(df: DataFrame) -> DataFrame:
        # Rows without a key match nothing and need not meet.
        spread = F.when(F.col(key_hash).isNull(), F.xxhash64(row_hash))
        return _packed(df, texts).withColumn(_SPREAD, spread).withColumn(
            _BUCKET, F.xxhash64(key_hash).bitwiseAND(BUCKETS - 1))

    sides = placed(source), placed(held)
    keyed = [side.where(F.col(key_hash).isNotNull()).select(_BUCKET) for side in sides]
    hot = hot_keys(keyed[0].unionAll(keyed[1]), [_BUCKET], min_rows=min_rows).select(_BUCKET)

    both = sides[0].withColumn(_SIDE, F.lit(0)).unionByName(sides[1].withColumn(_SIDE, F.lit(1)), allowMissingColumns=incremental)
    meeting = Window.partitionBy(key_hash, _SPREAD).orderBy(row_hash)
    of_key = meeting.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = both.join(F.broadcast(hot), _BUCKET, "left_anti").drop(_BUCKET).withColumns({
        "__rows": F.count(F.lit(1)).over(of_key),
        "__total": F.sum(_SIDE).over(of_key),
        "__same": F.sum(_SIDE).over(meeting.rangeBetween(Window.currentRow, Window.currentRow)),
    })
    alone, of_source = F.col(key_hash).isNull(), F.col(_SIDE) == 0
    label = F.when(of_source, F.when(alone | (F.col("__total") == 0), INSERT).when(F.col("__total") > F.col("__same"), UPDATE))
    if not incremental:
        label = label.when(alone | (F.col("__rows") == F.col("__total")), DELETE)
    differing = F.col("__total") - F.when(F.col(row_hash).isNotNull(), F.col("__same")).otherwise(F.lit(0))
    changes = counted.withColumn(op, label).where(F.col(op).isNotNull()).withColumn(
        MATCHES, F.when(F.col(op) == UPDATE, differing).otherwise(F.lit(0)).cast("bigint"))
    cold = _unpacked(changes.select(*columns, op, MATCHES), texts)

    large = [_unpacked(side.join(F.broadcast(hot), _BUCKET, "left_semi").drop(_BUCKET, _SPREAD), texts) for side in sides]
    return cold.unionByName(_joined_changes(*large, True, incremental, key_hash, row_hash, op, True))

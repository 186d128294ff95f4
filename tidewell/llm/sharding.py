"""Uniform shuffle of a table into shards of exact size, by a hypergeometric communication matrix.

1. Every source partition permutes its rows locally (a sort by random keys inside the task) and
   numbers them; the result is written once, so later passes and lost executors see the same rows.
2. The matrix of partition-to-shard counts is drawn exactly, as a uniform shuffle of all rows
   would give it: its rows add up to the partitions, its columns to the shards.  Partitions are the leaves of
   a tree of ``FAN`` children a node.  A node deals its shard counts out to its children by
   hypergeometric draws, so each level is one projection and no row sees more than ``FAN`` children.
3. The first rows of a partition's permutation go to shard 0, the next to shard 1, as the matrix says.
4. Each shard permutes again: rows fall into buckets by their second random key, the buckets are
   counted, and a row's slot is its bucket's first slot plus its rank there.

Only DataFrame functions run.  A hypergeometric number is drawn by inversion: weights relative to the most
likely value follow from the ratio of neighbours, for all values within ``SPREAD`` standard deviations (beyond,
less than 1e-20 of the mass is left), and a uniform number hashed from seed, level, node and shard picks one.

Work per task does not depend on the values in the table: partitions are the scan's, buckets have about ``BUCKET`` rows, so a
key, text or group that fills a third of the table changes nothing.

Law: ``rows``.  Shard sizes are at most one apart; the first ``rows mod shards`` shards hold the extra ones.
Repeated rows are separate rows, nulls are values like others, an empty table gives an
empty result and shards without rows are allowed.  All columns are kept; the added columns ``shard`` (int) and
``slot`` (long, gapless from 0 in each shard) replace columns of these names.  The same seed gives the same
shuffle while the scan's partitions stay the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import materialise, quoted, unused

FAN = 16
SPREAD = 10
BUCKET = 1 << 18
#: Tables of up to so many narrow rows are sent to every task; larger ones are joined by a shuffle.
SENT_ROWS = 1 << 16
LOW_33_BITS = (1 << 33) - 1


def uniform(seed: int, *keys: Column) -> Column:
    """A number in (0, 1) that the keys determine."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11).cast("double") + 0.5) / 2.0 ** 53


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, where a repeated expression would be computed again each time."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` rows, taken without replacement, are good; ``u`` is uniform in (0, 1)."""
    none = F.lit(0).cast("long")
    urn = F.struct(*[c.cast("double").alias(x) for x, c in (("good", good), ("bad", bad), ("draws", draws))], u.alias("u"),
                   F.greatest(none, draws - bad).alias("low"), F.least(draws, good).alias("high"))
    return let(urn, lambda x: F.when(x["low"] == x["high"], x["low"]).otherwise(let(around_mode(x), lambda r: pick(x, r))))


def around_mode(x: Column) -> Column:
    """The most likely number of good rows and the borders beyond which nothing is drawn."""
    total = x["good"] + x["bad"]
    mode = F.greatest(x["low"], F.least(x["high"], F.floor((x["draws"] + 1) * (x["good"] + 1) / (total + 2)).cast("long")))
    variance = x["draws"] * (x["good"] / total) * (x["bad"] / total) * (total - x["draws"]) / F.greatest(total - 1, F.lit(1.0))
    reach = F.ceil(F.sqrt(variance) * SPREAD).cast("long") + 20
    return F.struct(mode.alias("mode"), F.greatest(x["low"], mode - reach).alias("first"), F.least(x["high"], mode + reach).alias("last"))


def pick(x: Column, r: Column) -> Column:
    """The number at which the weights, added up from the mode, then above it, then below it, pass ``u`` of their sum."""
    def ratio(k: Column) -> Column:
        """Weight of k + 1 against that of k."""
        k = k.cast("double")
        return (x["good"] - k) * (x["draws"] - k) / ((k + 1) * (x["bad"] - x["draws"] + k + 1))

    def walk(start: Column, numbers: Column, weigh: Callable[[Column], Column], wanted: Column) -> Column:
        def step(s: Column, k: Column) -> Column:
            return let(s["w"] * weigh(k), lambda w: F.struct(
                w.alias("w"), (s["sum"] + w).alias("sum"), F.when(s["at"].isNull() & (s["sum"] + w > wanted), k).otherwise(s["at"]).alias("at")))
        return F.aggregate(numbers, start, step)

    def state(total: Column, at: Column) -> Column:
        return F.struct(F.lit(1.0).alias("w"), total.alias("sum"), at.alias("at"))

    def both(wanted: Column) -> Column:
        above = walk(state(F.lit(1.0), F.when(wanted < 1, r["mode"])), numbers(r["mode"], r["last"], 1), lambda k: ratio(k - 1), wanted)
        return let(above, lambda s: walk(state(s["sum"], s["at"]), numbers(r["mode"], r["first"], -1), lambda k: 1 / ratio(k), wanted))

    def numbers(mode: Column, end: Column, step: int) -> Column:
        return F.when(mode == end, F.array().cast("array<long>")).otherwise(F.sequence(mode + step, end, F.lit(step).cast("long")))

    return let(both(F.lit(float("inf")))["sum"] * x["u"], lambda wanted: F.coalesce(both(wanted)["at"], r["mode"]))


def split(counts: Column, part: Column, shards: int, seed: int, *keys: Column) -> Column:
    """How many rows of each shard fall to a share of ``part`` rows, where ``counts`` are the rows of each shard."""
    def draw(state: Column, s: Column) -> Column:
        here = F.element_at(counts, s + 1)
        return let(hypergeometric(here, state["rest"] - here, state["part"], uniform(seed, s, *keys)), lambda got: F.struct(
            (state["rest"] - here).alias("rest"), (state["part"] - got).alias("part"), F.concat(state["out"], F.array(got)).alias("out")))

    start = F.struct(F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b).alias("rest"), part.alias("part"), F.array().cast("array<long>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, draw)["out"]


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def communication_matrix(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """Rows (part, counts) of the drawn matrix, from rows (part long, n long) of the partitions' sizes.

    The distinct values of ``part`` are non-negative.  Column sums are ``shard_sizes`` of all rows.
    """
    top = counts.agg(F.max("part").alias("part"), F.sum("n").alias("n")).head()
    levels, rows = 1, top.n or 0
    while FAN ** levels <= (top.part or 0):
        levels += 1
    # Children of every node, leaves first.
    below, nodes = [], counts.select(F.col("part").alias("node"), "n")
    for _ in range(levels):
        grouped = (nodes.groupBy(F.expr(f"node div {FAN}").alias("node"))
                   .agg(F.array_sort(F.collect_list(F.struct(F.col("node").alias("child"), "n"))).alias("children"), F.sum("n").alias("n")))
        below.append(grouped.select("node", "children"))
        nodes = grouped.select("node", "n")
    sizes = F.array(*[F.lit(x).cast("long") for x in shard_sizes(rows, shards)])
    for level, children in enumerate(reversed(below)):
        held = drawn.join(children, "node") if level else children.withColumn("counts", sizes)
        drawn = materialise(held.select(F.inline(deal(shards, seed, level))), "matrix")
    return drawn.select(F.col("node").alias("part"), "counts")


def deal(shards: int, seed: int, level: int) -> Column:
    """Rows (node, counts) of a node's children: each draws from what its elder siblings left."""
    def next_child(state: Column, child: Column) -> Column:
        return let(split(state["left"], child["n"], shards, seed, F.lit(level), child["child"]), lambda got: F.struct(
            F.zip_with(state["left"], got, lambda a, b: a - b).alias("left"),
            F.concat(state["out"], F.array(F.struct(child["child"].alias("node"), got.alias("counts")))).alias("out")))

    none = F.array().cast("array<struct<node:bigint,counts:array<bigint>>>")
    return F.aggregate(F.col("children"), F.struct(F.col("counts").alias("left"), none.alias("out")), next_child)["out"]


def sent(small: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast where its number of rows is small enough."""
    return F.broadcast(small) if rows <= SENT_ROWS else small


def shuffle_shards(frame: DataFrame, shards: int = 8, seed: int = 1) -> DataFrame:
    """All rows and columns with their ``shard`` and ``slot``."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    kept = [quoted(c) for c in frame.columns if c.lower() not in ("shard", "slot")]
    part, place, key, group, first, rank = (unused(frame, f"__{n}") for n in ("part", "place", "key", "bucket", "first", "rank"))
    # Local permutation; the number of a row within its task is its place in it.
    mixed = materialise(
        frame.select(*kept, F.rand(seed).alias(place), F.rand(seed + 1).alias(key)).sortWithinPartitions(place)
        .withColumn(part, F.spark_partition_id().cast("long"))
        .withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit(LOW_33_BITS))), "local")
    counts = materialise(mixed.groupBy(F.col(part).alias("part")).agg(F.count("*").alias("n")), "counts")
    parts, rows = counts.count(), counts.agg(F.sum("n")).head()[0] or 0
    matrix = communication_matrix(counts, shards, seed)
    # The shard of a place is the first whose counts up to it exceed the place.
    ends = [F.aggregate(F.slice("counts", 1, s + 1), F.lit(0).cast("long"), lambda a, b: a + b) for s in range(shards)]
    borders = matrix.select(F.col("part").alias(part), F.array(*ends).alias(first))
    buckets = max(1, -(-rows // (shards * BUCKET)))
    dealt = (mixed.join(sent(borders, parts), part)
             .withColumn("shard", F.size(F.filter(first, lambda end: end <= F.col(place))))
             .withColumn(group, F.floor(F.col(key) * buckets).cast("int")).drop(first))
    filled = materialise(dealt.groupBy("shard", group).agg(F.count("*").alias("n")), "buckets")
    before = filled.select("shard", group, F.expr(
        f"coalesce(sum(n) OVER (PARTITION BY shard ORDER BY {group} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias(first))
    ranked = dealt.withColumn(rank, F.expr(f"row_number() OVER (PARTITION BY shard, {group} ORDER BY {key}, {part}, {place})"))
    return (ranked.join(sent(before, shards * buckets), ["shard", group])
            .select(*kept, "shard", (F.col(first) + F.col(rank) - 1).alias("slot")))


def write_shards(frame: DataFrame, path: str, shards: int = 8, seed: int = 1) -> None:
    """Write the shuffled rows under ``path``, one folder a shard, ordered by slot within each file.

    A shard is written by as many tasks as its slots need, so no task holds a whole shard.
    """
    (shuffle_shards(frame, shards, seed).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))

"""Near-duplicate documents by bottom-k sketches of one hash function.

A document is the set of its word shingles.  Equal sets form a class, and classes
are compared by the ``INDEX`` smallest hash values of their sets (bottom-k sketch):

1. the sketch values are ordered rarest first over the corpus and each class enters
   the inverted lists of its first few: two sets of the wanted similarity share more
   than the values left out, but for a chance below 1e-8;
2. in each list, classes meet one central class; each class is estimated from the union
   of both sketches with the centre it shares most lists with, then verified on full sets,
   and components are formed;
3. the classes around one centre that are still in different components are compared
   on full sets, in tiles of bounded size;
4. so are those of different centres in the remaining lists, estimated from the union of
   both sketches in blocks of bounded size, then verified on full sets.

A group of copies thus costs about one comparison a member, and yet every pair whose
link could join two components is decided on full sets.

Nulls, empty texts and texts without words have no shingles and link with nothing.
Rows without id are returned with null component and kept.  Repeated rows are copies
of each other.  Rows that share an id but not the text are judged each by its text.
Ties cannot arise: the smallest id of a component is kept.  Columns beside id and
text are not read, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import (
    arrow_schema,
    batch_of,
    distinct,
    materialise,
    ngrams,
    packed,
    quoted,
    set_key,
    signed,
    slices,
    strings,
    unpacked,
    unused,
    whole_groups,
    words_of,
)
from tidewell.llm.components import connected_components
from tidewell.llm.rarity import COUNTS_DDL, counted, rarity_table

#: Values of a sketch, rarity buckets, classes of a tile, entries of a block of a long list.
INDEX, BUCKETS, TILE, BLOCK = 64, 1 << 22, 1024, 8192
#: Bits of the filter of needed classes; fixed, so it may be sent to every task.
FILTER_BITS = 1 << 23

SIGNATURES = "doc_id long, n_shingles long, h1 long, h2 long, sketch binary"
ENTRIES = "value long, c long, rep long, n long, weight long"
SETS = "c long, members binary"
PAIRS = "a long, b long"


def needed_overlap(percent: int) -> int:
    """Sketch values that two full sketches share at this similarity, less six deviations."""
    t = percent / 100
    return int(INDEX * t - 6 * (INDEX * t * (1 - t)) ** 0.5)


def prefix_length(n: int, percent: int) -> int:
    """How many of the rarest sketch values of a set with ``n`` members are indexed.

    A sketch smaller than the limit is the whole set, where similarity t needs
    overlap of t times the larger set.  Both rules hold where the two kinds meet.
    """
    if n * 100 < INDEX * percent:
        return n - -(-n * percent // 100) + 1
    return min(n, INDEX) - min(needed_overlap(percent), min(n, INDEX)) + 1


def _shingle_sets(batch: pa.RecordBatch, words: int) -> list[np.ndarray]:
    values, offsets = ngrams(words_of(strings(batch.column("text"))), words)
    return [distinct(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]


def _signatures(words: int):
    schema = arrow_schema(SIGNATURES)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                sets = _shingle_sets(piece, words)
                keys = [set_key(s) for s in sets]
                yield batch_of(schema, [piece.column("doc_id"), [len(s) for s in sets], [k[0] for k in keys],
                                        [k[1] for k in keys], packed([s[:INDEX] for s in sets])])
    return sign


def _entries(rarity, percent: int):
    schema = arrow_schema(ENTRIES)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = rarity.value
        for batch in (piece for b in batches for piece in slices(b, "sketch")):
            values, sizes, rare = [], [], []
            for sketch, n in zip(unpacked(batch.column("sketch")), batch.column("n").to_pylist()):
                rank = ranks[(sketch & np.uint64(BUCKETS - 1)).astype(np.int64)]
                order = np.lexsort((sketch, rank))[:prefix_length(n, percent)]
                values.append(sketch[order])
                sizes.append(len(order))
                rare.append(int((rank <= 8).sum()))
            repeat = np.asarray(sizes)
            take = lambda name: np.repeat(batch.column(name).to_numpy(), repeat)
            # Much copied sets with few rare values are central in their group.
            weight = np.repeat(np.asarray(rare, np.int64), repeat) - 1000 * np.minimum(take("copies"), 1 << 30)
            if len(repeat):
                yield batch_of(schema, [signed(np.concatenate(values)), take("c"), take("rep"), take("n"), weight])
    return index


def _members(filter_bits: np.ndarray, words: int):
    schema = arrow_schema(SETS)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            batch = batch.filter(pa.array((filter_bits[slot >> 3] >> (slot & 7)) & 1 == 1))
            for piece in slices(batch, "text"):
                sets = _shingle_sets(piece, words)
                yield batch_of(schema, [[set_key(s)[0] for s in sets], packed(sets)])
    return pick


def bit_filter(ids: DataFrame, column: str) -> np.ndarray:
    """Bits of hashed ids, as bytes; at most FILTER_BITS / 8 bytes reach the driver."""
    slots = ids.select(slot_of(column).alias("slot")).select(
        F.expr("slot div 32768").alias("part"), F.expr("slot % 32768").alias("bit"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in slots.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        out[row.part * 4096:row.part * 4096 + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return out


def slot_of(column: str):
    return F.pmod(F.xxhash64(F.col(column)), F.lit(FILTER_BITS))


def margin(percent: int) -> float:
    """Estimates this low refute a similarity of ``percent``, but for six deviations."""
    t = percent / 100
    return t - 6 * (t * (1 - t) / INDEX) ** 0.5


def may_be_similar(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of sketches (rows of ``a`` and ``b``, filled up with the largest integer) that are not refuted.

    Below the smaller of both sketches' largest values both sets are known completely, so
    the share of common values there estimates the similarity of the sets; it is exact for
    sets no larger than a sketch.
    """
    fill = np.uint64(2 ** 64 - 1)
    top = np.minimum(np.where(n_a > INDEX, a[:, -1], fill), np.where(n_b > INDEX, b[:, -1], fill))[:, None]
    known = (a <= top).sum(axis=1) + (b <= top).sum(axis=1) - ((a == fill).sum(axis=1) + (b == fill).sum(axis=1)) * (top[:, 0] == fill)
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    shared = ((both[:, 1:] == both[:, :-1]) & (both[:, 1:] != fill)).sum(axis=1)
    exact = (n_a <= INDEX) & (n_b <= INDEX)
    return np.where(exact, 100 * shared >= percent * (known - shared), shared >= margin(percent) * (known - shared))


def sketch_rows(column: pa.Array) -> np.ndarray:
    """Sketches as rows of equal length."""
    return np.frombuffer(b"".join(v.ljust(8 * INDEX, b"\xff") for v in column.to_pylist()), np.uint64).reshape(-1, INDEX)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test on full sets."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _estimated(percent: int):
    """Pairs with sketches that are not refuted."""
    schema = arrow_schema(PAIRS)

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for b in batches for piece in slices(b, "sketch_a")):
            keep = may_be_similar(sketch_rows(batch.column("sketch_a")), sketch_rows(batch.column("sketch_b")),
                                  batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_())).cast(schema)
    return estimate


def _verified(percent: int):
    schema = arrow_schema(PAIRS)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for b in batches for piece in slices(b, "set_a")):
            keep = [similar(a, b, percent) for a, b in zip(unpacked(batch.column("set_a")), unpacked(batch.column("set_b")))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_())).cast(schema)
    return verify


def _incidence(sets: list[np.ndarray]) -> np.ndarray:
    """Rows are sets, columns the values that several of them hold."""
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    used = np.bincount(codes, minlength=len(values)) > 1
    column = np.cumsum(used) - 1
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    wide = np.zeros((len(sets), int(used.sum())), np.float32)
    shared = used[codes]
    wide[row[shared], column[codes[shared]]] = 1
    return wide


def _open_rows(comp: np.ndarray) -> tuple[np.ndarray, int]:
    """Rows outside the commonest component, and that component."""
    members, counts = np.unique(comp, return_counts=True)
    main = members[counts.argmax()]
    return np.flatnonzero(comp != main), main


def _tile(percent: int):
    """Links between rows of one tile that are in different components: a spanning forest of them."""
    schema = arrow_schema(PAIRS)

    def compare(group):
        ids, comp, n, side = (group.column(x).to_numpy() for x in ("c", "comp", "n", "side"))
        sets = unpacked(group.column("members").combine_chunks())
        found = _forest(sets, comp, n, side, percent) if len(ids) > 1 else []
        return pa.table([pa.array([int(ids[i]) for i, _ in found], pa.int64()),
                         pa.array([int(ids[j]) for _, j in found], pa.int64())], schema=schema)
    return compare


def _forest(sets: list[np.ndarray], comp: np.ndarray, n: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    wide = _incidence(sets)
    odd, main = _open_rows(comp)
    every = np.arange(len(sets))
    found: list[tuple[int, int]] = []
    parent = {int(c): int(c) for c in np.unique(comp)}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for part in np.array_split(odd, max(1, len(odd) // 128)):
        overlap = wide[part] @ wide.T
        # A pair of two odd rows is met twice, a pair with a main row once.
        wanted = ((comp == main)[None, :] | (part[:, None] < every[None, :])) & (comp[part][:, None] != comp[None, :])
        wanted &= (side[part][:, None] != side[None, :]) | (side[None, :] == 0)
        wanted &= 100 * overlap >= percent * (n[part][:, None] + n[None, :] - overlap)
        for x, y in zip(*np.nonzero(wanted)):
            i, j = int(part[x]), int(y)
            p, q = root(int(comp[i])), root(int(comp[j]))
            if p != q:
                found.append((i, j))
                parent[p] = q
    return found


def _across(percent: int):
    """Pairs of each list in different components and around different centres that sketches do not refute."""
    schema = arrow_schema(PAIRS)
    names = ("value", "low", "high", "side", "c", "n", "comp", "centre", "sketch")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in whole_groups(batches, names, 3):
            order = np.lexsort((columns[5], columns[2], columns[1], columns[0]))
            value, low, high, side, c, n, comp, centre, sketch = (x[order] for x in columns)
            group = np.cumsum(np.concatenate([[0], (value[1:] != value[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])]))
            sketches = sketch_rows(pa.array(sketch, pa.binary()))
            i, step = np.arange(len(c)), 0
            while True:
                step += 1
                i = i[i + step < len(c)]
                i = i[group[i] == group[i + step]]
                i = i[100 * n[i] >= percent * n[i + step]]
                if not len(i):
                    break
                j = i + step
                open_ = (comp[i] != comp[j]) & (centre[i] != centre[j]) & (centre[i] != c[j]) & (centre[j] != c[i])
                open_ &= (side[i] == 0) | (side[i] != side[j])
                for part in np.array_split(np.flatnonzero(open_), max(1, int(open_.sum()) // 20_000)):
                    a, b = i[part], j[part]
                    near = may_be_similar(sketches[a], sketches[b], n[a], n[b], percent)
                    yield batch_of(schema, [c[a[near]], c[b[near]]])
    return compare


def _tiles(rows: DataFrame, sizes: DataFrame, blocks: str, *columns: str) -> DataFrame:
    """Rows of each group dealt to pairs of blocks, so that no task's part grows with its group.

    ``side`` is 0 where a block meets itself, else 1 and 2.
    """
    dealt = rows.join(sizes, "value").withColumn("blocks", F.expr(f"int(ceil({blocks}))")).withColumn(
        "block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return dealt.select("value", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                        F.expr("case when block = other then 0 when block < other then 1 else 2 end").alias("side"),
                        "c", "n", "comp", *columns)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    joined = pairs.join(sets.select(F.col("c").alias("a"), F.col("members").alias("set_a")), "a").join(
        sets.select(F.col("c").alias("b"), F.col("members").alias("set_b")), "b")
    return joined.select("a", "b", "set_a", "set_b").mapInArrow(_verified(percent), PAIRS)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5,
                    percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; linked at ``percent`` similarity or more."""
    spark = docs.sparkSession
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed_docs = materialise(plain.mapInArrow(_signatures(words), SIGNATURES), "signatures")
    usable = signed_docs.where("n_shingles > 0 and doc_id is not null")
    classes = materialise(
        usable.groupBy("h1", "h2", "n_shingles").agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("sketch").alias("sketch"))
        .select(F.col("h1").alias("c"), "h2", F.col("n_shingles").alias("n"), "rep", "copies", "sketch"), "classes")
    links = _links(spark, plain, classes, words, percent)
    found = connected_components(links, "a", "b")
    named = classes.select("c", "h2", "rep").join(found, classes.c == found.node, "left")
    named = materialise(named.select("c", "h2", "rep", F.coalesce("component", "c").alias("component")), "named")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    label = named.join(least, "component").select(F.col("c").alias("h1"), "h2", "component_id")
    labelled = usable.join(label, ["h1", "h2"]).select("doc_id", "n_shingles", "component_id")
    alone = signed_docs.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return labelled.unionByName(alone).withColumn("kept", F.expr("coalesce(doc_id = component_id, true)"))


def _links(spark, plain: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Verified links between classes that give the components of all links."""
    counts = classes.select("sketch").mapInArrow(
        counted(lambda b: (np.concatenate(unpacked(p.column("sketch"))) for p in slices(b, "sketch")), BUCKETS), COUNTS_DDL)
    rarity = spark.sparkContext.broadcast(rarity_table(counts, BUCKETS))
    entries = materialise(classes.select("c", "rep", "n", "copies", "sketch").mapInArrow(_entries(rarity, percent), ENTRIES), "entries")
    lists = entries.groupBy("value").agg(F.count("*").alias("size"), F.min(F.struct("weight", "rep", "c", "n")).alias("pivot"))
    shared = materialise(entries.join(lists.where("size > 1"), "value"), "lists")

    # One promising pair a class: the centre it shares most lists with.
    star = shared.where(f"c <> pivot.c and 100 * least(n, pivot.n) >= {percent} * greatest(n, pivot.n)").groupBy(
        F.col("c").alias("a"), F.col("pivot.c").alias("b")).agg(F.count("*").alias("lists"))
    best = star.groupBy("a").agg(F.max_by("b", F.struct("lists", "b")).alias("b"))
    side = lambda x: classes.select(F.col("c").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
    close = materialise(best.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(_estimated(percent), PAIRS), "close")
    sets = _full_sets(plain, classes, close, words)
    links = materialise(_verify(close, sets, percent), "star-links")
    centres = materialise(shared.select("c", "n").distinct().join(close.withColumnRenamed("a", "c"), "c", "left").select(
        "c", "n", F.coalesce("b", "c").alias("centre")), "centres")
    apart = (F.min("comp") != F.max("comp")).alias("apart")

    # Around one centre, on full sets.
    placed = _placed(centres, links).withColumn("value", F.col("centre"))
    sizes = placed.groupBy("value").agg(F.count("*").alias("size"), F.sum("n").alias("weight"), apart).where("apart").drop("apart")
    inner = _tiles(placed, sizes, f"greatest(size / {TILE // 2}, weight / {TILE * 512})").join(sets, "c").groupBy(
        "value", "low", "high").applyInArrow(_tile(percent), PAIRS)
    links = materialise(links.unionByName(inner), "centre-links")

    # Across centres, in the lists.
    placed = materialise(shared.select("value", "c").join(_placed(centres, links), "c"), "placed")
    mixed = (F.min("centre") != F.max("centre")).alias("mixed")
    sizes = placed.groupBy("value").agg(F.count("*").alias("size"), apart, mixed).where("apart and mixed").select("value", "size")
    dealt = _tiles(placed, sizes, f"size / {BLOCK}", "centre").join(classes.select("c", "sketch"), "c")
    rough = dealt.repartition("value", "low", "high").sortWithinPartitions("value", "low", "high").mapInArrow(_across(percent), PAIRS)
    pairs = materialise(rough.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "open-pairs")
    sets = _full_sets(plain, classes, pairs, words)
    return materialise(links.unionByName(_verify(pairs, sets, percent)), "links")


def _full_sets(plain: DataFrame, classes: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """Full sets of the classes in ``pairs``, from the texts that may hold them."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct()
    bits = bit_filter(classes.join(wanted, "c").select("rep"), "rep")
    near = plain.withColumn("slot", slot_of("doc_id")).mapInArrow(_members(bits, words), SETS)
    return materialise(near.join(wanted, "c").groupBy("c").agg(F.first("members").alias("members")), "sets")


def _placed(centres: DataFrame, links: DataFrame) -> DataFrame:
    """Classes with centre and present component."""
    component = connected_components(links, "a", "b")
    return centres.join(component, centres.c == component.node, "left").select(
        "c", "n", "centre", F.coalesce("component", "c").alias("comp"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component; all columns stay.

    Rows without id stay.  Repeated rows are one document.
    """
    key, mark = F.col(quoted(doc_id)), unused(docs, "text_hash")
    gone = near_duplicates(docs, doc_id, text, words, percent).where("not kept").select(F.col("doc_id").alias(mark)).distinct()
    kept = docs.join(gone, key.cast("long") == F.col(mark), "left_anti")
    known = kept.where(key.isNotNull()).withColumn(mark, F.xxhash64(F.col(quoted(text)))).dropDuplicates([doc_id, mark]).drop(mark)
    return known.unionByName(kept.where(key.isNull()))

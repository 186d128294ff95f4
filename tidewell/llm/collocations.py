"""Collocations by dynamic itemset counting: phrase lengths are counted together, in cyclic scans of shards.

Texts are dealt into ``SHARDS`` written shards.  Scan t reads shard t mod ``SHARDS`` and counts every phrase that is
active.  Words are active from the start.  A longer phrase becomes active at the end of the scan in which both of its
subphrases (without its last, without its first word) reach the least count, is counted for exactly one
full cycle from the next scan on, and then is complete.  So bigrams start after the first shard, while
words are still being counted, and scans end when nothing is left to complete.

Counts of the scans stand in ``2 ** BITS`` counters for each length, where phrases are placed by hash.  A counter is
never below the count of any of its phrases, so a phrase may become active early, by a neighbour in its counter, but
never late.  The moment of activation depends on the counters alone, is kept with them and never changes, which is what makes the
cycle of every phrase a full one.  What tasks are sent is therefore of fixed size, whatever the corpus.

The last pass counts, each by itself, all phrases whose counters and whose subphrases' counters reached the least
count; the counters only choose what is counted there.  The fuller the counters, the more
phrases that turn out too rare are counted in that pass: from some 10^9 words on, choose more ``bits``.  Results do not depend on it.

Words, cuts and scores: see ``collocations``.  Null texts are empty, a null language is ``und``.  Repeated rows count each
time.  A text of any length is cut into no windows, its pieces are phrases' borders.  Other columns do not matter.  An empty
table gives no rows.  A frequent word, phrase or text costs one counter or row a task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import LOWER, arrow_schema, batch_of, bytes_of, chain, materialise, mix, packed, quoted, runs, signed, slices, strings, words_in
from tidewell.session import scratch_path

SHARDS = 4
BITS = 24
LONGEST = 4
#: Parts of a language's phrases that are ranked apart before the best of each are ranked together.
PARTS = 64
#: Counters in one row of what tasks exchange.
CHUNK_BITS = 16
#: Different phrases that a task gathers before it sends their counts on, and bits of a hash that say with which others it is sent.
HELD, PIECE_BITS = 1 << 20, 9
#: Slots that a task gathers before it adds them up, and bytes of text that it works on at a time.
HELD_SLOTS, SLICE = 1 << 21, 2 << 20
BREAKS = np.zeros(256, bool)
BREAKS[[ord(c) for c in ".,;:!?"]] = True
BREAKS[10:14] = True
BLANKED = np.where(BREAKS, 10, np.arange(256)).astype(np.uint8)


def name_hash(name: str) -> int:
    return int.from_bytes(blake2b(name.encode(), digest_size=8).digest(), "little")


class Phrases:
    """Phrases of some texts: ``hashes[n]`` of the phrase of n words that starts at each word, ``whole[n]`` where it exists."""

    def __init__(self, batch: pa.RecordBatch):
        texts, langs = strings(batch.column(0)), strings(batch.column(1))
        data, bounds = bytes_of(texts)
        self.words = words_in(BLANKED[data], bounds)
        self.total = len(self.words.hashes)
        self.lang = np.repeat(np.arange(len(texts)), self.words.counts)
        self.names = langs.to_pylist()
        breaks = np.concatenate([[0], np.cumsum(BREAKS[data])])[self.words.starts] if self.total else np.zeros(0, np.int64)
        seeds = np.array([name_hash(name) for name in self.names], np.uint64)
        first = mix(self.words.hashes ^ mix(seeds[self.lang] + np.uint64(1))) if self.total else np.zeros(0, np.uint64)
        self.hashes, self.whole = {1: first}, {1: np.ones(self.total, bool)}
        for n in range(2, LONGEST + 1):
            size = max(self.total - n + 1, 0)
            end = slice(n - 1, n - 1 + size)
            self.hashes[n] = chain(self.hashes[n - 1][:size], first[end])
            self.whole[n] = (breaks[:size] == breaks[end]) & (self.lang[:size] == self.lang[end])

    def texts(self, at: np.ndarray, n: int) -> np.ndarray:
        """The phrases of n words that start at the given words, their words joined by a space."""
        low, starts, ends = LOWER[self.words.data].tobytes(), self.words.starts, self.words.ends
        out = [low[a:b] for a, b in zip(starts[at].tolist(), ends[at + n - 1].tolist())]
        gaps = sum((starts[at + i] - ends[at + i - 1] for i in range(1, n)), np.zeros(len(at), np.int64))
        tabs = self.words.data[np.minimum(ends[at], len(low) - 1)] == 9
        for i in range(1, n - 1):
            tabs |= self.words.data[ends[at + i]] == 9
        for k in np.flatnonzero((gaps > n - 1) | (tabs & (n > 1))).tolist():
            i = int(at[k])
            out[k] = b" ".join(low[a:b] for a, b in zip(starts[i:i + n].tolist(), ends[i:i + n].tolist()))
        made = np.empty(len(out), object)
        made[:] = out
        return made


class Reached:
    """When each counter reached the least count: the scan after which it did, from 1; 0 for not yet."""

    def __init__(self, times: np.ndarray):
        self.times, self.bits = times, int(times.shape[1]).bit_length() - 1

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, phrases: Phrases, n: int) -> np.ndarray:
        return self.times[n - 1][self.slots(phrases.hashes[n])]

    def active_from(self, phrases: Phrases, n: int) -> np.ndarray:
        """First scan that counts each phrase, or 0 where a subphrase has not reached the least count."""
        below = self.of(phrases, n - 1)
        size = len(phrases.hashes[n])
        early, late = below[:size], below[1:size + 1]
        return np.where((early > 0) & (late > 0), np.maximum(early, late), 0)

    def send(self, frame: DataFrame) -> Broadcast:
        return frame.sparkSession.sparkContext.broadcast((self.times.shape, zlib.compress(self.times.tobytes(), 1)))

    @staticmethod
    def receive(sent: Broadcast) -> Reached:
        shape, held = sent.value
        return Reached(np.frombuffer(zlib.decompress(held), np.uint8).reshape(shape))


COUNTERS = "piece long, places binary, counts binary"


def counter_rows(slots: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Sorted slots and their counts as rows of one chunk each; counts beyond 65,535 are as good as that."""
    pieces = slots >> CHUNK_BITS
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(pieces)) + 1, [len(slots)]]).tolist()
    places, held = (slots & ((1 << CHUNK_BITS) - 1)).astype(np.uint16), np.minimum(counts, 65_535).astype(np.uint16)
    spans = list(zip(cuts, cuts[1:])) if len(slots) else []
    return batch_of(arrow_schema(COUNTERS), [
        pa.array(pieces[[a for a, _ in spans]] if spans else [], pa.int64()),
        pa.array([places[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([held[a:b].tobytes() for a, b in spans], pa.binary())])


def scan(shard: DataFrame, reached: Reached, t: int, shards: int) -> DataFrame:
    """Counter rows of one shard."""
    sent, bits = reached.send(shard), reached.bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Reached.receive(sent)
        held: list[np.ndarray] = []
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                phrases = Phrases(piece)
                for n in range(1, LONGEST + 1):
                    counted = phrases.whole[n]
                    if n > 1:
                        since = known.active_from(phrases, n)
                        counted = counted & (since > 0) & (since <= t) & (t < since.astype(np.int64) + shards)
                    elif t >= shards:
                        continue
                    held.append(known.slots(phrases.hashes[n][counted]) + ((n - 1) << bits))
                if sum(map(len, held)) > HELD_SLOTS:
                    yield counter_rows(*np.unique(np.concatenate(held), return_counts=True))
                    held = []
        if held:
            yield counter_rows(*np.unique(np.concatenate(held), return_counts=True))

    return shard.mapInArrow(count, COUNTERS)


def add_counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the same chunk added up; a task holds its chunks, 128 kB each."""
    tables: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, places, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
            table = tables.setdefault(piece, np.zeros(1 << CHUNK_BITS, np.uint16))
            at, more = np.frombuffer(places, np.uint16), np.frombuffer(counts, np.uint16)
            table[at] = np.minimum(table[at].astype(np.uint32) + more, 65_535)
    for piece, table in tables.items():
        at = np.flatnonzero(table)
        yield counter_rows((piece << CHUNK_BITS) + at, table[at])


def summed(rows: DataFrame) -> DataFrame:
    """One row a chunk: added up within groups of tasks first, so that no task reads a chunk from all others."""
    tasks = rows.rdd.getNumPartitions()
    if tasks > 64:
        group = F.pmod(F.spark_partition_id(), F.lit(int(np.ceil(np.sqrt(tasks)))))
        rows = rows.withColumn("share", group).repartition("piece", "share").drop("share").mapInArrow(add_counters, COUNTERS)
    return rows.repartition("piece").mapInArrow(add_counters, COUNTERS)


def newly_reached(state: DataFrame, least: int, times: np.ndarray, t: int) -> int:
    """Enter scan t into ``times`` for counters that reached the least count; returns how many did. A bit a counter is collected."""
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for places, counts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                table = np.zeros(1 << CHUNK_BITS, bool)
                table[np.frombuffer(places, np.uint16)[np.frombuffer(counts, np.uint16) >= least]] = True
                bits.append(zlib.compress(np.packbits(table).tobytes()))
            yield batch_of(arrow_schema("piece long, bits binary"), [batch.column(0), pa.array(bits, pa.binary())])

    new, flat = 0, times.reshape(-1)
    for row in state.mapInArrow(full, "piece long, bits binary").collect():
        chunk = flat[row.piece << CHUNK_BITS:(row.piece + 1) << CHUNK_BITS]
        fresh = np.unpackbits(np.frombuffer(zlib.decompress(row.bits), np.uint8)).astype(bool) & (chunk == 0)
        chunk[fresh] = t + 1
        new += int(fresh.sum())
    return new


def activations(spark, path: str, least: int, shards: int, bits: int) -> Reached:
    """The scans: cyclic over the shards under ``path``, until every active phrase has completed a cycle."""
    if not least <= 65_535:
        raise ValueError("counters hold counts to 65,535")
    reached = Reached(np.zeros((LONGEST, 1 << bits), np.uint8))
    state, t = None, 0
    while t < shards or t < int(reached.times[:-1].max()) + shards:
        shard = spark.read.schema("text string, lang string").parquet(f"{path}/shard={t % shards}")
        rows = scan(shard, reached, t, shards)
        state = materialise(summed(rows if state is None else rows.unionAll(state)), "counters")
        reached.times.setflags(write=True)
        newly_reached(state, least, reached.times, t)
        t += 1
    return reached


PACKED = "n int, piece long, lang string, firsts binary, lasts binary, counts binary, words binary"
FOUND = "n int, hash long, first long, last long, lang string, word string, f long"


class Tally:
    """Counts of a task's phrases of one length, in order of their hashes; words also have their language and text.

    ``firsts`` are hashes of the phrases without their last word, ``lasts`` of the last word; a word has only its own.
    """

    def __init__(self, n: int):
        self.n, self.counts = n, np.zeros(0, np.int64)
        self.hashes, self.firsts, self.lasts = (np.zeros(0, np.uint64) for _ in range(3))
        self.langs, self.texts = np.zeros(0, object), np.zeros(0, object)

    def add(self, phrases: Phrases, at: np.ndarray) -> None:
        hashes, first, counts = np.unique(phrases.hashes[self.n][at], return_index=True, return_counts=True)
        place = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == hashes[inside]
        self.counts[place[known]] += counts[known]
        new = at[first[~known]]
        if self.n == 1:
            more = {"firsts": hashes[~known], "langs": np.array(phrases.names, object)[phrases.lang[new]], "texts": phrases.texts(new, 1)}
        else:
            more = {"firsts": phrases.hashes[self.n - 1][new], "lasts": phrases.hashes[1][new + self.n - 1]}
        more |= {"hashes": hashes[~known], "counts": counts[~known]}
        joined = {name: np.concatenate([getattr(self, name), values]) for name, values in more.items()}
        order = np.argsort(joined["hashes"])
        for name, values in joined.items():
            setattr(self, name, values[order])

    def rows(self) -> pa.RecordBatch:
        """One row for each range of hashes that has phrases, and for words for each language in it."""
        pieces = (self.hashes >> np.uint64(64 - PIECE_BITS)).astype(np.int64)
        order, langs = np.arange(len(pieces)), np.zeros(len(pieces), np.int64)
        if self.n == 1 and len(pieces):
            places: dict[str, int] = {}
            langs = np.array([places.setdefault(lang, len(places)) for lang in self.langs], np.int64)
            order = np.lexsort((langs, pieces))
        spans = [(order[a], order[a:b]) for a, b in runs((langs + (pieces << 32))[order])]
        return batch_of(arrow_schema(PACKED), [
            [self.n] * len(spans), [int(pieces[i]) for i, _ in spans], [self.langs[i] if self.n == 1 else None for i, _ in spans],
            packed([self.firsts[x] for _, x in spans]), packed([self.lasts[x] if self.n > 1 else self.lasts for _, x in spans]),
            packed([self.counts[x] for _, x in spans]), pa.array([b" ".join(self.texts[x]) if self.n == 1 else b"" for _, x in spans], pa.binary())])


def total_rows(words: dict[str, int]) -> pa.RecordBatch:
    """Words of each language, as rows of n = 0."""
    none = [b""] * len(words)
    return batch_of(arrow_schema(PACKED), [[0] * len(words), [name_hash(lang) >> (64 - PIECE_BITS) for lang in words], list(words), none, none,
                                           packed([np.array([size], np.int64) for size in words.values()]), none])


class Sums:
    """Added-up rows of one length and range of hashes: two phrases are one where first part and last word are."""

    def __init__(self, n: int):
        self.n, self.parts, self.size = n, [], 0

    def add(self, lang: str | None, firsts: bytes, lasts: bytes, counts: bytes, words: bytes) -> None:
        new = [np.frombuffer(firsts, np.uint64), np.frombuffer(lasts, np.uint64), np.frombuffer(counts, np.int64)]
        if self.n < 2:
            texts = words.split(b" ")
            new[:2] = new[0] if self.n else np.array([name_hash(lang)], np.uint64), np.zeros(len(texts), np.uint64)
            new += [np.array([lang] * len(texts), object), np.array(texts, object)]
        self.parts.append(new)
        self.size += len(new[2])
        if self.size > 2 * max(HELD, len(self.parts[0][2])):
            self.parts = [self.merged()]
            self.size = len(self.parts[0][2])

    def merged(self) -> list[np.ndarray]:
        columns = [np.concatenate(x) for x in zip(*self.parts)]
        order = np.lexsort(columns[:2])
        firsts, lasts = (x[order] for x in columns[:2])
        cuts = np.concatenate([[0], np.flatnonzero((np.diff(firsts) != 0) | (np.diff(lasts) != 0)) + 1])
        some = order[cuts]
        return [firsts[cuts], lasts[cuts], np.add.reduceat(columns[2][order], cuts), *(x[some] for x in columns[3:])]

    def rows(self, least: int) -> pa.RecordBatch:
        merged = self.merged()
        kept = (merged[2] >= least) | (self.n == 0)
        firsts, lasts, counts, *named = (x[kept] for x in merged)
        langs, words = named or [[None] * len(counts)] * 2
        return batch_of(arrow_schema(FOUND), [
            np.full(len(counts), self.n, np.int32), signed(chain(firsts, lasts) if self.n > 1 else firsts), signed(firsts), signed(lasts),
            pa.array(langs, pa.string()), pa.array(words, pa.binary()).cast(pa.string()), counts])


def exact_counts(texts: DataFrame, reached: Reached, least: int) -> DataFrame:
    """Rows (n, hash, first, last, lang, word, f) of phrases with f >= ``least``, of those that the counters do not rule out.

    n = 0 holds a language's words, n = 1 words with their text; longer phrases are the hashes of their first part and of their
    last word.  Tasks send 16 bytes and a count for each phrase they hold, packed by range of hashes, so what is sent is at most that
    for each occurrence.  A task adds up by 64-bit hash (of the phrases it holds at a time two share one with a chance below
    1e-7), the rest by both hashes, 128 bits.
    """
    sent = reached.send(texts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Reached.receive(sent)
        words: dict[str, int] = {}
        held = [Tally(n) for n in range(1, LONGEST + 1)]
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                phrases = Phrases(piece)
                for lang, size in zip(phrases.names, phrases.words.counts.tolist()):
                    words[lang] = words.get(lang, 0) + size
                for tally in held:
                    kept = phrases.whole[tally.n] & (known.of(phrases, tally.n) > 0)
                    if tally.n > 1:
                        kept &= known.active_from(phrases, tally.n) > 0
                    tally.add(phrases, np.flatnonzero(kept))
                if sum(len(t.hashes) for t in held) > HELD:
                    yield from (t.rows() for t in held)
                    held = [Tally(t.n) for t in held]
        yield from (t.rows() for t in held)
        yield total_rows(words)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, Sums(0)
        for batch in batches:
            for n, piece, *row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if (n, piece) != at:
                    if at is not None:
                        yield sums.rows(least)
                    at, sums = (n, piece), Sums(n)
                sums.add(*row)
        if at is not None:
            yield sums.rows(least)

    return texts.mapInArrow(count, PACKED).repartition("n", "piece").sortWithinPartitions("n", "piece").mapInArrow(add, FOUND)


def spelled(found: DataFrame) -> DataFrame:
    """Rows (lang, n, phrase, f) of counted hashes: a phrase is its first part, which is counted too, and its last word."""
    words = found.where("n = 1").select(F.col("hash").alias("last"), "word")
    level = found.where("n = 1").select("hash", "lang", "n", F.col("word").alias("phrase"), "f")
    out = level.unionAll(found.where("n = 0").select("hash", "lang", "n", F.lit("").alias("phrase"), "f"))
    for n in range(2, LONGEST + 1):
        first = level.select(F.col("hash").alias("first"), "lang", F.col("phrase").alias("start"))
        level = materialise(found.where(F.col("n") == n).select("hash", "first", "last", "n", "f").join(first, "first").join(words, "last")
                            .select("hash", "lang", "n", F.concat_ws(" ", "start", "word").alias("phrase"), "f"), "phrases")
        out = out.unionAll(level)
    return out.select("lang", "n", "phrase", "f")


def phrase_counts(docs: DataFrame, least: int, text: str = "text", lang: str = "lang", shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Exact counts (lang, n, phrase, f) of all words and phrases of up to 4 words with f >= ``least``; n = 0: all words of a language."""
    spark = docs.sparkSession
    path = scratch_path(spark, "shards")
    (docs.select(F.coalesce(quoted(text), F.lit("")).alias("text"), F.coalesce(quoted(lang), F.lit("und")).alias("lang"))
     .withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)))
     .unionAll(spark.range(shards).select(F.lit("").alias("text"), F.lit(None).cast("string").alias("lang"), F.col("id").alias("shard")))
     .write.partitionBy("shard").parquet(path))
    reached = activations(spark, path, least, shards, bits)
    texts = spark.read.schema("text string, lang string").parquet(*[f"{path}/shard={s}" for s in range(shards)]).where("lang IS NOT NULL")
    return spelled(materialise(exact_counts(texts, reached, least), "found"))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, share: int = 80, text: str = "text", lang: str = "lang",
                 shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """The best ``top`` phrases of 2 to 4 words of each language: lang, rank, phrase, a, l, r, n, score.

    Words are runs of other than blanks and tabs within pieces, which end at ``.,;:!?`` and line ends; A-Z is lower-cased.
    A phrase's count is ``a``.  Cut after its first words into parts with counts l and r it scores floor(2000000 a / (l + r)); the
    lowest score counts, of equal ones the first.  A phrase goes if a longer frequent one that
    contains it has at least ``share`` percent of its count.
    """
    counts = phrase_counts(docs, least, text, lang, shards, bits)
    known = counts.where("n > 0").select("lang", "phrase", "f")
    found = counts.where("n > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))

    def joined(start, size):
        return F.array_join(F.slice("words", start, size), " ")

    k, words = F.col("k"), F.size("words")
    cuts = (found.withColumn("k", F.explode(F.sequence(F.lit(1), words - 1)))
            .select("lang", "phrase", "a", "k", joined(F.lit(1), k).alias("first"), joined(k + 1, words - k).alias("rest")))
    scored = (cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
              .join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
              .withColumn("score", F.expr("(cast(a AS decimal(20, 0)) * cast(2000000 AS decimal(7, 0))) div (cast(l AS decimal(20, 0)) + r)"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    inner = (found.where(words > 2)
             .withColumn("size", F.explode(F.sequence(F.lit(2), words - 1)))
             .withColumn("start", F.explode(F.sequence(F.lit(1), words - F.col("size") + 1)))
             .select("lang", joined(F.col("start"), F.col("size")).alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(
        F.expr("longer IS NULL OR cast(longer AS decimal(20, 0)) * 100 < cast(a AS decimal(20, 0)) * " + str(int(share))))
    # A language's best are among the best of its parts, so no task orders all phrases of a language.
    order = "ORDER BY cut.score DESC, a DESC, phrase)"
    parts = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    best = parts.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang, part {order}")).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang {order}")).where(F.col("rank") <= top)
    totals = counts.where("n = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))

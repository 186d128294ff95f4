"""Best-fit packing of documents into sequences of a fixed number of tokens.

Tokens are counted and cut in tasks; from there on only lengths matter.  How many
pieces there are of each length is a table of at most ``capacity`` rows whatever the
corpus, so the packing itself is planned on counts:

1. Martello-Toth reduction: for a piece of some length, a small set of pieces filling a
   sequence with it is fixed for good where it dominates every other choice (an exact
   fill, the largest partner when no two partners fit, or a triple none can better);
   all pieces of that length are fixed at once, and the instance shrinks.
2. Best-fit decreasing packs the remainder, again a whole length at a time.

The plan lists runs of equal moves (length, first rank, how many, first sequence,
offset); its size depends on the capacity only, which bounds what is sent to the tasks.
Pieces get ranks within their length by counting per length and hash bucket, so a length
that a third of the pieces share is ranked by many tasks.

A document is its token ids and a closing end id.  Null and empty texts are the end id
alone.  A document longer than the capacity is cut into full pieces from its end, so the
first piece may be shorter.  Rows with null id are packed under a null id; repeated rows
are packed once each.  Ties of length are broken by id, piece, start and checksum.  An empty
table gives no row.  Other columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_schema, batch_of, materialise, slices, strings

CAPACITY, END = 2048, 0

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


class Encoder:
    """Ids of texts under a byte-level BPE, given as a tokenizer file and as the same vocabulary's ranks.

    The ranks give the tokenizer's ids about four times faster; texts that hold one of
    its special tokens go to the tokenizer itself.
    """

    def __init__(self, tokenizer: str, ranks: str):
        import base64

        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            held = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=held, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder_of(tokenizer: str, ranks: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    key = (tokenizer, ranks)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def _pieces(tokenizer: str, ranks: str, capacity: int, end: int):
    schema = arrow_schema(PIECES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer, ranks)
        closing = int(end).to_bytes(4, "little")
        for batch in batches:
            for part in slices(batch, "text"):
                ids, number, start, length, check = [], [], [], [], []
                for doc, text in zip(part.column("doc_id").to_pylist(), strings(part.column("text")).to_pylist()):
                    made = encoder.encode(text).tobytes() + closing
                    total = len(made) // 4
                    edges = [0, *range(total % capacity or capacity, total + 1, capacity)]
                    for k, (a, b) in enumerate(zip(edges, edges[1:])):
                        ids.append(doc)
                        number.append(k)
                        start.append(a)
                        length.append(b - a)
                        check.append(zlib.crc32(made[4 * a:4 * b]))
                yield batch_of(schema, [ids, number, start, length, check])
    return cut


class Sizes:
    """How many pieces of each length are left, lengths kept sorted."""

    def __init__(self, counts: dict[int, int]):
        self.count = {k: v for k, v in counts.items() if v > 0}
        self.sorted = sorted(self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            self.sorted.remove(length)

    def smallest(self, n: int, without: int) -> list[int]:
        """The ``n`` smallest lengths left, with copies, one piece of ``without`` put aside."""
        out: list[int] = []
        for length in self.sorted:
            out += [length] * min(n - len(out), self.count[length] - (length == without))
            if len(out) == n:
                break
        return out

    def largest(self, limit: int, without: tuple[int, ...]) -> int | None:
        """The largest length up to ``limit`` with a piece left beside those in ``without``."""
        at = bisect.bisect_right(self.sorted, limit) - 1
        while at >= 0:
            length = self.sorted[at]
            if self.count[length] > without.count(length):
                return length
            at -= 1
        return None


def dominant_set(sizes: Sizes, length: int, capacity: int) -> tuple[int, ...] | None:
    """A set with a piece of ``length`` that is at least as good as any other, or None.

    A set dominates another if the other's pieces can be dealt to its pieces, each getting
    no more than its own length.
    """
    room = capacity - length
    best = sizes.largest(room, (length,))
    if best is None:
        return (length,)
    if best == room:
        return (length, best)
    small = sizes.smallest(3, length)
    if len(small) < 2 or small[0] + small[1] > room:
        return (length, best)
    if len(small) == 3 and sum(small) <= room:
        return None
    # At most two partners fit.  The best pair, by sum:
    pair = 0
    for first in reversed(sizes.sorted):
        if first > room or sizes.count[first] <= (first == length):
            continue
        if 2 * first <= pair:
            break
        second = sizes.largest(min(room - first, first), (length, first))
        if second is not None:
            pair = max(pair, first + second)
    if best >= pair:
        return (length, best)
    second = sizes.largest(room - best, (length, best))
    half = sizes.largest(room // 2, (length,))
    if second is not None and half is not None and half <= second:
        return (length, best, second)
    return None


Move = tuple[int, int, int, int, int]  # length, first rank, pieces, first sequence, offset


class Plan:
    """Runs of equal moves, ranks handed out in order within each length."""

    def __init__(self) -> None:
        self.moves: list[Move] = []
        self.ranks: dict[int, int] = defaultdict(int)
        self.sequences = 0

    def put(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.moves.append((length, self.ranks[length], n, sequence, offset))
        self.ranks[length] += n


def plan_packing(counts: dict[int, int], capacity: int) -> Plan:
    """Reduction by dominance, then best-fit decreasing on what is left."""
    plan, sizes = Plan(), Sizes(counts)
    for length in sorted(counts, reverse=True):
        while sizes.count.get(length):
            chosen = dominant_set(sizes, length, capacity)
            if chosen is None:
                break
            times = min(sizes.count[k] // chosen.count(k) for k in set(chosen))
            offset = 0
            for part in chosen:
                plan.put(part, times, plan.sequences, offset)
                sizes.take(part, times)
                offset += part
            plan.sequences += times
    _best_fit(plan, sizes, capacity)
    return plan


def _best_fit(plan: Plan, sizes: Sizes, capacity: int) -> None:
    rooms: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs of sequences (first, how many)
    free: list[int] = []
    for length in sorted(sizes.count, reverse=True):
        left = sizes.count[length]
        while left:
            at = bisect.bisect_left(free, length)
            if at < len(free):
                room = free[at]
                first, n = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                    free.pop(at)
            else:
                room, n = capacity, -(-left // (capacity // length))
                first, plan.sequences = plan.sequences, plan.sequences + n
            each = room // length
            full = min(n, left // each)
            if full:
                for k in range(each):
                    plan.put(length, full, first, capacity - room + k * length)
                left -= full * each
                _open(rooms, free, room - each * length, first, full)
            if full < n:
                rest = min(left, each)  # fewer pieces are left than one more sequence would take
                for k in range(rest):
                    plan.put(length, 1, first + full, capacity - room + k * length)
                left -= rest
                used = 1 if rest else 0
                if used:
                    _open(rooms, free, room - rest * length, first + full, 1)
                if full + used < n:
                    _open(rooms, free, room, first + full + used, n - full - used)


def _open(rooms: dict, free: list[int], room: int, first: int, n: int) -> None:
    if room:
        if room not in rooms:
            rooms[room] = []
            bisect.insort(free, room)
        rooms[room].append((first, n))


def _placer(plan: Plan):
    """A function that looks up sequence and offset of pieces by length and rank."""
    schema = arrow_schema(PLACED)
    moves = np.array(sorted(plan.moves), np.int64).reshape(-1, 5)
    keys = (moves[:, 0] << 48) | moves[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (batch.column("length").to_numpy() << 48) | rank, side="right") - 1
            sequence = moves[at, 3] + rank - moves[at, 1]
            yield batch_of(schema, [*(batch.column(f.name) for f in list(schema)[:5]), sequence, moves[at, 4]])
    return place


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to rows of doc_id, piece, start, length, ids_crc32."""
    spark = pieces.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(buckets)))
    counts = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    lengths = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_packing(lengths, capacity)
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = pieces.withColumn("row", F.row_number().over(order)).join(bases, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("row") - 1).alias("rank"))
    return ranked.mapInArrow(_placer(plan), PLACED)


def token_pieces(docs: DataFrame, tokenizer: str, ranks: str, capacity: int = CAPACITY, end: int = END, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` tokens with their checksums, written once to the shared folder."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return materialise(rows.mapInArrow(_pieces(tokenizer, ranks, capacity, end), PIECES), "pieces")


def pack_documents(docs: DataFrame, tokenizer: str, ranks: str, capacity: int = CAPACITY, end: int = END, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack_pieces(token_pieces(docs, tokenizer, ranks, capacity, end, doc_id, text), capacity)

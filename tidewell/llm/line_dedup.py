"""Near-duplicate lines by an exact set-similarity join, and their removal.

A line is the set of its words.  Equal sets are one class, placed at its first line
(by document id, then line number).  A line goes if it is not the first of its class, or if an
earlier class has Jaccard similarity of ``percent`` or more; so the first line of every
kind stays, whatever the number of copies.

The join orders the words of a set rarest first over the corpus and lists each class
under its first few words only (prefix filter).  Within a word's list two classes are
compared if their sizes allow the similarity (length filter), if the words after the
shared one can still give the overlap (positional filter) and if the parity bits of
their words differ in few enough places, each of which needs a word of its own in the
symmetric difference.  All filters are exact, so no similar pair is lost.  A class needs
only one similar earlier class: it is verified with the earliest candidate first, and
with all others only if that fails.  Lists much longer than others are cut into
blocks whose pairs go to different tasks.

Texts are read once: the lines are written with the word sets of those that differ within a piece of a task, words
as 48-bit hashes (two words of a pair of 100-word lines share one with a chance below 1e-10); prefixes, list sizes,
entries and sets for verification all come from that table.  Sets and entries travel packed by column, many to a row,
and the session's batches to Python are bounded (:func:`tidewell.session.bounded_batches`).

Lines without words stay.  Null texts have no lines and stay null.  Rows with null id are
not compared and stay as they are.  Repeated rows count as one place, so each keeps what the
first occurrence keeps; different texts under one id share their places, and lines
at the same place are not later than each other.  Other columns stay as they are.  An empty
table gives an empty result.  Very long lines are sets like others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_schema, batch_of, bytes_of, materialise, mix, packed, quoted, runs, signed, slices, strings, unused, words_in
from tidewell.llm.near_dup import FILTER_BITS
from tidewell.llm.rarity import COUNTS_DDL, counted, rarity_table
from tidewell.session import bounded_batches

BUCKETS = 1 << 20
#: Entries of a list from which it is cut into blocks of that size.
BLOCK = 100_000
#: Bytes of text and of packed words that a task works on at a time; entries of a part, and packed together.
TEXT_BYTES, SET_BYTES, PART_ENTRIES, SENT_ENTRIES = 1 << 20, 1 << 20, 200_000, 1_000_000
#: Bytes of packed entries sent at once.
SENT_BYTES = 1 << 22
#: Bytes kept of a word's hash; parity bits are 64 for sets up to ``WIDE`` words and 128 beyond.
WORD_BYTES, WIDE = 6, 96

#: ``copies`` counts the lines of a class within a piece at the first of them, and is 0 at the others; ``sets`` holds the
#: sets of these first lines, packed, in the first rows of the piece, and is null in the others.
LINES = "k1 long, k2 long, n int, doc_id long, line int, copies int, sets binary"
#: Bits of a word that name its list.  With rank and line they are one sort key: a slice of sets has fewer than 2^18 lines.
TOKEN_BITS = 38
#: Ids are taken modulo this prime for their slots, as their low bits may be equal.
ID_PRIME = 8_388_593
ENTRIES = "part long, entries int, data binary"
#: ``key`` is the low half of the later class's k1.
CANDIDATES = "doc_id long, line int, other_id long, other_line int, found int, key long"
#: Similar pairs, with the class of the later line.
PAIRS = "doc_id long, line int, other_id long, other_line int, k1 long, k2 long"


def split_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the texts, bounds of all their lines, the text of each line and its number there.

    An empty text has no line; a text that ends in a line feed has an empty last line.
    """
    data, bounds = bytes_of(texts)
    feeds = np.flatnonzero(data == 10)
    filled = np.flatnonzero(np.diff(bounds) > 0)
    starts = np.concatenate([bounds[filled], feeds + 1])
    text = np.concatenate([filled, np.searchsorted(bounds[1:], feeds, side="right")])
    order = np.lexsort((starts, text))
    starts, text = starts[order], text[order]
    number = np.arange(len(text)) - np.searchsorted(text, text)
    return data, np.append(starts, len(data)), text, number


def line_sets(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word hashes of each line, ascending, and their offsets."""
    words = words_in(data, bounds)
    line = np.repeat(np.arange(len(bounds) - 1), words.counts)
    order = np.argsort((line.astype(np.uint64) << np.uint64(40)) | (words.hashes >> np.uint64(24)), kind="stable")  # by line, then hash
    line, values = line[order], words.hashes[order]
    fresh = np.ones(len(line), bool)
    fresh[1:] = (line[1:] != line[:-1]) | (values[1:] != values[:-1])
    line, values = line[fresh], values[fresh]
    return values, np.searchsorted(line, np.arange(len(bounds)))


def sums_of(values: np.ndarray, offsets: np.ndarray, reduce=np.add) -> np.ndarray:
    """Reduction of each run of ``values``; zero for empty runs."""
    out = np.zeros(len(offsets) - 1, values.dtype)
    filled = np.diff(offsets) > 0
    if filled.any():
        out[filled] = reduce.reduceat(values, offsets[:-1][filled])
    return out


def set_keys(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit key of each set, as two arrays."""
    n = np.diff(offsets).astype(np.uint64)
    return mix(sums_of(values, offsets) + n), sums_of(mix(values ^ np.uint64(0xD6E8FEB86659FD93)), offsets)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(LINES)
    for batch in batches:
        for piece in slices(batch, "text", TEXT_BYTES):
            data, bounds, text, number = split_lines(strings(piece.column("text")))
            values, offsets = line_sets(data, bounds)
            k1, k2 = set_keys(values, offsets)
            n = np.diff(offsets)
            ids = piece.column("doc_id").to_numpy()[text]
            order = np.lexsort((number, ids, k2, k1))
            fresh = np.ones(len(order), bool)
            fresh[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
            copies = np.zeros(len(order), np.int32)
            copies[order[fresh]] = np.diff(np.append(np.flatnonzero(fresh), len(order)))
            first = copies > 0
            held = np.flatnonzero(n > 0)
            columns = [signed(k1[held]), signed(k2[held]), n[held].astype(np.int32), ids[held], number[held].astype(np.int32)]
            sets = pack_sets(*(x[first[held]] for x in columns), values[np.repeat(first, n)])
            yield batch_of(schema, [*columns, copies[held], pa.array(sets + [None] * (len(held) - len(sets)), pa.binary())])


def pack_sets(k1: np.ndarray, k2: np.ndarray, n: np.ndarray, ids: np.ndarray, number: np.ndarray, values: np.ndarray) -> list[bytes]:
    """Sets with their words, about ``SET_BYTES`` of words in each of the results, which are no more than the sets."""
    ends = np.cumsum(n, dtype=np.int64)
    out = []
    for a, b in runs(ends * WORD_BYTES // SET_BYTES):
        wide = (values[ends[a] - n[a]:ends[b - 1]] >> np.uint64(64 - 8 * WORD_BYTES)).view(np.uint8).reshape(-1, 8)
        words = np.empty((len(wide), WORD_BYTES), np.uint8)
        for i in range(WORD_BYTES):
            words[:, i] = wide[:, i]
        out.append(b"".join([np.int64(b - a).tobytes(), *(x[a:b].tobytes() for x in (k1, k2, ids, number, n)), words.tobytes()]))
    return out


def unpack_sets(data: bytes) -> pa.RecordBatch:
    """Packed sets as rows k1, k2, doc_id, line, words."""
    count = int(np.frombuffer(data, np.int64, 1)[0])
    k1, k2, ids = np.frombuffer(data, np.int64, 3 * count, 8).reshape(3, count)
    number, n = np.frombuffer(data, np.int32, 2 * count, 8 + 24 * count).reshape(2, count)
    offsets = np.concatenate([[0], np.cumsum(n, dtype=np.int64) * WORD_BYTES]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), count, [None, pa.py_buffer(offsets), pa.py_buffer(data).slice(8 + 32 * count)])
    return pa.record_batch({"k1": pa.array(k1), "k2": pa.array(k2), "doc_id": pa.array(ids), "line": pa.array(number), "words": words})


def on_sets(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A ``mapInArrow`` function over the column of packed sets: ``function`` gets them as rows."""
    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return function(unpack_sets(data) for batch in batches for data in batch.column(0).to_pylist())
    return unpacked


def unpacked_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Packed word sets as values and offsets."""
    if not len(column):
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    data, bounds = bytes_of(column)
    padded = np.concatenate([data, np.zeros(8 - WORD_BYTES, np.uint8)])
    wide = np.ndarray((len(data) // WORD_BYTES,), "<u8", padded, 0, (WORD_BYTES,))
    return wide & np.uint64((1 << 8 * WORD_BYTES) - 1), bounds // WORD_BYTES


def prefix_sizes(n: np.ndarray, percent: int) -> np.ndarray:
    """Words of a set that are listed."""
    return n - -(-n * percent // 100) + 1


def least_size(percent: int) -> int:
    """Smaller sets are similar to equal sets only; the first of equal lines is enough."""
    return min(100 // (100 - percent), 4) if percent < 100 else 4


class Prefixes:
    """The listed words of some sets; with ``frequent``, only of those that list a word of that rank."""

    def __init__(self, piece: pa.RecordBatch, ranks: np.ndarray, percent: int, frequent: int | None = None):
        values, offsets = unpacked_words(piece.column("words"))
        n = np.diff(offsets)
        rank = ranks[(values & np.uint64(BUCKETS - 1)).astype(np.int64)].astype(np.uint64)
        kept = n >= least_size(percent)
        if frequent is not None:
            kept &= sums_of((rank < frequent).astype(np.int64), offsets) < prefix_sizes(n, percent)
        if not kept.all():
            inside = np.repeat(kept, n)
            values, rank, n = values[inside], rank[inside], n[kept]
            offsets = np.concatenate([[0], np.cumsum(n)])
        kept = np.flatnonzero(kept)
        self.k1, self.ids, self.number = (piece.column(c).to_numpy()[kept] for c in ("k1", "doc_id", "line"))
        self.n = n
        one = np.uint64(1)
        bit, half = one << ((values >> np.uint64(24)) & np.uint64(63)), (values >> np.uint64(30)) & one
        self.bits_a, self.bits_b = (sums_of(np.where(half == h, bit, np.uint64(0)), offsets, np.bitwise_xor) for h in (0, 1))
        row = np.repeat(np.arange(len(n)), n)
        keys = row.astype(np.uint64) << np.uint64(8 + TOKEN_BITS)
        keys |= rank << np.uint64(TOKEN_BITS)
        keys |= values >> np.uint64(8 * WORD_BYTES - TOKEN_BITS)
        keys.sort()
        place = np.arange(len(keys)) - offsets[row]
        keep = place < prefix_sizes(n, percent)[row]
        keys, self.place, self.row = keys[keep], place[keep], row[keep]
        self.tokens = keys & np.uint64((1 << TOKEN_BITS) - 1)
        self.ranks = (keys >> np.uint64(TOKEN_BITS)) & np.uint64(255)


def _frequent_tokens(ranks, percent: int):
    """Listed words frequent enough for a list to be cut: the others' lists cannot be that long."""
    least = int(8 * np.log2(1 + BLOCK))

    def tokens(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for piece in slices(batch, "words", SET_BYTES):
            p = Prefixes(piece, ranks.value, percent, least)
            yield p.tokens[p.ranks >= least]
    return tokens


#: Columns of packed entries; those with small numbers are stored plane by plane, which compresses.
COLUMNS = [("name", np.uint64, False), ("key", np.uint32, False), ("doc", np.int64, True), ("line", np.int32, True),
           ("n", np.int32, True), ("place", np.int32, True), ("side", np.uint8, False), ("fold", np.uint64, False)]


def pack_entries(columns: dict[str, np.ndarray], at: np.ndarray) -> bytes:
    parts = []
    for name, kind, planes in COLUMNS:
        x = columns[name][at].astype(kind, copy=False)
        parts.append(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes() if planes else x.tobytes())
    wide = at[columns["n"][at] > WIDE]
    return b"".join([*parts, columns["half"][wide].tobytes()])


def unpack_entries(count: int, data: bytes) -> dict[str, np.ndarray]:
    out, start = {}, 0
    for name, kind, planes in COLUMNS:
        size = np.dtype(kind).itemsize
        raw = np.frombuffer(data, np.uint8, count * size, start)
        out[name] = (np.ascontiguousarray(raw.reshape(size, count).T).reshape(-1) if planes else raw).view(kind)
        start += count * size
    out["half"] = np.zeros(count, np.uint64)
    out["half"][out["n"] > WIDE] = np.frombuffer(data, np.uint64, -1, start)
    return out


def _entries(ranks, blocks, percent: int, parts: int, only: np.ndarray | None):
    """Entries of the lists; long lists are dealt to pairs of blocks; ``only`` restricts to some lists."""
    def rows(held: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        columns = {name: np.concatenate([h.pop(name) for h in held]) for name in list(held[0])}
        part = (columns["name"] % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part[order])) + 1, [len(order)]]) if len(order) else np.zeros(1, np.int64)
        parts_of, counts = part[order[cuts[:-1]]], np.diff(cuts).astype(np.int32)
        first, sent, size = 0, [], 0
        for i, (x, y) in enumerate(zip(cuts.tolist(), cuts[1:].tolist()), 1):
            sent.append(pack_entries(columns, order[x:y]))
            size += len(sent[-1])
            if size > SENT_BYTES or i == len(counts):
                yield batch_of(arrow_schema(ENTRIES), [parts_of[first:i], counts[first:i], pa.array(sent, pa.binary())])
                first, sent, size = i, [], 0

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in slices(batch, "words", SET_BYTES):
                p = Prefixes(piece, ranks.value, percent)
                tokens, place, row = p.tokens, p.place, p.row
                if only is not None:
                    inside = in_bits(only, mix(tokens))
                    tokens, place, row = tokens[inside], place[inside], row[inside]
                count = blocks.value[(tokens & np.uint64(BUCKETS - 1)).astype(np.int64)].astype(np.int64)
                own = (p.k1.view(np.uint64)[row] % count.astype(np.uint64)).astype(np.int64)
                at = np.repeat(np.arange(len(tokens)), count)
                other = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
                own = own[at]
                side = np.where(own == other, 0, np.where(own < other, 1, 2)).astype(np.uint8)
                take = row[at]
                own, other = np.minimum(own, other), np.maximum(own, other)
                # Scrambled, so that parts are dealt evenly.
                name = mix(tokens[at])
                cut = count[at] > 1
                name[cut] = mix(name[cut] + mix((own[cut] * 65536 + other[cut]).astype(np.uint64)))
                held.append({"name": name, "key": (p.k1[take] & 0xFFFFFFFF).astype(np.uint32), "doc": p.ids[take], "line": p.number[take],
                             "n": p.n[take].astype(np.int32), "place": place[at].astype(np.int32), "side": side,
                             "fold": (p.bits_a ^ p.bits_b)[take], "half": p.bits_a[take]})
                size += len(name)
                if size > SENT_ENTRIES:
                    yield from rows(held)
                    held, size = [], 0
        if size:
            yield from rows(held)
    return index


def passing(e: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of entries of one list pass all filters; ``i`` is not the larger set."""
    n, place = e["n"], e["place"]
    both = n[i] + n[j]
    overlap = -(-percent * both // (100 + percent))
    index = n[i] - -(-2 * percent * n[i] // (100 + percent)) + 1
    ahead = np.minimum(n[i] - place[i], n[j] - place[j])
    good = (ahead >= overlap) & (place[i] < index)
    i, j = i[good], j[good]
    # A word of one set only flips one of the parity bits; folded, 128 of them are 64.
    a = e["half"][i] ^ e["half"][j]
    both_wide = n[i] > WIDE
    fold = e["fold"][i] ^ e["fold"][j]
    differ = np.where(both_wide, np.bitwise_count(a).astype(np.int64) + np.bitwise_count(fold ^ a), np.bitwise_count(fold))
    good[good] = differ <= (both - 2 * overlap)[good]
    return good


def groups_of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """All entries of one part, from rows sorted by part."""
    held, part = [], None
    for batch in batches:
        for key, count, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if key != part and held:
                yield {name: np.concatenate([h[name] for h in held]) for name in held[0]}
                held = []
            part = key
            held.append(unpack_entries(count, data))
    if held:
        yield {name: np.concatenate([h[name] for h in held]) for name in held[0]}


def by_list_and_class(e: dict[str, np.ndarray]) -> np.ndarray:
    """Entries by list, size, class and place, without lists of one entry, which have no pairs.

    One key of list, size and a part of the class's hash sorts them; rows that agree in it, copies of a class
    but for chance, are sorted by all columns.
    """
    order = np.argsort(e["name"], kind="stable")
    order = order[several(e["name"][order])]
    if not len(order):
        return order
    name, n = e["name"][order], e["n"][order].astype(np.uint64)
    list_bits, size_bits = int(len(order)).bit_length(), int(n.max()).bit_length()
    keys = np.cumsum(np.concatenate([[0], name[1:] != name[:-1]])).astype(np.uint64) << np.uint64(64 - list_bits)
    keys |= n << np.uint64(64 - list_bits - size_bits)
    keys |= mix(e["fold"][order] ^ e["key"][order].astype(np.uint64)) >> np.uint64(list_bits + size_bits)
    again = np.argsort(keys, kind="stable")
    order, keys = order[again], keys[again]
    alike = np.flatnonzero(several(keys))
    rows = order[alike]
    order[alike] = rows[np.lexsort((e["line"][rows], e["doc"][rows], e["fold"][rows], e["key"][rows], keys[alike]))]
    return order


def place_order(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Order of places, by one number each if 64 bits hold it."""
    if len(doc) and (int(doc.max()) - int(doc.min()) + 1) * (int(line.max()) + 1) < 1 << 63:
        return np.argsort((doc - doc.min()) * (int(line.max()) + 1) + line)
    return np.lexsort((line, doc))


def _compare(percent: int, every: np.ndarray | None):
    """Candidates from entries: for each class the earliest per list, or all for the classes in ``every``."""
    schema = arrow_schema(CANDIDATES)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for e in groups_of_parts(batches):
            order = by_list_and_class(e)
            e = {k: x[order] for k, x in e.items()}
            size = (e["n"].astype(np.uint64) << np.uint64(32)) | e["key"]
            group = np.cumsum(np.concatenate([[0], e["name"][1:] != e["name"][:-1]]))
            # Copies of a class from several pieces: the earliest stays.
            fresh = np.ones(len(group), bool)
            fresh[1:] = (group[1:] != group[:-1]) | (size[1:] != size[:-1]) | (e["fold"][1:] != e["fold"][:-1])
            # A list of one class has no pairs.
            e, group = {k: x[fresh] for k, x in e.items()}, group[fresh]
            inner = several(group)
            e, group = {k: x[inner] for k, x in e.items()}, group[inner]
            doc, line, n, side = e["doc"], e["line"], e["n"].astype(np.int64), e["side"]
            e["n"] = n
            rank = np.empty(len(doc), np.int64)
            by_place = place_order(doc, line)
            changes = np.ones(len(doc), bool)
            changes[1:] = (doc[by_place][1:] != doc[by_place][:-1]) | (line[by_place][1:] != line[by_place][:-1])
            rank[by_place] = np.cumsum(changes)
            best, found = np.full(len(doc), np.iinfo(np.int64).max), np.zeros(len(doc), np.int32)
            wanted = in_bits(every, e["key"].astype(np.uint64)) if every is not None else None
            # Lists are sorted by size, so what a set's size allows follows it directly.
            above = np.minimum(100 * n // percent, (1 << 32) - 1)
            reach = np.searchsorted((group << 32) | n, (group << 32) | above, side="right") - np.arange(len(doc))
            i, step, pairs, cut = np.arange(len(doc)), 0, [], side.any()
            while True:
                step += 1
                i = i[reach[i] > step]
                if not len(i):
                    break
                j = i + step
                near = rank[i] != rank[j]
                if cut:
                    near &= (side[i] == 0) | (side[i] != side[j])
                if wanted is not None:
                    near &= np.where(rank[i] > rank[j], wanted[i], wanted[j])
                x, y = i[near], j[near]
                good = passing(e, x, y, percent)
                x, y = x[good], y[good]
                late, early = np.where(rank[x] > rank[y], x, y), np.where(rank[x] > rank[y], y, x)
                if every is None:
                    for half in (late == y, late == x):  # within each half a row is late once
                        at, other = late[half], early[half]
                        best[at] = np.minimum(best[at], rank[other] * len(doc) + other)
                        found[at] += 1
                elif len(late):
                    pairs.append(np.stack([late, early]))
            if every is None:
                late = np.flatnonzero(found)
                early = best[late] % max(len(doc), 1)
            else:
                late, early = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
            for start in range(0, len(late), 100_000):
                l, o = late[start:start + 100_000], early[start:start + 100_000]
                yield batch_of(schema, [doc[l], line[l], doc[o], line[o], found[l], e["key"][l].astype(np.int64)])
    return compare


def several(keys: np.ndarray) -> np.ndarray:
    """Which of sorted keys have an equal neighbour."""
    out = np.zeros(len(keys), bool)
    out[1:] = keys[1:] == keys[:-1]
    out[:-1] |= out[1:]
    return out


def in_bits(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the slot of each hash is set."""
    slot = (hashes % np.uint64(FILTER_BITS)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7)) & 1 == 1


def or_bits(slots: DataFrame) -> np.ndarray:
    """Bits of the slots in column ``slot``; of fixed size."""
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    parts = slots.select(F.expr("slot div 32768").alias("part"), F.expr("slot % 32768").alias("bit")).groupBy("part").agg(
        F.bitmap_construct_agg("bit").alias("bits"))
    for row in parts.collect():
        out[row.part * 4096:row.part * 4096 + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return out


def place_slot(doc: str = "doc_id", line: str = "line"):
    return F.pmod(F.pmod(F.col(doc), F.lit(ID_PRIME)) * 31 + F.col(line).cast("long") * 2_654_435, F.lit(FILTER_BITS))


def place_slots(ids: np.ndarray, number: np.ndarray) -> np.ndarray:
    """:func:`place_slot` of arrays."""
    return ((ids % ID_PRIME * 31 + number.astype(np.int64) * 2_654_435) % FILTER_BITS).astype(np.uint64)


def _verify(percent: int):
    """Pairs whose sets are similar; pairs are numbered within a batch, so that one sort counts all shared words."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                (a, first), (b, second) = (unpacked_words(batch.column(c)) for c in ("words_a", "words_b"))
                n, m = np.diff(first), np.diff(second)
                shift = np.uint64(8 * WORD_BYTES)
                pair = np.concatenate([np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(m)), m)]).astype(np.uint64)
                keys = np.sort((pair << shift) | np.concatenate([a, b]))
                shared = np.bincount((keys[1:][keys[1:] == keys[:-1]] >> shift).astype(np.int64), minlength=len(n))
                good = 100 * shared >= percent * (n + m - shared)
                yield batch.select([f.name for f in arrow_schema(PAIRS)]).filter(pa.array(good, pa.bool_())).cast(arrow_schema(PAIRS))
    return verify


def _verified(sets: DataFrame, pairs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The pairs of places whose sets are similar, and the sets of the later places (k1, doc_id, line, words; others too)."""
    later = or_bits(pairs.select(place_slot().alias("slot")))
    earlier = or_bits(pairs.select(place_slot("other_id", "other_line").alias("slot")))
    spec = "doc_id long, line int, k1 long, k2 long, words binary, later boolean, earlier boolean"

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = place_slots(batch.column("doc_id").to_numpy(), batch.column("line").to_numpy())
            a, b = in_bits(later, slot), in_bits(earlier, slot)
            columns = [*(batch.column(c) for c in ("doc_id", "line", "k1", "k2", "words")), pa.array(a, pa.bool_()), pa.array(b, pa.bool_())]
            yield batch_of(arrow_schema(spec), columns).filter(pa.array(a | b, pa.bool_()))

    kept = materialise(sets.mapInArrow(on_sets(held), spec), "line-sets")
    joined = pairs.join(kept.where("later").select("doc_id", "line", "k1", "k2", F.col("words").alias("words_a")), ["doc_id", "line"]).join(
        kept.where("earlier").select(F.col("doc_id").alias("other_id"), F.col("line").alias("other_line"), F.col("words").alias("words_b")),
        ["other_id", "other_line"])
    similar = joined.select("doc_id", "line", "other_id", "other_line", "k1", "k2", "words_a", "words_b").mapInArrow(_verify(percent), PAIRS)
    return similar, kept.where("later").select("k1", "doc_id", "line", "words")


def similar_lines(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two frames: every line with words (k1, k2, n, doc_id, line, copies), and a similar earlier class for each class that has one.

    The second holds the places of both classes, and the keys of the later one: doc_id, line, other_id, other_line, k1, k2.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    plain = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc_id"), F.col(quoted(text)).cast("string").alias("text")).where(
        "doc_id is not null and text is not null")
    table = materialise(plain.mapInArrow(_lines, LINES), "lines")
    lines, sets = table.drop("sets"), table.select("sets").where("sets is not null")
    words = lambda b: (unpacked_words(p.column("words"))[0] for p in slices(b, "words"))
    ranks = spark.sparkContext.broadcast(rarity_table(sets.mapInArrow(on_sets(counted(words, BUCKETS)), COUNTS_DDL), BUCKETS))
    sizes = rarity_table(sets.mapInArrow(on_sets(counted(_frequent_tokens(ranks, percent), BUCKETS)), COUNTS_DDL), BUCKETS)
    length = 2.0 ** (sizes.astype(float) / 8) - 1
    usual = length.mean()  # what other words add to a list's bucket
    split = np.where(length > 8 * usual + BLOCK, np.ceil((length - 4 * usual) / BLOCK), 1).clip(1, 1 << 15).astype(np.uint16)
    blocks = spark.sparkContext.broadcast(split)
    listed = table.where("copies > 0").agg(F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).head()[0] or 0
    parts = max(1, -(-int(listed) // PART_ENTRIES))

    def candidates(only: np.ndarray | None, every: np.ndarray | None) -> DataFrame:
        entries = sets.mapInArrow(on_sets(_entries(ranks, blocks, percent, parts, only)), ENTRIES)
        return entries.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_compare(percent, every), CANDIDATES)

    first = materialise(candidates(None, None), "candidates")
    # All copies of a class are in the same lists, so candidates stand at the first line of their class.
    # Two steps over numbers, which are hashed, where a least struct would be sorted; both are over the one exchange.
    best = first.repartition("doc_id", "line").groupBy("doc_id", "line", "other_id").agg(
        F.min("other_line").alias("other_line"), F.sum("found").alias("found"), F.min("key").alias("key")).groupBy("doc_id", "line").agg(
        F.min_by("other_line", "other_id").alias("other_line"), F.min("other_id").alias("other_id"), F.sum("found").alias("found"), F.min("key").alias("key"))
    pairs = materialise(best.select("doc_id", "line", "other_id", "other_line", "found", "key"), "best-candidates")
    similar, later = _verified(sets, pairs.drop("found", "key"), percent)
    sure = materialise(similar, "similar")
    failed = pairs.where("found > 1").join(sure.select("doc_id", "line"), ["doc_id", "line"], "left_anti")
    failed = materialise(failed.select("doc_id", "line", "key"), "open-lines")
    if failed.isEmpty():
        return lines, sure
    classes = or_bits(failed.select(F.pmod("key", F.lit(FILTER_BITS)).alias("slot")))
    tokens = or_bits(later.mapInArrow(_tokens_of(classes, ranks, percent), "slot long"))
    again = candidates(tokens, classes).select("doc_id", "line", "other_id", "other_line").distinct()
    again = materialise(again.join(failed.select("doc_id", "line"), ["doc_id", "line"], "left_semi").join(
        pairs.drop("found", "key"), ["doc_id", "line", "other_id", "other_line"], "left_anti"), "more-candidates")
    return lines, sure.unionByName(_verified(sets, again, percent)[0])


def _tokens_of(classes: np.ndarray, ranks, percent: int):
    """Slots of the lists that hold a class in ``classes``."""
    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_bits(classes, batch.column("k1").to_numpy().view(np.uint64)), pa.bool_()))
            for piece in slices(batch, "words", SET_BYTES):
                listed = mix(Prefixes(piece, ranks.value, percent).tokens)
                yield batch_of(arrow_schema("slot long"), [np.unique((listed % np.uint64(FILTER_BITS)).astype(np.int64))])
    return slots


def _gone(docs: DataFrame, percent: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """All lines with words, and doc_id with the sorted numbers of the lines that go, for documents that lose lines."""
    lines, similar = similar_lines(docs, percent, doc_id, text)
    # A class has few first lines of a piece, however many copies, so they may meet before they are aggregated, in two steps
    # over numbers, which are hashed, where a least struct would be sorted.
    classes = lines.where("copies > 0").select("k1", "k2", "doc_id", "line", "copies").repartition("k1", "k2").groupBy("k1", "k2", "doc_id").agg(
        F.min("line").alias("line"), F.sum("copies").alias("n")).groupBy("k1", "k2").agg(
        F.struct(F.min("doc_id").alias("doc_id"), F.min_by("line", "doc_id").alias("line")).alias("first"), F.sum("n").alias("n"))
    late = similar.select("k1", "k2").distinct().withColumn("late", F.lit(True))
    # Written, so that the join below deals a class with many lines to several tasks.
    classes = materialise(classes.join(late, ["k1", "k2"], "left").where("n > 1 or late").select("k1", "k2", "first", "late"), "classes")
    gone = lines.join(classes, ["k1", "k2"]).where("late or first.doc_id <> doc_id or first.line <> line")
    return lines, gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def removed_lines(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the sorted numbers of the lines that go, for documents that lose lines."""
    return _gone(docs, percent, doc_id, text)[1]


def line_report(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines (with words), n_removed, removed for every row of ``docs``."""
    lines, gone = _gone(docs, percent, doc_id, text)
    counts = lines.groupBy("doc_id").agg(F.size(F.collect_set("line")).cast("long").alias("n_lines")).join(gone, "doc_id", "left")
    ids = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc_id"))
    return ids.join(counts, "doc_id", "left").select(
        "doc_id", F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def dedup_lines(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text", drop_emptied: bool = False) -> DataFrame:
    """``docs`` with the texts' later similar lines removed; all columns stay.

    A document that keeps no word stays with what is left, or goes with ``drop_emptied``; one without words from the start stays.
    """
    own, numbers = unused(docs, "removed_from"), unused(docs, "removed_lines")
    gone = removed_lines(docs, percent, doc_id, text).select(F.col("doc_id").alias(own), F.col("removed").alias(numbers))
    joined = docs.join(gone, docs[quoted(doc_id)].cast("long") == F.col(own), "left")
    kept = F.array_join(F.filter(F.split(F.col(quoted(text)), "\n", -1), lambda x, i: ~F.array_contains(numbers, i)), "\n")
    cleaned = joined.withColumn(text, F.when(F.col(numbers).isNull(), F.col(quoted(text))).otherwise(kept))
    if drop_emptied:
        cleaned = cleaned.where(F.col(numbers).isNull() | F.col(quoted(text)).rlike(r"[^\x20\x09-\x0D]"))
    return cleaned.drop(own, numbers)

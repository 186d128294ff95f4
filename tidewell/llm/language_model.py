"""Language-model scores by deleted interpolation.

The probability of a token is a mixture of the maximum-likelihood bigram and the
smoothed unigram.  Mixture weights depend on how often the context was seen (buckets
of powers of two) and are learned by expectation-maximisation on a held-out fifth of the
training texts (``deleted``), with counts from the other training texts; the final
estimates use the counts of all training texts.

Work on tokens is done on batches of documents, each kept as one row with its words
numbered.  A batch asks for the counts of its distinct words and then word pairs: the
requests carry the batch's own counts, packed by hash bucket, a bucket's task adds
them up and answers each batch in its order.  So a word or pair is sent once per batch
however frequent it is, no table of counts is broadcast or collected, and any number of
tasks can share the work.  Expectation-maximisation sees the held-out tokens as a
histogram of fixed size (bucket by ratio of the two estimates).

Documents are split by crc32 of the id as text; tokens are words with A-Z lower-cased and
one end.  Null and empty texts are the end alone.  Rows with null id are scored and never
train; repeated rows count and are scored each.  Whole texts are counted and scored.
Without training tokens only the smoothing remains.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_schema, batch_of, chain, fold, materialise, slices, strings, words_of

#: Bytes of text of a batch, distinct keys per bucket aimed at, context buckets, histogram bins per unit of log ratio.
BATCH_BYTES, BUCKET_KEYS, CONTEXTS, BINS = 4 << 20, 2_000_000, 24, 8
RATIOS = 40 * BINS
#: Hash of the end token and of the start of a text.
END, START = np.uint64(0x1B873593CC9E2D51), np.uint64(0x85EBCA6BC2B2AE35)
ROUNDS = 30
#: Roles of documents: counts for the weights, held out for the weights, not for training.
BASE, DELETED, NONE = 0, 1, 2

BATCHES = "batch long, doc_ids binary, valid binary, roles binary, counts binary, codes binary, hashes binary, n_tokens long"
REQUESTS = "batch long, bucket long, keys binary, base binary, deleted binary"
ANSWERS = "batch long, bucket long, base binary, deleted binary, kinds long, total_base long, total_deleted long"
SCORES = "doc_id long, role int, n_tokens long, n_known long, base_score double, score double"


def squeezed(values: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed: small and rising numbers take little room."""
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def loose(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of documents with numbered words; a batch's name is the least hash of its rows' places."""
    schema = arrow_schema(BATCHES)
    for batch in batches:
        for piece in slices(batch, "text", BATCH_BYTES):
            words = words_of(strings(piece.column("text")))
            counts = words.counts + 1
            ends = np.cumsum(counts) - 1
            tokens = np.full(int(counts.sum()), END)
            inside = np.ones(len(tokens), bool)
            inside[ends] = False
            tokens[inside] = words.hashes
            hashes, codes = np.unique(tokens, return_inverse=True)
            # Frequent words get small numbers, which take less room.
            common = np.argsort(-np.bincount(codes), kind="stable")
            number = np.empty(len(common), np.int32)
            number[common] = np.arange(len(common))
            ids = piece.column("doc_id")
            yield batch_of(schema, [
                [piece.column("place")[0].as_py()],
                *([squeezed(a)] for a in (
                    ids.fill_null(0).to_numpy(), np.array(ids.is_valid(), np.uint8), piece.column("role").to_numpy().astype(np.uint8),
                    counts.astype(np.int32), number[codes], hashes[common])), [len(tokens)]])


class Batch:
    """One row of the numbered batches."""

    def __init__(self, row: dict):
        self.doc_ids = loose(row["doc_ids"], np.int64)
        self.valid = loose(row["valid"], np.uint8).astype(bool)
        self.roles = loose(row["roles"], np.uint8)
        self.counts = loose(row["counts"], np.int32).astype(np.int64)
        hashes = loose(row["hashes"], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        self.codes = number[loose(row["codes"], np.int32)]
        self.role = np.repeat(self.roles, self.counts)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct word pairs (keys), the pair of each token, and the context code of each token (-1 at a start)."""
        before = np.concatenate([[-1], self.codes[:-1]])
        before[np.cumsum(self.counts) - self.counts] = -1
        width = len(self.hashes) + 1
        small, place = np.unique((before + 1) * width + self.codes, return_inverse=True)
        first = np.concatenate([[START], self.hashes])[small // width]
        keys = chain(first, self.hashes[small % width])
        order = np.argsort(keys)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return keys[order], rank[place], before

    def by_role(self, places: np.ndarray, size: int, role: int) -> np.ndarray:
        return np.bincount(places[self.role == role], minlength=size)


def cut(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of the buckets in sorted keys: buckets are ranges of the hash."""
    edges = (np.arange(1, buckets, dtype=np.float64) * (2.0 ** 64 / buckets)).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _rows(batch: int, keys: np.ndarray, base: np.ndarray, deleted: np.ndarray, buckets: int) -> pa.RecordBatch:
    bounds = cut(keys, buckets)
    held = [k for k in range(buckets) if bounds[k + 1] > bounds[k]]
    part = lambda x, t: [squeezed(x[bounds[k]:bounds[k + 1]].astype(t)) for k in held]
    steps = [squeezed(np.diff(keys[bounds[k]:bounds[k + 1]], prepend=np.uint64(0))) for k in held]
    return batch_of(arrow_schema(REQUESTS), [[batch] * len(held), held, steps, part(base, np.uint32), part(deleted, np.uint32)])


def _ask_words(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches:
            for row in table.to_pylist():
                b = Batch(row)
                size = len(b.hashes)
                yield _rows(row["batch"], b.hashes, b.by_role(b.codes, size, BASE), b.by_role(b.codes, size, DELETED), buckets)
    return ask


def _ask_pairs(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches:
            for row in table.to_pylist():
                b = Batch(row)
                keys, places, _ = b.pairs()
                yield _rows(row["batch"], keys, b.by_role(places, len(keys), BASE), b.by_role(places, len(keys), DELETED), buckets)
    return ask


def _answer(key, group):
    """Sum the counts of a bucket and give every batch the sums of its keys, in its order."""
    parts = [np.cumsum(loose(k, np.uint64), dtype=np.uint64) for k in group.column("keys").to_pylist()]
    values, place = np.unique(np.concatenate(parts), return_inverse=True)
    sums = []
    for name in ("base", "deleted"):
        counts = np.concatenate([loose(c, np.uint32) for c in group.column(name).to_pylist()])
        sums.append(np.bincount(place, counts, len(values)).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    back = lambda s: [squeezed(s[place[a:b]].astype(np.uint32)) for a, b in zip(bounds, bounds[1:])]
    rows = len(parts)
    first = lambda n: pa.array([int(n)] + [0] * (rows - 1), pa.int64())
    return pa.table([group.column("batch"), group.column("bucket"), pa.array(back(sums[0]), pa.binary()),
                     pa.array(back(sums[1]), pa.binary()), first(((sums[0] + sums[1]) > 0).sum()), first(sums[0].sum()),
                     first(sums[1].sum())], schema=arrow_schema(ANSWERS))


def context_bucket(counts: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else one more than the whole part of the binary logarithm."""
    return np.where(counts > 0, np.minimum(1 + np.log2(np.maximum(counts, 1)).astype(np.int64), CONTEXTS - 1), 0)


def unigram(count: np.ndarray, total: float, kinds: float) -> np.ndarray:
    return (count + 0.5) / (total + 0.5 * (kinds + 1))


def _parts(b: Batch, word_counts, pair_counts, roles: tuple[int, ...]):
    """Context count, pair count and word count of each token, from the counts of ``roles``."""
    keys, places, before = b.pairs()
    take = lambda counts: sum(counts[r] for r in roles)
    words, pairs = take(word_counts), take(pair_counts)
    return np.where(before >= 0, words[np.maximum(before, 0)], -1), pairs[places], words[b.codes]


def _histogram(total: float, kinds: float, starts: float):
    schema = arrow_schema("cell long, tokens long")

    def count(key, group):
        b, words, pairs = _unbundled(group)
        context, pair, word = _parts(b, words, pairs, (BASE,))
        held = b.role == DELETED
        context, pair, word = (x[held] for x in (context, pair, word))
        seen = np.where(context < 0, starts, context)
        ratio = np.where(pair > 0, pair / np.maximum(seen, 1) / unigram(word, total, kinds), 0)
        bin_ = np.where(ratio > 0, np.clip((np.log(np.maximum(ratio, 1e-300)) * BINS).astype(np.int64) + RATIOS // 2, 1, RATIOS - 1), 0)
        cells, n = np.unique(context_bucket(seen) * RATIOS + bin_, return_counts=True)
        return pa.table([pa.array(cells, pa.int64()), pa.array(n, pa.int64())], schema=schema)
    return count


def learn_weights(cells: dict[int, int]) -> np.ndarray:
    """Weight of the bigram per context bucket, by expectation-maximisation on the histogram."""
    weights = np.zeros(CONTEXTS)
    for bucket in range(1, CONTEXTS):
        held = [(c % RATIOS, n) for c, n in cells.items() if c // RATIOS == bucket]
        if not held:
            weights[bucket] = weights[bucket - 1]
            continue
        ratio = np.array([0.0 if k == 0 else np.exp((k - RATIOS // 2 + 0.5) / BINS) for k, _ in held])
        n = np.array([n for _, n in held], float)
        weight = 0.5
        for _ in range(ROUNDS):
            weight = float((n * weight * ratio / (weight * ratio + 1 - weight)).sum() / n.sum())
        weights[bucket] = min(max(weight, 1e-4), 0.9999)
    return weights


def _score(total: float, kinds: float, starts: float, weights: np.ndarray):
    schema = arrow_schema(SCORES)

    def score(key, group):
        b, words, pairs = _unbundled(group)
        context, pair, word = _parts(b, words, pairs, (BASE, DELETED))
        seen = np.where(context < 0, starts, context)
        plain = unigram(word, total, kinds)
        weight = weights[context_bucket(seen)]
        mixed = weight * pair / np.maximum(seen, 1) + (1 - weight) * plain
        bounds = np.cumsum(b.counts) - b.counts
        sums = lambda x: np.add.reduceat(x, bounds)
        ids = pa.array(b.doc_ids, pa.int64(), mask=~b.valid)
        return pa.table([ids, pa.array(b.roles.astype(np.int32)), pa.array(b.counts), pa.array(sums((word > 0).astype(np.int64))),
                         pa.array(sums(np.log10(plain))), pa.array(sums(np.log10(mixed)))], schema=schema)
    return score


#: Rows of a batch's own data and of the answers to it, in one table so that they meet in one group.
BUNDLE = "batch long, kind int, bucket long, a binary, b binary, c binary, d binary, e binary, f binary"


def _bundle(batches: DataFrame, words: DataFrame, pairs: DataFrame) -> DataFrame:
    none = F.lit(None).cast("binary")
    answers = lambda frame, kind: frame.select(
        "batch", F.lit(kind).alias("kind"), "bucket", F.col("base").alias("a"), F.col("deleted").alias("b"),
        none.alias("c"), none.alias("d"), none.alias("e"), none.alias("f"))
    own = batches.select("batch", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("bucket"), F.col("doc_ids").alias("a"),
                         F.col("valid").alias("b"), F.col("roles").alias("c"), F.col("counts").alias("d"),
                         F.col("codes").alias("e"), F.col("hashes").alias("f"))
    return own.unionByName(answers(words, 1)).unionByName(answers(pairs, 2))


def _unbundled(group: pa.Table):
    rows = group.to_pylist()
    own = next(r for r in rows if r["kind"] == 0)
    b = Batch(dict(zip(("doc_ids", "valid", "roles", "counts", "codes", "hashes"), (own[x] for x in "abcdef"))))
    out = []
    for kind in (1, 2):
        held = sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["bucket"])
        out.append(tuple(np.concatenate([loose(r[x], np.uint32) for r in held]).astype(np.int64) for x in "ab"))
    return b, *out


def language_scores(docs: DataFrame, modulus: int = 5, held: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``."""
    part = fold(doc_id, modulus)
    deleted = (held + 1) % modulus
    role = F.when(part.isNull() | (part == held), NONE).when(part == deleted, DELETED).otherwise(BASE)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), role.alias("role"), F.col(text).cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("place"))
    batches = materialise(rows.mapInArrow(_number, BATCHES), "batches")
    facts = batches.agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")).first()
    buckets = max(8, -(-(facts.tokens or 0) // BUCKET_KEYS))
    words = materialise(batches.mapInArrow(_ask_words(buckets), REQUESTS).groupBy("bucket").applyInArrow(_answer, ANSWERS), "word-counts")
    pairs = materialise(batches.mapInArrow(_ask_pairs(buckets), REQUESTS).groupBy("bucket").applyInArrow(_answer, ANSWERS), "pair-counts")
    sums = words.agg(F.sum("kinds").alias("kinds"), F.sum("total_base").alias("base"), F.sum("total_deleted").alias("deleted")).first()
    base, deleted_tokens, kinds = (float(x or 0) for x in (sums.base, sums.deleted, sums.kinds))
    texts = docs.groupBy(role.alias("role")).count().collect()
    starts = {r.role: float(r["count"]) for r in texts}

    bundle = _bundle(batches, words, pairs).groupBy("batch")
    cells = bundle.applyInArrow(_histogram(base, kinds, starts.get(BASE, 0.0)), "cell long, tokens long").groupBy("cell").agg(
        F.sum("tokens").alias("tokens")).collect()
    weights = learn_weights({r.cell: r.tokens for r in cells})
    scored = bundle.applyInArrow(_score(base + deleted_tokens, kinds, starts.get(BASE, 0.0) + starts.get(DELETED, 0.0), weights), SCORES)
    return scored.select("doc_id", F.coalesce(fold("doc_id", modulus) == held, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                         F.lit(int(base + deleted_tokens)).cast("long").alias("train_tokens"), "base_score", "score")

"""Katz backoff language model over the whole corpus, and scores of whole texts.

**Model.**  Counts of n-grams up to ``order`` are discounted by Good-Turing up to
``K`` occurrences.  What a history loses goes to the words never seen after it, in
proportion to the model of the next lower order, with backoff weights that make the
probabilities of all words sum to one.  Words of no training text share one unknown
word, which has the mass that the unigrams lose.

**Tables.**  Texts are encoded once into chunks of about ``chunk_tokens`` tokens: a local
vocabulary of 64-bit word hashes and the token numbers.  Model tables are spread over
buckets by the hash of the n-gram (or history).  A chunk sends each bucket its different
keys with their counts, the bucket adds up the counts of all chunks, and sends the totals
back.  So a task holds one chunk or one bucket, and a word or pair that makes up a third
of the corpus is still one key per chunk.  The number of buckets follows the corpus.

For each order above one there are two such tables: the n-gram counts, and for every
history the sums that give its backoff weight.  ``tables`` holds them all.

Good-Turing needs how many n-grams occur once, twice and so on.  Where these are too few
for it (some are zero, or a discount falls outside 0 to 1), an absolute discount takes
its place.  A history whose counts are all too large to be discounted is treated as seen
once more, so its unseen words keep a share.

Keys are 64-bit hashes; two n-grams with one hash would share their counts.

Nulls and edge cases: a null or empty text is the end token only.  Repeated rows are
counted and scored each.  With no training row the unknown word has probability one.
Other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonotheca.llm.words import SPACED, Words, groups, mixed
from sonotheca.session import written

ORDER = 2
K = 5
CHUNK_TOKENS = 1 << 20
BUCKET_KEYS = 1 << 20
#: Stand-ins for the end of a text and for what precedes it.
END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def packed(values: np.ndarray) -> bytes:
    """An array as compressed bytes: all first bytes, then all second bytes, and so on."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.compress(planes.tobytes(), 1) if len(values) else b""


def unpacked(data: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    if not data:
        return np.empty(0, kind)
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


# -- chunks ---------------------------------------------------------------------------------


def _encode(chunk_tokens: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of whole texts: ids, training flags, lengths, token numbers and vocabulary."""
    part, number = TaskContext.get().partitionId(), 0
    ids, train, sizes, hashes, held = [], [], [], [], 0

    def chunk(schema: pa.DataType) -> pa.RecordBatch:
        words, inverse, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")  # frequent words get small numbers
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        return pa.RecordBatch.from_arrays([
            pa.array([part << 32 | number], pa.int64()),
            pa.array([ids], pa.list_(schema)),
            pa.array([packed(np.array(train, np.uint8))], pa.binary()),
            pa.array([packed(np.array(sizes, np.int64))], pa.binary()),
            pa.array([packed(rank[inverse])], pa.binary()),
            pa.array([packed(words[order])], pa.binary()),
            pa.array([len(inverse)], pa.int64()),
        ], names=["chunk", "ids", "train", "sizes", "tokens", "words", "n_tokens"])

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        own_ids, own_train = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for first, texts in groups(batch.column(2)):
            words = Words(texts, SPACED)
            each = np.insert(words.hashes(), words.first[1:], END)
            ids += own_ids[first:first + len(texts)]
            train += own_train[first:first + len(texts)]
            sizes += (np.diff(words.first) + 1).tolist()
            hashes.append(each)
            held += len(each)
            if held >= chunk_tokens:
                yield chunk(kind)
                number += 1
                ids, train, sizes, hashes, held = [], [], [], [], 0
    if held:
        yield chunk(kind)


class Chunk:
    """One chunk in memory, with the totals that the model tables returned for it."""

    def __init__(self, row: dict):
        self.ids = row["ids"]
        self.train = unpacked(row["train"], np.uint8).astype(bool)
        self.sizes = unpacked(row["sizes"], np.int64)
        self.tokens = unpacked(row["tokens"], np.int32)
        self.words = unpacked(row["words"], np.uint64)
        self.in_training = np.repeat(self.train, self.sizes)
        first = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(self.tokens)) - np.repeat(first, self.sizes)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For every token the hash of its history of ``n`` - 1 tokens, and of the whole n-gram."""
        hashes = self.words[self.tokens]
        history = np.full(len(hashes), np.uint64(n))
        for back in range(n - 1, 0, -1):
            before = np.full(len(hashes), START)
            before[back:] = hashes[:-back]
            before[self.place < back] = START
            history = history * _ODD + before
        return mixed(history), mixed(history * _ODD + hashes)


# -- totals over all chunks ----------------------------------------------------------------


def _parcels(number: int, keys: np.ndarray, values: list[np.ndarray], bits: int):
    """One parcel per bucket for sorted ``keys``: key differences and value columns, packed."""
    edges = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.array([0])
    edges = np.append(edges, len(keys))
    for bucket, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        if b > a:
            yield {"chunk": number, "bucket": bucket, "keys": packed(np.diff(keys[a:b], prepend=np.uint64(0))),
                   "columns": [packed(v[a:b]) for v in values], "kinds": [v.dtype.str for v in values]}


_PARCEL = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()),
                     ("columns", pa.list_(pa.binary())), ("kinds", pa.list_(pa.string()))])
_PARCEL_DDL = "chunk BIGINT, bucket BIGINT, `keys` BINARY, columns ARRAY<BINARY>, kinds ARRAY<STRING>"


def _small(values: np.ndarray) -> np.ndarray:
    """Whole numbers in 32 bits where they fit."""
    return values.astype(np.uint32) if not len(values) or values.max() < 1 << 32 else values.astype(np.uint64)


def _add_up(parcels: pa.Table) -> pa.Table:
    """Totals of one bucket, sent back to each chunk in the order of its keys.

    The first column says which chunk's key stands for the key in sums over different
    keys; ``stats`` counts keys by total (1 .. K + 1), different keys, and their sum.
    """
    rows = parcels.to_pylist()
    keys = [np.cumsum(unpacked(r["keys"], np.uint64), dtype=np.uint64) for r in rows]
    sizes = [len(k) for k in keys]
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    cuts = np.cumsum(sizes)[:-1]
    totals = []
    own = None
    for j in range(len(rows[0]["columns"])):
        values = np.concatenate([unpacked(r["columns"][j], r["kinds"][j]) for r in rows])
        if own is None:
            # the first row that counts the key in training
            at = np.flatnonzero(values > 0)
            _, first = np.unique(inverse[at], return_index=True)
            own = np.zeros(len(values), np.uint8)
            own[at[first]] = 1
        total = np.bincount(inverse, weights=values.astype(float), minlength=len(distinct))
        totals.append(total if values.dtype.kind == "f" else total.astype(np.int64))
    whole = totals[0]
    seen = whole[whole > 0]
    stats = [int((seen == r).sum()) for r in range(1, K + 2)] + [len(seen), int(seen.sum())]
    back = [np.split(_small(t[inverse]) if t.dtype.kind != "f" else t[inverse], cuts) for t in totals]
    owners = np.split(own, cuts)
    return pa.Table.from_pylist([
        {"chunk": r["chunk"], "bucket": r["bucket"], "own": packed(owners[i]),
         "columns": [packed(b[i]) for b in back], "kinds": [b[i].dtype.str for b in back],
         "stats": stats if i == 0 else None}
        for i, r in enumerate(rows)], schema=_TOTAL)


_TOTAL = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("own", pa.binary()), ("columns", pa.list_(pa.binary())),
                    ("kinds", pa.list_(pa.string())), ("stats", pa.list_(pa.int64()))])
_TOTAL_DDL = "chunk BIGINT, bucket BIGINT, own BINARY, columns ARRAY<BINARY>, kinds ARRAY<STRING>, stats ARRAY<BIGINT>"


def _exchange(parcels: DataFrame, label: str) -> tuple[DataFrame, list[int]]:
    """The totals for every chunk and bucket as a table, and the summed ``stats``."""
    back = written(parcels.groupBy("bucket").applyInArrow(_add_up, _TOTAL_DDL), label)
    sums = back.where("stats IS NOT NULL").agg(*(F.sum(F.get("stats", F.lit(i))) for i in range(K + 3))).first()
    return back, [int(x or 0) for x in sums]


def _unite(buckets: list[dict]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Own flags and total columns over all buckets of a chunk, in key order."""
    rows = sorted(buckets, key=lambda r: r["bucket"])
    columns = [np.concatenate([unpacked(r["columns"][j], r["kinds"][j]) for r in rows]) for j in range(len(rows[0]["columns"]))]
    return np.concatenate([unpacked(r["own"], np.uint8) for r in rows]).astype(bool), columns


# -- the model -----------------------------------------------------------------------------


class Discount:
    """Good-Turing discounts from the numbers of keys that occur 1 .. K + 1 times."""

    def __init__(self, stats: list[int]):
        n = [0, *stats[:K + 1]]
        self.factor = np.ones(K + 1)
        if all(n[1:]):
            r = np.arange(1, K + 1)
            cut = (K + 1) * n[K + 1] / n[1]
            if cut != 1:
                self.factor[1:] = (((r + 1) * np.array(n[2:]) / (r * np.array(n[1:-1]))) - cut) / (1 - cut)
        if not ((self.factor[1:] > 0) & (self.factor[1:] < 1)).all():
            lost = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
            lost = lost if 0 < lost < 1 else 0.5
            self.factor[1:] = 1 - lost / np.arange(1, K + 1)
        self.lost = sum((1 - self.factor[r]) * r * n[r] for r in range(1, K + 1))

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        """The discounted counts."""
        return counts * self.factor[np.where(counts <= K, counts, 0).astype(np.int64)]


class Model:
    """What all chunks need besides their own totals: stats per order and derived discounts."""

    def __init__(self, order: int):
        self.order = order
        self.discounts: dict[int, Discount] = {}
        self.vocabulary = self.total = 0

    def add(self, n: int, stats: list[int]) -> None:
        self.discounts[n] = Discount(stats)
        if n == 1:
            self.vocabulary, self.total = stats[K + 1], stats[K + 2]

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """Probabilities of words by training count; zero counts stand for the unknown word."""
        discount = self.discounts[1]
        lost, whole = discount.lost, self.total
        if not lost:  # nothing to discount: the unknown word counts once
            lost, whole = 1, self.total + 1
        return np.where(counts > 0, discount(counts), lost) / whole

    def chain(self, chunk: Chunk, totals: dict[str, list[dict]], n: int) -> np.ndarray:
        """Probability of every token of a chunk given up to ``n`` - 1 tokens before it."""
        if n == 1:
            return self.unigram(_word_counts(chunk, totals["total_words"]))[chunk.tokens]
        lower = self.chain(chunk, totals, n - 1)
        history, gram = chunk.grams(n)
        _, at = np.unique(gram, return_inverse=True)
        counts = _unite(totals[f"total_grams{n}"])[1][0].astype(float)[at]
        _, at = np.unique(history, return_inverse=True)
        seen, kept, below = (column.astype(float)[at] for column in _unite(totals[f"total_histories{n}"])[1])
        whole = np.where(kept >= seen, seen + 1, seen)
        with np.errstate(divide="ignore", invalid="ignore"):
            backoff = (1 - kept / whole) / (1 - below)
            return np.where(seen <= 0, lower, np.where(counts > 0, self.discounts[n](counts) / whole, backoff * lower))


def _word_counts(chunk: Chunk, buckets: list[dict]) -> np.ndarray:
    """Training counts of the chunk's vocabulary, in its own order."""
    counts = np.empty(len(chunk.words))
    counts[np.argsort(chunk.words)] = _unite(buckets)[1][0]
    return counts


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Chunk]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield row, Chunk(row)


def _word_parcels(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row, chunk in _chunks(batches):
        counts = np.bincount(chunk.tokens, weights=chunk.in_training, minlength=len(chunk.words))
        order = np.argsort(chunk.words)
        parcels = _parcels(row["chunk"], chunk.words[order], [_small(counts[order])], bits)
        yield pa.RecordBatch.from_pylist(list(parcels), schema=_PARCEL)


def _gram_parcels(n: int, bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row, chunk in _chunks(batches):
        keys, inverse = np.unique(chunk.grams(n)[1], return_inverse=True)
        counts = np.bincount(inverse, weights=chunk.in_training, minlength=len(keys))
        yield pa.RecordBatch.from_pylist(list(_parcels(row["chunk"], keys, [_small(counts)], bits)), schema=_PARCEL)


def _history_parcels(model: Model, n: int, bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every history the sums over the n-grams that this chunk stands for."""
    for row, chunk in _chunks(batches):
        lower = model.chain(chunk, row, n - 1)
        history, gram = chunk.grams(n)
        _, first = np.unique(gram, return_index=True)
        own, (counts,) = _unite(row[f"total_grams{n}"])
        counts = counts.astype(np.int64)
        keys, inverse = np.unique(history, return_inverse=True)
        at = inverse[first[own]]
        add = lambda values: np.bincount(at, weights=values[own], minlength=len(keys))
        sums = [_small(add(counts)), add(model.discounts[n](counts)), add(lower[first])]
        yield pa.RecordBatch.from_pylist(list(_parcels(row["chunk"], keys, sums, bits)), schema=_PARCEL)


def _score_rows(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kind = batch.schema.field("ids").type.value_type
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            chunk = Chunk(row)
            counts = _word_counts(chunk, row["total_words"])
            counts = counts[chunk.tokens]
            first = np.cumsum(chunk.sizes) - chunk.sizes
            add = lambda values: np.add.reduceat(values, first)
            base = np.log10((counts + 1) / (model.total + model.vocabulary + 1))
            score = np.log10(model.chain(chunk, row, model.order))
            yield pa.RecordBatch.from_arrays([
                pa.array(chunk.ids, kind), pa.array(chunk.train), pa.array(chunk.sizes),
                pa.array(add((counts > 0).astype(np.int64))), pa.array(add(base)), pa.array(add(score)),
            ], names=["id", "train", "n_tokens", "n_known", "base_score", "score"])


def _with_totals(chunks: DataFrame, backs: dict[str, DataFrame]) -> DataFrame:
    """The chunks, each with what the named tables returned for it."""
    for name, back in backs.items():
        own = back.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "own", "columns", "kinds")).alias(f"total_{name}"))
        chunks = chunks.join(own, "chunk")
    return chunks


def scored(
    docs: DataFrame, training: Column, *, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
    chunk_tokens: int = CHUNK_TOKENS,
) -> DataFrame:
    """Learn from the rows where ``training`` holds and score all.

    ``id``, ``train``, ``n_tokens``, ``n_known`` (tokens with a training count),
    ``train_tokens``, ``base_score`` (add-one unigrams) and ``score`` (this model), both
    log10 probabilities of the whole text.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(training, F.lit(False)).alias("train"),
                       F.col(text_col).cast("binary").alias("text"))
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(docs.schema[id_col].dataType)),
        *T.StructType.fromDDL("train BINARY, sizes BINARY, tokens BINARY, words BINARY, n_tokens BIGINT").fields])
    chunks = written(rows.mapInArrow(functools.partial(_encode, chunk_tokens), schema), "chunks")
    n_tokens = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    bits = max(0, (n_tokens // BUCKET_KEYS).bit_length())
    model, backs = Model(order), {}

    def add(name: str, source: DataFrame, send) -> list[int]:
        backs[name], stats = _exchange(source.mapInArrow(send, _PARCEL_DDL), name)
        return stats

    model.add(1, add("words", chunks, functools.partial(_word_parcels, bits)))
    for n in range(2, order + 1):
        model.add(n, add(f"grams{n}", chunks, functools.partial(_gram_parcels, n, bits)))
        add(f"histories{n}", _with_totals(chunks, backs), functools.partial(_history_parcels, model, n, bits))
    out = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T.StructType.fromDDL(
        "train BOOLEAN, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, score DOUBLE").fields])
    found = _with_totals(chunks, backs).mapInArrow(functools.partial(_score_rows, model), out)
    return found.withColumn("train_tokens", F.lit(model.total).cast("bigint"))

"""SimHash near-duplicates, linked with BK-trees.

A fingerprint has one bit for each bit position that is set in over half of the XXH64
hashes (seed 42) of a text's word shingles.  Equal fingerprints are one node.  Two nodes
link if they differ in at most ``radius`` bits.

**Shards.**  The 64 bits are cut into ``radius`` + 1 bands.  Two fingerprints within the
radius agree on one band at least, so each band value is a shard, and every link lies
inside some shard.  A shard of more than ``shard_size`` fingerprints is cut again on its
remaining bits by the same argument, until it is small enough; distinct fingerprints
make that end.  Nothing is dropped, and no shard or tree exceeds the bound.

**Trees.**  Each shard builds a BK-tree: the children of a node are keyed by their
Hamming distance to it.  A search follows only the children whose key is within the
radius of the query's own distance.  A shard returns one edge for each fingerprint that
joins a tree component, never all pairs.  The trees travel with their shard: their total
grows with the corpus, so there is no bound that would allow a broadcast.

Nulls and edge cases: a null, empty or blank text has fingerprint zero, linked like any
other.  Fewer words than a shingle form one shingle.  A null id takes no part in the
smallest id; a component of nulls only has a null id.  Repeated rows are all kept.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonotheca.llm.components import components
from sonotheca.session import written

SHINGLE = 3
RADIUS = 2
SHARD_SIZE = 4096
SEED = 42
_BLOCK = 1 << 14


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, as an unsigned number."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    n = len(words) - size + 1
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    stops = (ends[size - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _BLOCK):
        some = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:min(at + _BLOCK, n)], stops[at:at + _BLOCK])],
                        dtype="<u8")
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(batch.num_columns - 1)),
                             dtype=np.uint64, count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints.view(np.int64))],
                                         names=[*batch.schema.names[:-1], "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id``, ``text_hash`` and ``fp`` (the fingerprint's 64 bits as a bigint) for every row."""
    kept = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).cast("binary").alias("text"))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                           T.StructField("text_hash", T.LongType()), T.StructField("fp", T.LongType())])
    return kept.mapInArrow(functools.partial(_fingerprints, shingle), schema)


class BKTree:
    """A BK-tree over 64-bit codes; searches return the positions within a radius."""

    def __init__(self):
        self.codes: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, code: int) -> None:
        self.codes.append(code)
        self.children.append({})
        new, at = len(self.codes) - 1, 0
        while at != new:
            at = self.children[at].setdefault((self.codes[at] ^ code).bit_count(), new)

    def within(self, code: int, radius: int) -> list[int]:
        found, todo = [], [0] if self.codes else []
        while todo:
            at = todo.pop()
            distance = (self.codes[at] ^ code).bit_count()
            if distance <= radius:
                found.append(at)
            for key in range(max(1, distance - radius), distance + radius + 1):
                child = self.children[at].get(key)
                if child is not None:
                    todo.append(child)
        return found


def _joined(codes: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """A spanning set of edges over the links among ``codes``."""
    tree, roots = BKTree(), list(range(len(codes)))

    def root(i: int) -> int:
        while roots[i] != i:
            roots[i] = roots[roots[i]]
            i = roots[i]
        return i

    for i, code in enumerate(codes):
        for j in tree.within(code, radius):
            a, b = root(i), root(j)
            if a != b:
                roots[a] = b
                yield code, codes[j]
        tree.add(code)


def _shard_edges(radius: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = [pair for shard in batch.column(0).to_pylist()
                 for pair in _joined([c & (1 << 64) - 1 for c in shard], radius)]
        both = np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def _bands(free: Column, parts: int) -> Column:
    """Cut the still free bits (an array of positions) into ``parts`` runs of nearly equal length."""
    size = F.size(free)
    cut = lambda i: F.floor(size * i / parts).cast("int")
    return F.array(*(F.slice(free, cut(i) + 1, cut(i + 1) - cut(i)) for i in range(parts)))


def _resharded(nodes: DataFrame, parts: int) -> DataFrame:
    """``fp``, ``path``, ``free`` with every shard cut on the next bands of its free bits.

    ``path`` names a shard: the masks and values that its members share.
    """
    mask = F.aggregate(F.col("band"), F.lit(0).cast("bigint"),
                       lambda acc, i: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i)))
    cut = nodes.select("fp", "path", "free", F.explode(_bands(F.col("free"), parts)).alias("band"))
    return cut.withColumn("mask", mask).select(
        "fp", F.concat("path", F.array("mask", F.col("fp").bitwiseAND(F.col("mask")))).alias("path"),
        F.array_except("free", "band").alias("free"))


def links(prints: DataFrame, radius: int = RADIUS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Edges ``a``, ``b`` that connect exactly the distinct ``fp`` reachable from each other."""
    nodes = prints.select("fp").where("fp IS NOT NULL").distinct().select(
        "fp", F.array().cast("array<bigint>").alias("path"), F.sequence(F.lit(0), F.lit(63)).alias("free"))
    found = None
    while True:
        cut = written(_resharded(nodes, radius + 1), "shards")
        sizes = written(cut.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shard-sizes")
        large = sizes.where(F.col("n") > shard_size)
        shards = (
            cut.join(sizes.where(F.col("n") <= shard_size).select("path"), "path")
            .groupBy("path").agg(F.collect_list("fp").alias("fps")).select("fps")
        )
        edges = written(shards.mapInArrow(functools.partial(_shard_edges, radius), "a BIGINT, b BIGINT"), "links")
        found = edges if found is None else found.union(edges)
        if not large.head(1):
            return found
        # what agrees on a whole shard's bits differs only in the bits that are still free
        nodes = cut.join(large.select("path"), "path").select("fp", "path", "free")


def _labelled(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, shard_size: int):
    """The fingerprints per row, and ``fp``, ``root``, ``component`` per distinct fingerprint."""
    prints = written(fingerprints(docs, id_col, text_col, shingle), "prints")
    roots = components(links(prints, radius, shard_size))
    nodes = written(prints.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    rooted = written(
        nodes.join(roots, nodes["fp"] == roots["node"], "left")
        .select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return prints, written(rooted.join(least, "root").select("fp", "root", "component"), "labels")


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = SHINGLE, radius: int = RADIUS, shard_size: int = SHARD_SIZE,
) -> DataFrame:
    """``id``, ``fp``, ``component`` per row: the smallest id reachable over links."""
    prints, labels = _labelled(docs, id_col, text_col, shingle, radius, shard_size)
    return prints.join(labels, "fp").select("id", "fp", "component")


def deduplicated(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = SHINGLE, radius: int = RADIUS, shard_size: int = SHARD_SIZE,
) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns.

    The row with the smallest id stays, a null id last; among rows that share it the
    one with the smallest text hash; of rows equal in both any one.
    """
    prints, labels = _labelled(docs, id_col, text_col, shingle, radius, shard_size)
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    rows = written(prints.join(labels, "fp").select("root", rank.alias("rank")), "ranked")
    first = written(rows.groupBy("root").agg(F.min("rank").alias("first")), "firsts")
    losers = written(
        rows.join(first, "root").where(~F.col("rank").eqNullSafe(F.col("first")))
        .select(F.col("rank.id").alias("_id"), F.col("rank.text_hash").alias("_hash")).distinct(), "losers")
    twice = written(
        prints.groupBy(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeated")
    same = F.col(id_col).eqNullSafe(F.col("_id")) & F.xxhash64(text_col).eqNullSafe(F.col("_hash"))
    kept = docs.join(losers, same, "left_anti")
    if not twice.head(1):
        return kept
    again = kept.join(twice, same, "left_semi").withColumn("_hash", F.xxhash64(text_col))
    once = again.dropDuplicates([id_col, "_hash"]).drop("_hash")
    return kept.join(twice, same, "left_anti").unionByName(once)

"""Benchmark decontamination by winnowing.

Every window of ``window`` words that a document shares with a benchmark item holds a
common fingerprint: the smallest hash among its runs of ``gram`` words.  Fingerprints of
both sides are joined on the words themselves, and each match is extended word by word
both ways; it counts if it reaches a whole window.

Items of fewer words than a window (but not none) are one window of their own length and
are fingerprinted whole, as all runs of that length in the documents are.

A document task only hands over fingerprints that the benchmark may hold.  It asks a bit
table of at most ``MOST_BITS`` bits, whose size follows the number of benchmark
fingerprints; a fuller table lets more rows through and changes no result.  The join
itself is left to Spark, which broadcasts the benchmark side only below its own limit.

Nulls and edge cases: a null or empty text has no words, is never contaminated and, as an
item, marks nothing.  A null item id counts as the empty string.  Rows that repeat an id
and a text get the same result; rows that share only the id are judged each on its text.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonotheca.llm.words import ALNUM, Words, gram_hashes, groups, window_minima
from sonotheca.session import written

WINDOW = 13
GRAM = 5
MOST_BITS = 1 << 28

_WORDS = pa.list_(pa.string())
_MARK = [("size", pa.int32()), ("pos", pa.int32()), ("gram", pa.string()),
         ("left", _WORDS), ("right", _WORDS)]
_MARK_DDL = "size INT, pos INT, gram STRING, `left` ARRAY<STRING>, `right` ARRAY<STRING>"


def _mark(words: Words, i: int, first: int, last: int, size: int, gram: int, window: int) -> dict:
    """A fingerprint at word ``i`` of the text ``first .. last`` with the words around it."""
    length, reach = (gram, window - gram) if size == window else (size, 0)
    left = words.span(max(first, i - reach), i)[::-1]
    right = words.span(i + length, min(last, i + length + reach))
    return {"size": size, "pos": i - first, "gram": " ".join(words.span(i, i + length)),
            "left": left, "right": right}


def _fingerprints(hashes: np.ndarray, size: int, gram: int, window: int):
    """Positions and hashes of the fingerprints for items of ``size`` words."""
    if size == window:
        values = gram_hashes(hashes, gram)
        at = window_minima(values, window - gram + 1)
        return at, values[at], gram
    values = gram_hashes(hashes, size)
    return np.arange(len(values)), values, size


def _item_marks(gram: int, window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [("item", pa.string()), ("hash", pa.int64()), *_MARK]
    for batch in batches:
        rows = []
        items = batch.column(0).to_pylist()
        for first, texts in groups(batch.column(1)):
            for row, text in enumerate(texts, first):
                words = Words([text], ALNUM)
                n = len(words.starts)
                if not n:
                    continue
                size = min(n, window)
                at, values, _ = _fingerprints(words.hashes(), size, gram, window)
                for i, value in zip(at.tolist(), values.view(np.int64).tolist()):
                    mark = _mark(words, i, 0, n, size, gram, window)
                    rows.append({"item": items[row], "hash": value, **mark})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))


def _document_marks(gram: int, window: int, sizes: list[int], bits, batches):
    """Per document the number of words, and the fingerprints that the bit table knows."""
    table = bits.value
    mask = np.uint64(len(table) * 64 - 1)
    for batch in batches:
        counts, found = [], []
        for _, texts in groups(batch.column(2)):
            words = Words(texts, ALNUM)
            hashes = words.hashes()
            counts.extend(np.diff(words.first).tolist())
            marks = [[] for _ in texts]
            for size in sizes:
                at, values, length = _fingerprints(hashes, size, gram, window)
                slot = values & mask
                known = (table[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)
                at = at[known.astype(bool)]
                owner = np.searchsorted(words.first, at, "right") - 1
                for i, d in zip(at.tolist(), owner.tolist()):
                    if i + length <= words.first[d + 1]:
                        marks[d].append(_mark(words, i, int(words.first[d]), int(words.first[d + 1]),
                                              size, gram, window))
            found.extend(marks)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
             pa.array(found, pa.list_(pa.struct(_MARK)))],
            names=["id", "text_hash", "n_words", "marks"],
        )


def _bit_table(items: DataFrame) -> np.ndarray:
    """The bit table over the item fingerprints; at most ``MOST_BITS`` / 8 bytes reach the driver."""
    want = 64 * max(1, items.count())
    bits = min(MOST_BITS, max(1 << 16, 1 << (want - 1).bit_length()))
    slot = F.col("hash").bitwiseAND(F.lit(bits - 1))
    filled = (
        items.select(F.shiftright(slot, 6).alias("word"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).collect()
    )
    table = np.zeros(bits // 64, dtype=np.int64)
    for row in filled:
        table[row["word"]] = row["bits"]
    return table.view(np.uint64)


def _common(a: Column, b: Column) -> Column:
    """How many leading elements two arrays share."""
    first_other = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False))
    return F.when(first_other > 0, first_other - 1).otherwise(F.greatest(F.size(a), F.size(b)))


def contamination(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
) -> DataFrame:
    """One row per document: ``id``, ``text_hash``, ``n_words``, ``spans``, ``items``.

    ``spans`` are the extended matches as (start, end) in words; a match is extended as far
    as a window around its fingerprint reaches, so overlapping ones make up a longer run.
    ``items`` are the distinct ids of the items they come from, sorted as strings.
    """
    spark = docs.sparkSession
    source = items.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.col(item_text_col).cast("binary").alias("text"),
    )
    marked = written(
        source.mapInArrow(functools.partial(_item_marks, gram, window), f"item STRING, hash BIGINT, {_MARK_DDL}"),
        "items",
    )
    sizes = sorted(r[0] for r in marked.select("size").distinct().collect())  # at most ``window``
    bits = spark.sparkContext.broadcast(_bit_table(marked))
    fingerprints = written(
        docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                    F.col(text_col).cast("binary").alias("text"))
        .mapInArrow(
            functools.partial(_document_marks, gram, window, sizes, bits),
            T.StructType([
                T.StructField("id", docs.schema[id_col].dataType), T.StructField("text_hash", T.LongType()),
                T.StructField("n_words", T.LongType()),
                T.StructField("marks", T.ArrayType(T.StructType.fromDDL(_MARK_DDL))),
            ]),
        ),
        "fingerprints",
    )
    mine = fingerprints.select("id", "text_hash", F.explode("marks").alias("m")).select(
        "id", "text_hash", *(F.col(f"m.{c}").alias(c) for c in ("size", "pos", "gram", "left", "right")))
    theirs = marked.select("item", "size", "gram", F.col("left").alias("item_left"), F.col("right").alias("item_right"))
    before, after = _common(F.col("left"), F.col("item_left")), _common(F.col("right"), F.col("item_right"))
    length = F.when(F.col("size") == window, F.lit(gram)).otherwise(F.col("size"))
    hits = (
        mine.join(theirs, ["size", "gram"])
        .select("id", "text_hash", "item", "size", (F.col("pos") - before).cast("int").alias("start"),
                (F.col("pos") + length + after).cast("int").alias("end"))
        .where(F.col("end") - F.col("start") >= F.col("size"))
        .groupBy("id", "text_hash")
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"), F.collect_set("item").alias("items"))
    )
    f, h = fingerprints.drop("marks").alias("f"), hits.alias("h")
    same = F.col("f.id").eqNullSafe(F.col("h.id")) & F.col("f.text_hash").eqNullSafe(F.col("h.text_hash"))
    return f.join(h, same, "left").select(
        "f.id", "f.text_hash", "n_words",
        F.coalesce(F.sort_array("spans"), F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce(F.sort_array("items"), F.array().cast("array<string>")).alias("items"),
    )


def hit_words(spans: Column) -> Column:
    """How many different words the spans cover."""
    covered = F.transform(spans, lambda s: F.sequence(s["start"], s["end"] - 1))
    return F.size(F.array_distinct(F.flatten(covered))).cast("bigint")


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one word in twenty lies in a shared window."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def decontaminated(docs: DataFrame, items: DataFrame, **columns) -> DataFrame:
    """``docs`` without the contaminated rows; all columns stay as they are."""
    id_col, text_col = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    found = contamination(docs, items, **columns)
    bad = written(
        found.where(is_contaminated(hit_words(F.col("spans")), F.col("n_words")))
        .select(F.col("id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct(),
        "contaminated",
    )
    same = F.col(id_col).eqNullSafe(F.col("_bad_id")) & F.xxhash64(text_col).eqNullSafe(F.col("_bad_hash"))
    return docs.join(bad, same, "left_anti")

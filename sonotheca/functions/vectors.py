"""Vector expressions: the offline embedder, pooling of raw model output, distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sonotheca.fixed_values import EMBEDDING_DIM
from sonotheca.functions.text import _col, let

_WORD_BREAK = r"[^\p{L}\p{Nd}]+"


def words(text: Column | str) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(_col(text)), _WORD_BREAK, -1), "")


def word_bucket(word: Column, dim: int = EMBEDDING_DIM) -> Column:
    """Bucket of a word: the first 8 hex digits of its md5, modulo ``dim``."""
    number = F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(F.pmod(number, F.lit(dim)).cast("int"), F.lit(0))


def bucket_counts(buckets: Column, dim: int = EMBEDDING_DIM) -> Column:
    """How often each bucket ``0 .. dim-1`` occurs, as a dense array.

    Every bucket is added once and the whole sorted, so the runs appear in bucket
    order and the distance between two run ends is a count plus one.  The work is
    one sort of the row's own words: no shuffle, no per-bucket rescan.
    """
    ordered = F.sort_array(F.concat(buckets, F.sequence(F.lit(0), F.lit(dim - 1))))

    def run_ends(values: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(0), F.size(values) - 1),
            lambda i: ~F.get(values, i).eqNullSafe(F.get(values, i + 1)),
        )

    def gaps(ends: Column) -> Column:
        previous = F.slice(F.concat(F.array(F.lit(-1)), ends), 1, dim)
        return F.zip_with(ends, previous, lambda end, start: end - start - 1)

    return let(ordered, lambda values: let(run_ends(values), gaps))


def unit_length(counts: Column) -> Column:
    """Integer counts scaled to Euclidean length 1; all zeros stay zeros."""
    def scaled(v: Column) -> Column:
        squares = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
        length = F.sqrt(F.greatest(squares, F.lit(1.0)))
        return let(length, lambda n: F.transform(v, lambda x: x / n))

    return let(counts, scaled)


def hashed_words(text: Column | str, dim: int = EMBEDDING_DIM) -> Column:
    """The offline embedding: word counts hashed into ``dim`` buckets, unit length.

    It finds shared words, not shared meaning.  Use it for tests and as a
    stand-in until a real model is plugged in.
    """
    buckets = F.transform(words(text), lambda w: word_bucket(w, dim))
    return unit_length(bucket_counts(buckets, dim))


def mean_vector(tokens: Column) -> Column:
    """Mean over an array of equally long vectors, in one pass."""
    def averaged(rows: Column) -> Column:
        zero = F.transform(F.get(rows, 0), lambda x: F.lit(0.0))
        total = F.aggregate(rows, zero, lambda acc, v: F.zip_with(acc, v, lambda a, b: a + b))
        return F.transform(total, lambda x: x / F.size(rows))

    return let(tokens.cast("array<array<double>>"), averaged)


def squared_distance(a: Column | str, b: Column | str) -> Column:
    """Squared Euclidean distance of two vectors."""
    squares = F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares.cast("array<double>"), F.lit(0.0), lambda acc, x: acc + x)

"""Texts to vectors: the embedder as a swap point, and pooling of raw model output."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonotheca.fixed_values import EMBEDDING_DIM
from sonotheca.functions.vectors import hashed_words, mean_vector, word_bucket, words


class Embedder:
    """A named way to turn a text column into a vector column.

    The name is stored with every vector, so that queries can be checked against
    the model that filled the store.  With ``may_fail`` the column is a struct of
    ``embedding`` and ``error``.  ``rows`` is an optional other way to the same vectors: it
    adds them as ``embedding`` to a table, given the name of its text column.
    """

    def __init__(self, name: str, column: Callable[[Column], Column], may_fail: bool = False,
                 rows: Callable[[DataFrame, str], DataFrame] | None = None):
        self.name = name
        self.column = column
        self.may_fail = may_fail
        self.rows = rows


def _with_hashed_words(df: DataFrame, text: str, dim: int) -> DataFrame:
    """``hashed_words`` as ``embedding``; the counts are those of Spark ML, which are quicker than array functions."""
    buckets = F.transform(words(text), lambda w: word_bucket(w, dim).cast("string"))
    given = df.withColumn("_buckets_of_words", F.coalesce(buckets, F.array().cast("array<string>")))
    counts = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(dim)], inputCol="_buckets_of_words", outputCol="_counts_of_words")
    unit = Normalizer(p=2.0, inputCol="_counts_of_words", outputCol="_unit_of_words")
    made = unit.transform(counts.transform(given))
    vector = F.when(F.col(text).isNotNull(), vector_to_array("_unit_of_words"))
    return made.withColumn("embedding", vector).drop("_buckets_of_words", "_counts_of_words", "_unit_of_words")


def offline_embedder(dim: int = EMBEDDING_DIM) -> Embedder:
    """The native default: hashed word counts, no model file and no Python worker."""
    return Embedder(f"hashed-words-{dim}", lambda text: hashed_words(text, dim),
                    rows=lambda df, text: _with_hashed_words(df, text, dim))


def _pooled(raw: object) -> list[float]:
    """One raw model output to one vector, by its number of dimensions."""
    values = np.asarray(raw, dtype=float)
    if values.ndim == 3:
        values = values[0]
    if values.ndim == 2:
        values = values.mean(axis=0)
    if values.ndim != 1:
        raise ValueError(f"cannot pool model output of shape {values.shape}")
    return values.tolist()


def model_embedder(name: str, load: Callable[[], Callable[[list[str]], list]]) -> Embedder:
    """An embedder around a model.

    ``load()`` runs once per task and returns a function from a list of texts to
    one raw output per text, each with 1, 2 or 3 dimensions.  Where it fails on a
    list, its texts are tried one by one, and a text that fails alone has an
    ``error`` instead of a vector.
    """

    def one(model: Callable, text: str) -> tuple:
        try:
            (raw,) = model([text])
            return _pooled(raw), None
        except Exception as problem:  # one bad text must not end the batch
            return None, str(problem) or type(problem).__name__

    def every(model: Callable, texts: list) -> list[tuple]:
        try:
            outputs = [(_pooled(raw), None) for raw in model(texts)]
        except Exception:
            outputs = []
        return outputs if len(outputs) == len(texts) else [one(model, text) for text in texts]

    @F.pandas_udf("embedding array<double>, error string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for texts in batches:
            outputs = every(model, texts.tolist()) if len(texts) else []
            yield pd.DataFrame(outputs, columns=["embedding", "error"], index=texts.index, dtype="object")

    return Embedder(name, run, may_fail=True)


def embed(df: DataFrame, text: str = "document", embedder: Embedder | None = None) -> DataFrame:
    """Adds ``embedding``, ``model`` and ``embed_error``; an empty input gives an empty output.

    A text that the model refuses has no vector but an error.  Write the result once
    before using it twice: every use runs the model again.
    """
    chosen = embedder or offline_embedder()
    if not chosen.may_fail:
        error = F.lit(None).cast("string")
        if chosen.rows is not None:
            return chosen.rows(df, text).withColumns({"model": F.lit(chosen.name), "embed_error": error})
        vector = chosen.column(F.col(text))
        return df.withColumns({"embedding": vector, "model": F.lit(chosen.name), "embed_error": error})
    return df.withColumn("_made", chosen.column(F.col(text))).withColumns({
        "embedding": F.col("_made.embedding"), "model": F.lit(chosen.name), "embed_error": F.col("_made.error"),
    }).drop("_made")


def pool(raw: Column | str, ndim: int) -> Column:
    """Raw model output to one vector of doubles.

    One dimension passes through, two are averaged over the tokens, of three only
    the first batch item counts.  The result is not scaled to unit length.
    """
    value = F.col(raw) if isinstance(raw, str) else raw
    if ndim == 1:
        return value.cast("array<double>")
    if ndim == 2:
        return mean_vector(value)
    if ndim == 3:
        return mean_vector(F.get(value, F.lit(0)))
    raise ValueError(f"cannot pool model output with {ndim} dimensions")


def pool_rows(tokens: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Pooling for token vectors stored one per row: the mean vector of every key.

    The mean is accumulated per task before the shuffle, one vector per key.
    """
    values = array_to_vector(F.col(vector).cast("array<double>"))
    return tokens.groupBy(key).agg(
        vector_to_array(Summarizer.mean(values)).alias("embedding"), F.count("*").alias("tokens")
    )

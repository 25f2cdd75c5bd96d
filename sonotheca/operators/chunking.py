"""Transcripts to chunk rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonotheca.fixed_values import CHUNK_OVERLAP, CHUNK_SIZE
from sonotheca.functions.text import chunk_id, chunk_text, non_blank, split_sentences


def sentences(transcripts: DataFrame, text: str = "text") -> DataFrame:
    """One row per sentence, with its position; the text itself is not repeated."""
    others = [c for c in transcripts.columns if c != text]
    return transcripts.select(
        *others, F.posexplode(split_sentences(text)).alias("sentence_ix", "sentence")
    )


def chunk_transcripts(
    transcripts: DataFrame, name: str = "file", text: str = "text",
    chunk_size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """Chunk rows ``id, chunk_ix, document`` plus every other input column.

    Blank transcripts give no rows.  Columns such as the episode metadata ride
    along, so attaching them needs no join and nothing here is shuffled.
    """
    others = [c for c in transcripts.columns if c != text]
    exploded = transcripts.filter(non_blank(text)).select(
        *others,
        F.posexplode(chunk_text(text, chunk_size, overlap)).alias("chunk_ix", "document"),
    )
    return exploded.withColumn("id", chunk_id(name, "chunk_ix"))


def chunks_per_file(chunks: DataFrame, name: str = "file") -> DataFrame:
    return chunks.groupBy(name).agg(F.count("*").alias("chunks"))

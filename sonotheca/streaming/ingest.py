"""The same update as a stream over landed transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sonotheca.operators.embedding import Embedder
from sonotheca.operators.store import allot_batch
from sonotheca.plans.batch import store_transcripts
from sonotheca.sources.feeds import file_stem


def stream_transcript_files(spark: SparkSession, folder: str) -> DataFrame:
    """``stem, text`` of the ``*.txt`` files that land in a folder, as a stream."""
    texts = (
        spark.readStream.schema("value STRING")
        .option("wholetext", True)
        .option("pathGlobFilter", "*.txt")
        .text(folder)
    )
    return texts.select(
        file_stem(F.col("_metadata.file_name")).alias("stem"), F.col("value").alias("text")
    )


def ingest_batch(
    landed: DataFrame, batch_seq: int, root: str, episodes: DataFrame,
    embedder: Embedder | None = None,
) -> None:
    """Store one micro-batch under its own number, so that a replay replaces itself.

    Every transcript with an episode record is stored, whatever its date: one dated at
    or before the mark, or not at all, only moves no mark.  Those without record are
    kept as failures, in the collection they landed for, else in the default one "".
    """
    key = [c for c in ("collection", "stem") if c in landed.columns]
    known = landed.join(episodes, key, "left").withColumn(
        "error", F.when(F.col("metadata").isNull(), F.lit("Metadata record not found"))
    )
    named = known.withColumn("collection", F.coalesce("collection", F.lit("")))
    store_transcripts(landed.sparkSession, root, named, batch_seq, embedder)


def stream_ingest(
    landed: DataFrame, root: str, episodes: DataFrame, checkpoint: str,
    embedder: Embedder | None = None,
) -> StreamingQuery:
    """Start ingesting what has landed; the query ends when it has caught up.

    ``landed`` is a stream of ``stem, text``, and ``collection`` where stems of several
    feeds may be equal; ``episodes`` holds ``stem, collection, audio_url, metadata,
    published_ts``, once per key.  The store allots the batch numbers, and a micro-batch
    repeated after a crash gets the number it had.
    """

    def ingest(batch: DataFrame, batch_id: int) -> None:
        seq = allot_batch(batch.sparkSession, root, f"{checkpoint}#{batch_id}")
        ingest_batch(batch, seq, root, episodes, embedder)

    return (
        landed.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(ingest)
        .start()
    )

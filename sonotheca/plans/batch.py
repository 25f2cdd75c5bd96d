"""Runs: from feed items to stored chunks and an advanced mark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonotheca.fixed_values import CHUNK_OVERLAP, CHUNK_SIZE, EPISODES_PER_RUN
from sonotheca.functions.text import non_blank, safe_title
from sonotheca.operators.chunking import chunk_transcripts
from sonotheca.operators.embedding import Embedder, embed, offline_embedder
from sonotheca.operators.feed import (
    accept_fetch,
    enrich_from_catalogue,
    episode_record,
    in_steps,
    new_since,
    oldest_first,
    with_audio,
)
from sonotheca.operators.ranking import first_per
from sonotheca.operators.store import (
    advance_mark,
    allot_batch,
    as_metadata,
    compact_when_due,
    failed_items,
    moved_marks,
    read_handled,
    read_marks,
    register_collections,
    upsert,
    write_failures,
    write_handled,
    write_marks,
    write_selected,
)
from sonotheca.operators.transcripts import attach_sidecar, transcribe_directory
from sonotheca.schemas import CATALOGUE
from sonotheca.session import fresh_dir, spread, written
from sonotheca.sources.files import read_sidecars, read_transcripts

NO_AUDIO = "No audio link"
COMPACT_EVERY = 50


def select_items(
    spark: SparkSession, root: str, items: DataFrame, batch_seq: int,
    n: int | None = EPISODES_PER_RUN, with_ties: bool = False, retry_failed: bool = False,
    since: int | None = None,
) -> DataFrame:
    """The items of a run: new ones per feed, oldest first, and optionally earlier failures.

    With ``since`` the marks are those before that batch, and items that a run handled
    since then are left out, whatever came of them.
    """
    marks = read_marks(spark, root, before=batch_seq if since is None else since)
    new = new_since(items, marks.withColumnRenamed("collection", "feed_id"))
    if since is not None:
        tried = read_handled(spark, root).filter(F.col("batch_seq").between(since, batch_seq - 1))
        new = _untried(new, tried)
    chosen = oldest_first(new, n, per="feed_id", with_ties=with_ties)
    if not retry_failed:
        return chosen
    open_work = failed_items(spark, root).select(
        F.col("collection").alias("feed_id"), F.col("stem").alias("_stem")
    )
    again = (
        items.withColumn("_stem", safe_title("title"))
        .join(open_work, ["feed_id", "_stem"], "left_semi")
        .drop("_stem")
    )
    return chosen.unionByName(again).dropDuplicates(["feed_id", "feed_pos"])


def _untried(items: DataFrame, tried: DataFrame) -> DataFrame:
    """The items without a record of the same feed, stem and date in ``tried``."""
    done = tried.select(F.col("collection").alias("feed_id"), F.col("stem").alias("_stem"), "published_ts").distinct()
    named = items.withColumn("_stem", safe_title("title"))
    return named.join(done, ["feed_id", "_stem", "published_ts"], "left_anti").select(*items.columns)


def prepare_episodes(
    items: DataFrame, fetch_log: DataFrame | None = None, catalogue: DataFrame | None = None,
    show_name: str | None = None,
) -> DataFrame:
    """Items with audio to ``collection, stem, audio_url, metadata, published_ts, error``.

    Items without audio link are skipped.  ``error`` is set where the fetch log does
    not hold an accepted response for the address.
    """
    episodes = with_audio(items).withColumn("podcast", F.col("feed_title"))
    if catalogue is None:
        catalogue = items.sparkSession.createDataFrame([], CATALOGUE)
    known = enrich_from_catalogue(episodes, catalogue, show_name)
    record = episode_record(known, ["feed_id", "published_ts"])
    made = record.select(
        F.col("feed_id").alias("collection"), safe_title("title").alias("stem"), "audio_url",
        as_metadata().alias("metadata"), "published_ts",
    )
    if fetch_log is None:
        return made.withColumn("error", F.lit(None).cast("string"))
    # One row per address: any accepted response will do.
    outcomes = accept_fetch(fetch_log).groupBy("audio_url").agg(
        F.bool_or(F.col("outcome") == "ok").alias("_ok"), F.min("outcome").alias("_outcome")
    )
    joined = made.join(outcomes, "audio_url", "left")
    refused = F.concat(F.lit("Fetch failed: "), F.coalesce("_outcome", F.lit("no_response")))
    return joined.withColumn("error", F.when(~F.coalesce("_ok", F.lit(False)), refused)).drop(
        "_ok", "_outcome"
    )


def landed_transcripts(texts: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Transcribe by looking texts up: ``texts`` holds ``collection, stem, text``, once per key.

    The texts are first cut down to the episodes of the run.  Few episodes are
    broadcast for that and the texts stay where they are; many are joined by key,
    and the second join then finds its input partitioned already.
    """
    key = ["collection", "stem"]

    def look_up(episodes: DataFrame) -> DataFrame:
        wanted = texts.select(*key, "text").join(episodes.select(*key), key, "left_semi")
        found = episodes.join(wanted, key, "left")
        missing = F.when(F.col("text").isNull(), F.lit("No transcript"))
        return found.withColumn("error", F.coalesce("error", missing))

    return look_up


def transcribed_recordings(recordings: DataFrame, transcriber: Callable[..., dict], **options) -> Callable[[DataFrame], DataFrame]:
    """Transcribe by running a user's function over the recordings of the episodes of a run.

    ``recordings`` holds ``audio_url, path, length, duration`` and what ``payload`` names,
    once per address.  Only recordings of episodes without error are sent.
    """

    def run(episodes: DataFrame) -> DataFrame:
        wanted = episodes.filter(F.col("error").isNull()).select("audio_url").distinct()
        chosen = recordings.join(wanted, "audio_url", "left_semi")
        results = transcribe_directory(chosen.drop("audio_url"), transcriber, **options).select(
            F.col("file").alias("path"), "text", F.col("error").alias("_failed"))
        found = recordings.select("audio_url", "path").join(results, "path").drop("path")
        missing = F.when(F.col("text").isNull(), F.coalesce("_failed", F.lit("No recording")))
        return episodes.join(found, "audio_url", "left").withColumn("error", F.coalesce("error", missing)).drop("_failed")

    return run


def one_per_stem(texts: DataFrame) -> DataFrame:
    """One row per ``collection, stem``: the latest published wins, then the greater address, then text.

    Two episodes of one stem share a file, so one of them wins whole.  Only the rows of
    contested stems are ranked; all others stay where they are.
    """
    key = ["collection", "stem"]
    contested = written(texts.groupBy(*key).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n"), "contested")
    order = [F.col("published_ts").desc_nulls_last(), F.col("audio_url").desc_nulls_last(), F.col("text").desc()]
    winners = first_per(texts.join(contested, key, "left_semi"), key, order)
    return texts.join(contested, key, "left_anti").unionByName(winners.select(*texts.columns))


def store_transcripts(
    spark: SparkSession, root: str, handled: DataFrame, batch_seq: int,
    embedder: Embedder | None = None, chunk_size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
) -> None:
    """Record, chunk, embed and upsert transcripts, then move the marks.

    ``handled`` holds ``collection, stem, audio_url, metadata, published_ts, text,
    error``.  It is written first, and everything after reads that table, so an
    expensive source is evaluated once; so is the embedding.  A transcript with a chunk
    that the model refuses is a failure: nothing of it is stored and it moves no mark.
    The marks come last: a crash before them repeats the batch, which the keyed store
    makes harmless.
    """
    chosen = embedder or offline_embedder()
    blank = ~F.coalesce(non_blank("text"), F.lit(False))
    recorded = write_handled(handled.withColumn("blank", blank), root, batch_seq)
    good = recorded.filter(F.col("error").isNull() & ~F.col("blank"))

    register_collections(spark, root, good, chosen.name)
    texts = spread(one_per_stem(good).select(
        "collection", "stem", F.concat("stem", F.lit(".txt")).alias("file"), "text", "metadata"))
    chunks = embed(chunk_transcripts(texts, chunk_size=chunk_size, overlap=overlap), "document", chosen)
    if chosen.may_fail:
        chunks = written(chunks, "embedded")
    failures = chunks.filter(F.col("embed_error").isNotNull()).groupBy("collection", "stem").agg(
        F.min_by("embed_error", "chunk_ix").alias("failure"))
    failed = write_failures(failures, root, batch_seq)
    kept = chunks.join(failed, ["collection", "stem"], "left_anti") if chosen.may_fail else chunks
    upsert(spark, root, kept, batch_seq)

    stored = good.join(failed, ["collection", "stem"], "left_anti").select("collection", "published_ts")
    marks = read_marks(spark, root, before=batch_seq)
    write_marks(spark, root, moved_marks(advance_mark(stored, marks), marks), batch_seq)


def store_folder(
    spark: SparkSession, root: str, folder: str, collection: str, embedder: Embedder | None = None,
    batch_seq: int | None = None, recursive: bool = False,
) -> DataFrame:
    """Store every transcript of a folder with its metadata record; items per outcome.

    ``*.txt`` files are transcripts, the ``*.json`` file of the same stem is the record.
    A transcript without record is a failure of its own; a blank one is passed over.
    An undated one is stored and moves no mark.  ``recursive`` takes the files of sub-folders too;
    stems are still unique in the whole folder.
    """
    seq = allot_batch(spark, root) if batch_seq is None else batch_seq
    known = attach_sidecar(read_transcripts(spark, folder, recursive), read_sidecars(spark, folder, recursive))
    store_transcripts(spark, root, known.select(
        F.lit(collection).alias("collection"), "stem", F.col("metadata.audio_url").alias("audio_url"), "metadata",
        F.try_to_timestamp("metadata.published_date").alias("published_ts"), "text", "error"), seq, embedder)
    return run_summary(spark, root, seq)


def run_batch(
    spark: SparkSession, root: str, items: DataFrame,
    transcripts: Callable[[DataFrame], DataFrame], batch_seq: int | None = None,
    n: int | None = EPISODES_PER_RUN, with_ties: bool = False, retry_failed: bool = False,
    fetch_log: DataFrame | None = None, catalogue: DataFrame | None = None,
    show_name: str | None = None, embedder: Embedder | None = None,
    since: int | None = None, compact_every: int | None = COMPACT_EVERY, is_chosen: bool = False,
) -> DataFrame:
    """One incremental update; returns items per collection and outcome.

    ``items`` are feed entries whose feed is the collection they go to.
    ``transcripts`` adds ``text`` to the episodes and may set ``error``.  Passing the
    ``batch_seq`` of an earlier run replays that run.  ``is_chosen`` takes all of ``items``,
    a table that a backfill has planned.  It, and ``since`` (see ``select_items``), also record
    the items without audio, so that they count as tried.  The store is compacted after every
    ``compact_every`` runs.
    """
    seq = allot_batch(spark, root) if batch_seq is None else batch_seq
    chosen = items if is_chosen else select_items(spark, root, items, seq, n, with_ties, retry_failed, since)
    if since is not None:
        chosen = written(chosen, "chosen")
    prepared = prepare_episodes(chosen, fetch_log, catalogue, show_name)
    episodes = write_selected(prepared, root, seq)
    handled = transcripts(episodes)
    if since is not None or is_chosen:
        handled = handled.unionByName(_without_audio(chosen), allowMissingColumns=True)
    store_transcripts(spark, root, handled, seq, embedder)
    compact_when_due(spark, root, compact_every)
    return run_summary(spark, root, seq)


def _without_audio(items: DataFrame) -> DataFrame:
    """The items that ``prepare_episodes`` passes over, as failures."""
    key = ["feed_id", "feed_pos"]
    silent = items.join(with_audio(items).select(*key), key, "left_anti")
    return silent.select(F.col("feed_id").alias("collection"), safe_title("title").alias("stem"),
                         "published_ts", F.lit(NO_AUDIO).alias("error"))


def run_summary(spark: SparkSession, root: str, batch_seq: int) -> DataFrame:
    outcome = (
        F.when(F.col("error").isNotNull(), "failed").when(F.col("blank"), "blank").otherwise("stored")
    )
    done = read_handled(spark, root, batch_seq)
    return done.groupBy("collection", outcome.alias("outcome")).agg(F.count("*").alias("items"))


def backfill(
    spark: SparkSession, root: str, items: DataFrame,
    transcripts: Callable[[DataFrame], DataFrame], n: int | None = None, **options,
) -> int:
    """Run until no untried item is left; returns the number of runs that handled something.

    Items are new by the marks before the first run.  Without ``n`` one run takes
    everything.  With ``n`` the runs go oldest first, ``n`` items of each feed at a time, and
    items of one date are taken together.  Which run takes an item is settled once for all of
    them, in a table of the new items that is partitioned by run; each run reads its own rows
    only.  Items without audio, failed fetches and blank transcripts are recorded and block
    nothing.
    """
    path = fresh_dir(spark, "schedule")
    new = new_since(items, read_marks(spark, root).withColumnRenamed("collection", "feed_id"))
    planned = new.withColumn("step", F.lit(0)) if n is None else in_steps(new, n)
    planned.select(*items.columns, "step").write.partitionBy("step").parquet(path)
    schedule = spark.read.schema(T.StructType([*items.schema.fields, T.StructField("step", T.IntegerType())])).parquet(path)
    last = schedule.agg(F.max("step")).first()[0]
    steps = 0 if last is None else last + 1
    for step in range(steps):
        run_batch(spark, root, schedule.filter(F.col("step") == step).drop("step"), transcripts, is_chosen=True, **options)
    return steps

"""The update as a stream of landed feeds, with the mark of each feed as keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from sonotheca.fixed_values import DEFAULT_MARK
from sonotheca.operators.store import allot_batch, read_marks
from sonotheca.plans.batch import run_batch
from sonotheca.schemas import FEED_ITEMS
from sonotheca.sources.feeds import channel_reader, entries_of

_ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Marks(StatefulProcessor):
    """Passes on the entries of a feed that are dated after its mark, each once, and moves the mark."""

    def __init__(self, default: int):
        self.default = default

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mark = handle.getValueState("mark", "micros BIGINT")

    def handleInitialState(self, key, initial: pd.DataFrame, timers) -> None:
        self.mark.update((int(initial["micros"].max()),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        mark = self.mark.get()[0] if self.mark.exists() else self.default
        reached, passed = mark, set()
        for some in rows:
            new = some[some["micros"] > mark].drop_duplicates("entry")
            new = new[~new["entry"].isin(passed)]
            if len(new):
                passed.update(new["entry"])
                reached = max(reached, int(new["micros"].max()))
                yield new[["item"]]
        if reached > mark:
            self.mark.update((reached,))

    def close(self) -> None:
        pass


def new_entries(entries: DataFrame, marks: DataFrame) -> DataFrame:
    """The stream of entries that are dated strictly after the mark of their feed.

    ``entries`` is a stream of feed items; a feed that lands again lists its old entries once
    more.  ``marks`` holds ``collection, published_ts`` as the state to begin with; it is read
    when the query first starts, and from then on the state is in the query's checkpoint.  A
    feed without mark begins at the default.  Undated entries and those dated at or before the
    mark are dropped, and an entry that several files of one micro-batch hold passes once.
    The state of a feed is one number, however many entries it has.
    """
    spark = entries.sparkSession
    default = spark.range(1).select(F.unix_micros(F.lit(DEFAULT_MARK).cast("timestamp"))).first()[0]
    names = FEED_ITEMS.fieldNames()
    micros = F.unix_micros(F.col("published_ts").cast("timestamp")).alias("micros")
    # an item travels as one text; where it stands in the feed does not make it another entry
    same = F.xxhash64("title", "published_ts", F.to_json("links")).alias("entry")
    keyed = entries.where("published_ts IS NOT NULL").select("feed_id", micros, same, F.to_json(F.struct(*names)).alias("item"))
    begun = marks.where("published_ts IS NOT NULL").select(F.col("collection").alias("feed_id"), micros)
    passed = keyed.groupBy("feed_id").transformWithStateInPandas(
        statefulProcessor=_Marks(default), outputStructType="item STRING", outputMode="Append", timeMode="None",
        initialState=begun.groupBy("feed_id"))
    return passed.select(F.from_json("item", FEED_ITEMS).alias("item")).select("item.*")


def stream_feeds(
    entries: DataFrame, root: str, transcripts: Callable[[DataFrame], DataFrame], checkpoint: str, **options,
) -> StreamingQuery:
    """Store what is new in the feeds that have landed; the query ends when it has caught up.

    Every micro-batch is one ``run_batch`` over the new entries, all of them; ``options`` are
    those of ``run_batch``.  How much a micro-batch takes is up to the source, for example its
    ``maxFilesPerTrigger``.  The marks of the store are the state to begin with.  A stream that is
    started again goes on where it stopped: its marks and the files it has seen are in the
    checkpoint, and a micro-batch repeated after a crash gets the number it had and replaces
    what it wrote.  An item that fails is recorded as such and left to a run with
    ``retry_failed``; the stream passes every entry on once.
    """
    spark = entries.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS_DB)

    def store(items: DataFrame, batch_id: int) -> None:
        seq = allot_batch(items.sparkSession, root, f"{checkpoint}#{batch_id}")
        run_batch(items.sparkSession, root, items, transcripts, batch_seq=seq, n=None, **options)

    return (
        new_entries(entries, read_marks(spark, root)).writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .start()
    )


def stream_feed_files(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Feed items of the XML files that land in a folder, as a stream; a file is one snapshot of a feed."""
    return entries_of(channel_reader(spark.readStream).options(**options).load(folder))

"""When open items may be sent to the service: retries and rolling quotas acted on."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonotheca.fixed_values import (
    AUDIO_SECONDS_PER_DAY,
    AUDIO_SECONDS_PER_HOUR,
    MAX_ATTEMPTS,
    REQUESTS_PER_DAY,
    REQUESTS_PER_MINUTE,
)
from sonotheca.operators.ranking import first_per
from sonotheca.operators.service_log import retry_plan
from sonotheca.operators.transcripts import pending

DAY = 86400


@dataclass(frozen=True)
class Quotas:
    """Limits over rolling windows; audio in seconds."""

    requests_minute: int = REQUESTS_PER_MINUTE
    requests_day: int = REQUESTS_PER_DAY
    audio_hour: float = AUDIO_SECONDS_PER_HOUR
    audio_day: float = AUDIO_SECONDS_PER_DAY

    def windows(self) -> tuple[tuple[int, int, bool], ...]:
        """Width in seconds, limit, and whether the limit counts milliseconds of audio."""
        return ((60, self.requests_minute, False), (DAY, self.requests_day, False),
                (3600, round(self.audio_hour * 1000), True), (DAY, round(self.audio_day * 1000), True))


def open_items(
    items: DataFrame, attempts: DataFrame, done: DataFrame, max_attempts: int = MAX_ATTEMPTS,
) -> DataFrame:
    """Items without success, with ``ready_ts``, the time from which they may be sent, and ``action``.

    ``items`` holds ``item, account, audio_seconds, queued_ts``, one row each; ``attempts`` the
    failed calls ``item, service, attempt, error, ts``; ``done`` the items ``item, error`` of
    which one without error has succeeded.  A failed item waits as its latest attempt says; of
    several services the longest wait counts, and one that gives up ends the item.
    """
    plans = retry_plan(attempts, max_attempts)
    due = F.timestamp_seconds(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000 + F.col("wait_s"))
    waits = plans.groupBy("item").agg(
        F.max(due).alias("_due"), F.bool_or(F.col("action") == "give_up").alias("_ended"))
    queued = F.col("queued_ts").cast("timestamp")
    return (
        pending(items, done, "item").join(waits, "item", "left")
        .withColumn("ready_ts", F.greatest(queued, F.col("_due")))
        .withColumn("action", F.when(F.col("_ended"), "give_up").when(F.col("_due").isNotNull(), "retry").otherwise("first"))
        .drop("_due", "_ended")
    )


def _admit(windows, calls: pd.DataFrame, queue: pd.DataFrame) -> pd.DataFrame:
    """First come, first served: every item at the earliest second that keeps all windows within limits."""
    rings = [[deque(), 0] for _ in windows]
    clock = 0

    def sent(second: int, count: int, audio: int) -> None:
        for ring, (_, _, is_audio) in zip(rings, windows):
            ring[0].append((second, audio if is_audio else count))
            ring[1] += audio if is_audio else count

    for second, count, audio in calls.sort_values("second")[["second", "n", "audio_ms"]].itertuples(index=False):
        sent(int(second), int(count), int(audio))
        clock = int(second)
    seconds = []
    queue = queue.sort_values("place")
    for ready, audio in queue[["ready_s", "audio_ms"]].itertuples(index=False):
        clock = max(clock, int(ready))
        for ring, (width, limit, is_audio) in zip(rings, windows):
            while ring[0] and ring[1] + (audio if is_audio else 1) > limit:
                second, amount = ring[0].popleft()
                ring[1] -= amount
                clock = max(clock, second + width)
        sent(clock, 1, int(audio))
        seconds.append(clock)
    return queue.assign(send_s=pd.Series(seconds, index=queue.index, dtype="int64"))


def dispatch_plan(
    open_: DataFrame, calls: DataFrame, days: int = 1, quotas: Quotas | None = None,
) -> DataFrame:
    """One row per open item: its ``state``, and ``send_at`` if it is planned.

    ``open_`` holds ``item, account, audio_seconds, ready_ts, action``; ``calls`` the calls made so
    far, ``account, ts, audio_seconds``.  Items of an account go out in order of ``ready_ts``, then
    ``item``, none before the last call made, at the first whole second at which all four rolling
    quotas hold with them.  States are ``planned``; ``later`` for items that ``days`` full days of
    requests do not reach; ``give_up``; and ``too_long`` for recordings above a quota by
    themselves, which hold up nothing.

    A day admits a bounded number of requests, so only the first ``days`` times that many items of
    an account can be in a plan.  They are picked before anything is grouped, and the calls of the
    account's last day are summed by second, so the one task that replays an account holds no more
    than that, however large the account is.
    """
    rules = quotas or Quotas()
    if rules.requests_minute < 1 or rules.requests_day < 1:
        raise ValueError("a quota without requests admits nothing")
    audio_ms = F.coalesce(F.round(F.col("audio_seconds") * 1000), F.lit(0)).cast("bigint")
    ready = F.coalesce(F.ceil(F.unix_micros(F.col("ready_ts").cast("timestamp")) / 1_000_000), F.lit(0)).cast("bigint")
    longest = round(min(rules.audio_hour, rules.audio_day) * 1000)
    state = F.when(F.col("action") == "give_up", "give_up").when(F.col("audio_ms") > longest, "too_long")
    rows = open_.select("account", "item", audio_ms.alias("audio_ms"), ready.alias("ready_s"), "action").withColumn("state", state)
    waiting = rows.filter(F.col("state").isNull())
    queue = first_per(waiting, ["account"], [F.col("ready_s"), F.col("item")], days * rules.requests_day, rank_as="place")

    by_second = calls.groupBy("account", F.unix_seconds(F.col("ts").cast("timestamp")).alias("second")).agg(
        F.count("*").alias("n"), F.sum(audio_ms).alias("audio_ms"))
    last = by_second.groupBy("account").agg(F.max("second").alias("_last"))
    recent = by_second.join(last, by_second["account"].eqNullSafe(last["account"])).drop(last["account"]).filter(
        F.col("second") > F.col("_last") - DAY).drop("_last")

    windows = rules.windows()
    schema = T.StructType([rows.schema["account"], rows.schema["item"], T.StructField("send_s", T.LongType())])

    def admit(queued: pd.DataFrame, made: pd.DataFrame) -> pd.DataFrame:
        return _admit(windows, made, queued)[["account", "item", "send_s"]]

    # a null account is one like any other; a mark of its own keeps it apart from ""
    named = F.coalesce(F.concat(F.lit("1"), F.col("account").cast("string")), F.lit("0")).alias("_key")
    planned = (
        queue.select("*", named).groupBy("_key").cogroup(recent.select("*", named).groupBy("_key"))
        .applyInPandas(admit, schema)
    )
    found = rows.join(planned.withColumnRenamed("account", "_account"), "item", "left")
    return found.select(
        "account", "item", F.coalesce("state", F.when(F.col("send_s").isNotNull(), "planned"), F.lit("later")).alias("state"),
        "action", F.timestamp_seconds("ready_s").alias("ready_at"), F.timestamp_seconds("send_s").alias("send_at"))

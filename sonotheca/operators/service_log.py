"""Reports over the logs of the two model services: retries and quota use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonotheca.fixed_values import (
    AUDIO_SECONDS_PER_DAY,
    AUDIO_SECONDS_PER_HOUR,
    MAX_ATTEMPTS,
    REQUESTS_PER_DAY,
    REQUESTS_PER_MINUTE,
)
from sonotheca.functions.retry import error_class, retry_wait
from sonotheca.operators.ranking import first_per

_DAY = 86400


def retry_plan(attempts: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """For every failed item, from its latest attempt: class, wait and next action."""
    latest = first_per(
        attempts, ["item", "service"], [F.col("attempt").desc(), F.col("error").desc()]
    )
    give_up = F.col("attempt") >= max_attempts - 1
    return (
        latest.withColumn("error_class", error_class("service", "error"))
        .withColumn("wait_s", retry_wait("service", "error_class", "attempt", max_attempts))
        .withColumn("action", F.when(give_up, "give_up").otherwise("retry"))
    )


def quota_usage(calls: DataFrame) -> DataFrame:
    """Rolling use of the four quotas, one row per account and second with calls.

    Calls of one second see the same rolling windows, so they are summed up before
    anything is shuffled; from then on an account has at most one row per second.
    Each row is also placed in the following day as context.  A window then covers
    one account and two days, never the whole history of a busy account.

    A rolling sum is the running total up to now minus the one up to the start of
    the window.  Both only grow along the timeline, so each row is added once,
    while a moving frame would add up its rows again for every second.
    """
    seconds = (
        calls.groupBy("account", F.unix_seconds(F.col("ts").cast("timestamp")).alias("second"))
        .agg(F.count("*").alias("calls"), F.sum("audio_seconds").alias("audio_s"))
    )
    own_day = F.floor(F.col("second") / _DAY)
    placed = seconds.withColumn("_ahead", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "_day", own_day + F.col("_ahead")
    )
    timeline = Window.partitionBy("account", "_day").orderBy("second")

    def running(value: str, until: int) -> Column:
        return F.sum(value).over(timeline.rangeBetween(Window.unboundedPreceding, until))

    def rolling(value: str, width: int) -> Column:
        before = F.coalesce(running(value, -width), F.lit(0))
        total = running(value, 0) - before
        return F.round(total, 6) if value == "audio_s" else total

    used = (
        placed.withColumn("requests_minute", rolling("calls", 60))
        .withColumn("requests_day", rolling("calls", _DAY))
        .withColumn("audio_s_hour", rolling("audio_s", 3600))
        .withColumn("audio_s_day", rolling("audio_s", _DAY))
        .filter(F.col("_ahead") == 0)
        .drop("_ahead", "_day")
    )
    over = (
        (F.col("requests_minute") > REQUESTS_PER_MINUTE)
        | (F.col("requests_day") > REQUESTS_PER_DAY)
        | (F.col("audio_s_hour") > AUDIO_SECONDS_PER_HOUR)
        | (F.col("audio_s_day") > AUDIO_SECONDS_PER_DAY)
    )
    return used.withColumn("over_quota", over)

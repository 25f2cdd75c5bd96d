"""What a failed call means: its class, the wait, and whether to try again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sonotheca.fixed_values import (
    MAX_ATTEMPTS,
    MODEL_LOADING_WAIT_S,
    TRANSCRIBE_ERROR_WAIT_S,
    TRANSCRIBE_RATE_WAIT_S,
)
from sonotheca.functions.text import _col


def error_class(service: Column | str, error: Column | str) -> Column:
    """``loading`` (embedding only), ``rate`` or ``other``.

    ``rate`` is any text with these letters, so "generate" counts as well.
    """
    message = F.lower(_col(error))

    def has(part: str) -> Column:
        return F.contains(message, F.lit(part))

    loading = (_col(service) == "embedding") & (has("loading") | has("503"))
    return F.when(loading, "loading").when(has("rate") | has("429"), "rate").otherwise("other")


def retry_wait(
    service: Column | str, kind: Column | str, attempt: Column | str,
    max_attempts: int = MAX_ATTEMPTS,
) -> Column:
    """Seconds to wait after a failed attempt (counted from 0).

    Loading and rate limits wait even after the last attempt; other errors do not.
    """
    n, kind = _col(attempt), _col(kind)
    embedding = _col(service) == "embedding"
    doubling = F.pow(F.lit(2), n).cast("bigint")
    is_last = n >= max_attempts - 1
    return (
        F.when(kind == "loading", F.lit(MODEL_LOADING_WAIT_S).cast("bigint"))
        .when((kind == "other") & is_last, F.lit(0).cast("bigint"))
        .when(embedding, doubling)
        .when(kind == "rate", (n + 1).cast("bigint") * TRANSCRIBE_RATE_WAIT_S)
        .otherwise((n + 1).cast("bigint") * TRANSCRIBE_ERROR_WAIT_S)
    )

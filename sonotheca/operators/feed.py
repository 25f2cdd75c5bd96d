"""Feed side: which episodes are new, where their audio is, what is known about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonotheca.fixed_values import (
    CATALOGUE_CANDIDATES,
    DEFAULT_MARK,
    EPISODES_PER_RUN,
    HTML_SNIPPET_CHARS,
)
from sonotheca.functions.dates import published_iso
from sonotheca.functions.text import _col, strip
from sonotheca.operators.ranking import first_per


def read_mark(collections: DataFrame, marks: DataFrame, key: str = "collection") -> DataFrame:
    """One row per collection with its stored mark, or the default when there is none."""
    kind = marks.schema["published_ts"].dataType
    stored = marks.groupBy(key).agg(F.max("published_ts").alias("published_ts"))
    return collections.select(key).distinct().join(stored, key, "left").withColumn(
        "published_ts", F.coalesce("published_ts", F.lit(DEFAULT_MARK).cast(kind))
    )


def new_since(items: DataFrame, marks: DataFrame, key: str = "feed_id") -> DataFrame:
    """Dated items strictly after the mark of their feed; undated items are dropped.

    ``marks`` holds ``key`` and ``published_ts``; feeds without mark start at the default.  The
    items are read once, by a left join with the marks.  The earliest mark of all feeds bounds
    that read and reaches the scan as a pushed filter; whether a feed has none, so that the
    default bounds it, takes a look at the keys alone.
    """
    kind = items.schema["published_ts"].dataType
    stored = marks.groupBy(key).agg(F.max("published_ts").cast(kind).alias("_mark")).filter("_mark IS NOT NULL")
    return (
        items.filter(F.col("published_ts") > earliest_mark(items, stored, key).scalar()).join(stored, key, "left")
        .filter(F.col("published_ts") > F.coalesce("_mark", F.lit(DEFAULT_MARK).cast(kind))).select(*items.columns)
    )


def earliest_mark(items: DataFrame, stored: DataFrame, key: str = "feed_id") -> DataFrame:
    """One value: the earliest ``_mark`` that a feed of ``items`` starts at."""
    default = F.lit(DEFAULT_MARK).cast(items.schema["published_ts"].dataType)
    unmarked = items.select(key).join(stored, key, "left_anti").select(default.alias("_mark"))
    return stored.select("_mark").union(unmarked).agg(F.min("_mark"))


def in_steps(items: DataFrame, n: int, key: str = "feed_id") -> DataFrame:
    """Adds ``step``: the items of a feed oldest first, ``n`` to a step, equal dates in one step.

    The step follows from the number of strictly older items of the feed.  It is counted in
    two levels, per day and inside a day, over one row per date; so no task sees more of a feed
    than its days or the dates of one day, however many items it has.
    """
    dates = items.groupBy(key, "published_ts").agg(F.count("*").alias("_own")).withColumn("_day", F.to_date("published_ts"))
    days = dates.groupBy(key, "_day").agg(F.sum("_own").alias("_own"))

    def before(*partition: str, order: str) -> Column:
        window = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_own").over(window), F.lit(0))

    by_day = days.select(key, "_day", before(key, order="_day").alias("_days"))
    older = dates.withColumn("_inside", before(key, "_day", order="published_ts")).join(by_day, [key, "_day"])
    steps = older.select(key, "published_ts", F.floor((F.col("_days") + F.col("_inside")) / n).cast("int").alias("step"))
    return items.join(steps, [key, "published_ts"])


def oldest_first(
    items: DataFrame, n: int | None = EPISODES_PER_RUN, per: str | None = None,
    tie: str = "feed_pos", with_ties: bool = False,
) -> DataFrame:
    """The ``n`` oldest items, ties in feed order; over all items, or ``per`` feed.

    ``with_ties`` also keeps items dated exactly like the last one, which makes a
    backfill in steps complete.  ``n=None`` keeps everything.
    """
    if n is None:
        return items
    order = [F.col("published_ts").asc()] + ([] if with_ties else [F.col(tie).asc()])
    if per:
        return first_per(items, [per], order, n, with_ties)
    if not with_ties:
        return items.orderBy(*order).limit(n)
    newest_kept = items.orderBy(*order).limit(n).agg(F.max("published_ts")).scalar()
    return items.filter(F.col("published_ts") <= newest_kept)


def latest_item(items: DataFrame, key: str = "feed_id", pos: str = "feed_pos") -> DataFrame:
    """The first entry in feed order, whatever its date."""
    return first_per(items, [key], [F.col(pos).asc()])


def first_audio_link(links: Column | str) -> Column:
    """Address of the first link whose type starts with ``audio``, else null.

    A link without type is not audio, and an empty address counts as none.
    """
    audio = F.filter(_col(links), lambda link: F.startswith(link["type"], F.lit("audio")))
    return F.nullif(F.get(audio, F.lit(0))["href"], F.lit(""))


def with_audio(items: DataFrame, links: str = "links") -> DataFrame:
    """Items that have an audio link, with its address in ``audio_url``."""
    return items.withColumn("audio_url", first_audio_link(links)).filter("audio_url IS NOT NULL")


def first_audio_link_rows(
    links: DataFrame, key: str, pos: str, kind: str = "type", href: str = "href"
) -> DataFrame:
    """``first_audio_link`` for links stored one per row; no group is ever collected."""
    best = (
        links.filter(F.startswith(F.col(kind), F.lit("audio")))
        .groupBy(key)
        .agg(F.min_by(href, pos).alias("audio_url"))
    )
    return best.filter(F.col("audio_url") != "")


def fetch_outcome(status: str = "status", content_type: str = "content_type") -> Column:
    """``ok``, ``http_error``, ``html`` or ``no_response``."""
    is_html = F.contains(F.lower(F.coalesce(_col(content_type), F.lit(""))), F.lit("text/html"))
    return (
        F.when(_col(status).isNull(), "no_response")
        .when(_col(status).between(400, 599), "http_error")
        .when(is_html, "html")
        .otherwise("ok")
    )


def accept_fetch(fetch_log: DataFrame) -> DataFrame:
    """The log with ``outcome``, and the head of web pages kept for diagnosis."""
    outcome = fetch_outcome()
    return fetch_log.withColumn("outcome", outcome).withColumn(
        "snippet", F.when(F.col("outcome") == "html", F.substring("head", 1, HTML_SNIPPET_CHARS))
    )


def fetch_outcomes(fetch_log: DataFrame) -> DataFrame:
    """Episodes per real outcome; handled failures count as failures."""
    return fetch_log.groupBy(fetch_outcome().alias("outcome")).agg(F.count("*").alias("episodes"))


def _folded(text: Column | str) -> Column:
    return F.lower(strip(text))


def enrich_from_catalogue(
    episodes: DataFrame, catalogue: DataFrame, show_name: str | None = None,
    title: str = "title", show: str = "podcast",
) -> DataFrame:
    """Episodes with ``spotify_url``: the best-ranked exact hit, or null.

    Only the first candidates of a title count.  Title and show must both agree
    after stripping and lower-casing; the show is ``show_name``, or the feed title
    when that is unset or empty.  The catalogue is cut down to one row per key
    before the join, so the join cannot multiply episodes.
    """
    hits = (
        catalogue.filter(F.col("rank") < CATALOGUE_CANDIDATES)
        .filter(_folded("title") == _folded("query_title"))
        .groupBy(F.col("query_title").alias("_title"), _folded("show").alias("_show"))
        .agg(F.min_by("url", "rank").alias("spotify_url"))
    )
    wanted = F.lit(show_name) if show_name else F.col(show)
    keyed = episodes.withColumn("_title", F.col(title)).withColumn("_show", _folded(wanted))
    return keyed.join(hits, ["_title", "_show"], "left").drop("_title", "_show")


def episode_record(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The five metadata fields, preceded by the columns in ``keep``."""
    return df.select(
        *(keep or []), "title", "podcast", "audio_url", "spotify_url",
        published_iso("published_ts").alias("published_date"),
    )

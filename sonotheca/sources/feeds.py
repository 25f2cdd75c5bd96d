"""Landed feed files as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonotheca.functions.dates import parse_published
from sonotheca.schemas import FEED_CHANNEL, LINKS


def file_stem(name: Column) -> Column:
    """Stem of a percent-encoded file name, as Spark reports it for most sources."""
    return stem_of(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))))


def stem_of(name: Column) -> Column:
    """Stem of a file name as it is."""
    return F.regexp_replace(name, r"(?<=.)\.[^./]+$", "")


def channel_reader(reader):
    """A batch or stream reader of feed files, one row per channel."""
    return reader.format("xml").option("rowTag", "channel").schema(FEED_CHANNEL)


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """One row per entry of every feed under ``path``, numbered in feed order.

    A feed is read whole, because its title and the order of its entries belong to
    it; many feeds are read in parallel.  The file stem identifies the feed.  The
    page link of an entry comes first, then its enclosures.
    """
    return entries_of(channel_reader(spark.read).load(path))


def entries_of(files: DataFrame) -> DataFrame:
    """The entries of channels that were read from files."""
    channels = files.select(
        file_stem(F.col("_metadata.file_name")).alias("feed_id"),
        F.col("title").alias("feed_title"),
        F.posexplode("item").alias("feed_pos", "entry"),
    )
    page = F.when(
        F.col("entry.link").isNotNull(),
        F.array(F.struct(F.lit("text/html").alias("type"), F.col("entry.link").alias("href"))),
    )
    enclosures = F.transform(
        F.col("entry.enclosure"),
        lambda e: F.struct(e["_type"].alias("type"), e["_url"].alias("href")),
    )
    none = F.array().cast(LINKS)
    return channels.select(
        "feed_id", "feed_title", "feed_pos", F.col("entry.title").alias("title"),
        F.concat(F.coalesce(page, none), F.coalesce(enclosures, none)).alias("links"),
        parse_published(F.col("entry.pubDate")).alias("published_ts"),
    )

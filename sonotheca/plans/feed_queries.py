"""Feed-side queries.  Orders stand for feed items, customers for feeds, parts for episodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonotheca.functions.dates import parse_published, published_iso
from sonotheca.functions.text import safe_title, stem_path
from sonotheca.operators import feed
from sonotheca.operators.ranking import first_per
from sonotheca.plans.registry import Tables, query
from sonotheca.session import fresh_dir, spread
from sonotheca.sources.feeds import read_feed
from sonotheca.sources.files import read_episode_records, write_episode_records

#: Feeds that stand for one landed file.
FEEDS_PER_FILE = 5000

_ITEMS_SQL = """
items AS (SELECT o_custkey AS feed_id, o_orderkey AS feed_pos, o_orderdate AS published_ts
          FROM orders)"""
_MARKS_SQL = """
marks AS (SELECT c_custkey AS feed_id,
                 TIMESTAMP '1995-01-01' + (c_custkey % 2400) * INTERVAL 1 DAY AS published_ts
          FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE'))"""


def _items(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("feed_id"), F.col("o_orderkey").alias("feed_pos"),
        F.col("o_orderdate").alias("published_ts"),
    )


def _marks(t: Tables) -> DataFrame:
    """Feeds of three market segments have a mark, the others start at the default."""
    marked = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "FURNITURE"))
    day = F.make_dt_interval((F.col("c_custkey") % 2400).cast("int"))
    return marked.select(
        F.col("c_custkey").alias("feed_id"),
        (F.lit("1995-01-01").cast("timestamp_ntz") + day).alias("published_ts"),
    )


def _iso(ts: str = "published_ts") -> Column:
    return published_iso(ts).alias("published")


@query(f"""
WITH {_ITEMS_SQL}, {_MARKS_SQL}
SELECT i.feed_id, i.feed_pos, strftime(i.published_ts, '%Y-%m-%dT%H:%M:%S') AS published
FROM items i LEFT JOIN marks m ON i.feed_id = m.feed_id
WHERE i.published_ts > coalesce(m.published_ts, TIMESTAMP '2000-01-01')""")
def new_since_mark(t: Tables) -> DataFrame:
    return feed.new_since(_items(t), _marks(t)).select("feed_id", "feed_pos", _iso())


@query(f"""
WITH {_MARKS_SQL}
SELECT c.c_custkey AS feed_id,
       strftime(coalesce(m.published_ts, TIMESTAMP '2000-01-01'), '%Y-%m-%dT%H:%M:%S') AS published
FROM customer c LEFT JOIN marks m ON c.c_custkey = m.feed_id""")
def read_mark(t: Tables) -> DataFrame:
    feeds = t.customer.select(F.col("c_custkey").alias("feed_id"))
    return feed.read_mark(feeds, _marks(t), "feed_id").select("feed_id", _iso())


@query(f"""
WITH {_ITEMS_SQL}
SELECT feed_id, feed_pos, strftime(published_ts, '%Y-%m-%dT%H:%M:%S') AS published
FROM (SELECT * FROM items ORDER BY published_ts, feed_pos LIMIT 5)""")
def oldest_first_run(t: Tables) -> DataFrame:
    return feed.oldest_first(_items(t)).select("feed_id", "feed_pos", _iso())


@query(f"""
WITH {_ITEMS_SQL}
SELECT feed_id, feed_pos, strftime(published_ts, '%Y-%m-%dT%H:%M:%S') AS published
FROM items
WHERE published_ts <= (SELECT max(published_ts)
                       FROM (SELECT published_ts FROM items ORDER BY published_ts LIMIT 5))""")
def oldest_first_with_ties(t: Tables) -> DataFrame:
    chosen = feed.oldest_first(_items(t), with_ties=True)
    return chosen.select("feed_id", "feed_pos", _iso())


@query(f"""
WITH {_ITEMS_SQL}
SELECT feed_id, feed_pos, strftime(published_ts, '%Y-%m-%dT%H:%M:%S') AS published
FROM items
QUALIFY row_number() OVER (PARTITION BY feed_id ORDER BY published_ts, feed_pos) <= 5""")
def oldest_first_per_feed(t: Tables) -> DataFrame:
    return feed.oldest_first(_items(t), per="feed_id").select("feed_id", "feed_pos", _iso())


@query(f"""
WITH {_ITEMS_SQL}
SELECT feed_id, feed_pos, strftime(published_ts, '%Y-%m-%dT%H:%M:%S') AS published
FROM items QUALIFY row_number() OVER (PARTITION BY feed_id ORDER BY feed_pos) = 1""")
def latest_item_per_feed(t: Tables) -> DataFrame:
    return feed.latest_item(_items(t)).select("feed_id", "feed_pos", _iso())


@query("""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'A' THEN 'https://a.example/' || l_partkey
            WHEN l_linestatus = 'O' THEN 'https://b.example/' || l_suppkey END AS audio_url
FROM lineitem WHERE l_returnflag = 'A' OR l_linestatus = 'O'""")
def first_audio_link(t: Tables) -> DataFrame:
    """Three links per row: one audio by return flag, one web page, one audio by line status."""
    def link(kind: Column, href: Column) -> Column:
        return F.struct(kind.alias("type"), href.alias("href"))

    flag = F.when(F.col("l_returnflag") == "A", "audio/mpeg")
    status = F.when(F.col("l_linestatus") == "O", "audio/mp4").otherwise("image/png")
    links = F.array(
        link(flag, F.concat(F.lit("https://a.example/"), F.col("l_partkey"))),
        link(F.lit("text/html"), F.lit("https://page.example/")),
        link(status, F.concat(F.lit("https://b.example/"), F.col("l_suppkey"))),
    )
    items = t.lineitem.withColumn("links", links)
    return feed.with_audio(items).select("l_orderkey", "l_linenumber", "audio_url")


@query("""
SELECT l_orderkey, min(l_linenumber) AS l_linenumber,
       'https://a.example/' || arg_min(l_partkey, l_linenumber::BIGINT * 1000000000 + l_partkey) AS audio_url
FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_orderkey""")
def first_audio_link_rows(t: Tables) -> DataFrame:
    """The lines of an order are its links, one per row; a line can occur twice in an order."""
    links = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        (F.col("l_linenumber").cast("bigint") * 1000000000 + F.col("l_partkey")).alias("pos"),
        F.when(F.col("l_returnflag") == "A", "audio/mpeg").otherwise("text/html").alias("type"),
        F.concat(F.lit("https://a.example/"), F.col("l_partkey")).alias("href"),
    )
    found = feed.first_audio_link_rows(links, "l_orderkey", "pos")
    first = links.filter(F.col("type") == "audio/mpeg").groupBy("l_orderkey").agg(
        F.min("l_linenumber").alias("l_linenumber")
    )
    return found.join(first, "l_orderkey")


_SAFE_SQL = r"rtrim(regexp_replace({0}, '[^\p{{L}}\p{{Nd}} ]', '', 'g'), ' ')"


@query(f"""
SELECT 'customer' AS kind, c_custkey AS id, {_SAFE_SQL.format('c_name')} AS stem FROM customer
UNION ALL
SELECT 'document', doc_id, {_SAFE_SQL.format('text')} FROM documents""")
def safe_titles(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("title")
    )
    documents = t.documents.select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("title")
    )
    return customers.union(documents).select("kind", "id", safe_title("title").alias("stem"))


@query("""
SELECT o_orderkey, strftime(o_orderdate - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') AS published_date
FROM orders""")
def published_dates(t: Tables) -> DataFrame:
    """Order dates as feed text two hours ahead of UTC, parsed and written as ISO."""
    text = F.concat(F.date_format("o_orderdate", "'Mon', dd MMM yyyy HH:mm:ss"), F.lit(" +0200"))
    return t.orders.select(
        "o_orderkey", published_iso(parse_published(text)).alias("published_date")
    )


@query("""
SELECT o_orderkey, 'Order ' || o_orderkey AS title, 'Feed ' || o_custkey AS podcast,
       'https://a.example/' || o_orderkey AS audio_url, CAST(NULL AS VARCHAR) AS spotify_url,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS published_date
FROM orders""")
def episode_records(t: Tables) -> DataFrame:
    """The records written as JSON lines and read back."""
    made = t.orders.select(
        "o_orderkey",
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("title"),
        F.concat(F.lit("Feed "), F.col("o_custkey")).alias("podcast"),
        F.concat(F.lit("https://a.example/"), F.col("o_orderkey")).alias("audio_url"),
        F.lit(None).cast("string").alias("spotify_url"),
        F.col("o_orderdate").alias("published_ts"),
    )
    path = fresh_dir(t.spark, "records")
    write_episode_records(feed.episode_record(made), path)
    back = read_episode_records(t.spark, path)
    key = F.regexp_extract("title", r"(\d+)$", 1).cast("bigint")
    return back.withColumn("o_orderkey", key)


def _fetch_log(t: Tables) -> DataFrame:
    kind = (
        F.when(F.col("event_type") == "error", "Text/HTML; charset=utf-8")
        .when(F.col("event_type") == "view", None)
        .otherwise(F.concat(F.lit("audio/"), F.col("event_type")))
    )
    status = F.when(F.col("value") < 1, None).otherwise(F.floor(F.col("value")) + 200)
    return t.events.select(
        "event_id",
        F.concat(F.lit("https://a.example/"), F.col("event_id")).alias("audio_url"),
        status.cast("int").alias("status"), kind.alias("content_type"),
        F.lit(0).cast("bigint").alias("content_length"), F.repeat("props", 40).alias("head"),
    )


_FETCH_SQL = """
SELECT event_id,
       CASE WHEN value < 1 THEN 'no_response'
            WHEN floor(value) + 200 BETWEEN 400 AND 599 THEN 'http_error'
            WHEN event_type = 'error' THEN 'html' ELSE 'ok' END AS outcome,
       substring(repeat(props, 40), 1, 200) AS head
FROM events"""


@query(f"""
SELECT event_id, outcome, CASE WHEN outcome = 'html' THEN head END AS snippet
FROM ({_FETCH_SQL})""")
def accept_fetch(t: Tables) -> DataFrame:
    return feed.accept_fetch(_fetch_log(t)).select("event_id", "outcome", "snippet")


@query(f"SELECT outcome, count(*) AS episodes FROM ({_FETCH_SQL}) GROUP BY outcome")
def fetch_outcomes(t: Tables) -> DataFrame:
    return feed.fetch_outcomes(_fetch_log(t))


@query("""
WITH ranked AS (
  SELECT p_name, p_brand, p_partkey, p_size,
         row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) - 1 AS rank FROM part),
hits AS (
  SELECT p_name, p_brand, min(rank) AS rank, arg_min(p_partkey, rank) AS partkey
  FROM ranked WHERE rank < 5 GROUP BY p_name, p_brand)
SELECT p.p_partkey, p.p_name AS title, p.p_brand AS podcast,
       'https://c.example/' || h.partkey AS spotify_url
FROM part p LEFT JOIN hits h ON p.p_name = h.p_name AND p.p_brand = h.p_brand""")
def catalogue_match(t: Tables) -> DataFrame:
    """Parts as episodes; the parts of one name, in key order, are its catalogue candidates."""
    episodes = t.part.select(
        "p_partkey", F.col("p_name").alias("title"), F.col("p_brand").alias("podcast")
    )
    ranked = first_per(t.part, ["p_name"], [F.col("p_partkey").asc()], 5, rank_as="place")
    loud = F.concat(F.lit("  "), F.upper("p_name"), F.lit("\t"))
    catalogue = ranked.select(
        F.col("p_name").alias("query_title"), (F.col("place") - 1).alias("rank"),
        F.when(F.col("p_size") % 2 == 0, loud).otherwise(F.col("p_name")).alias("title"),
        F.concat(F.upper("p_brand"), F.lit(" ")).alias("show"),
        F.concat(F.lit("https://c.example/"), F.col("p_partkey")).alias("url"),
    )
    matched = feed.enrich_from_catalogue(episodes, catalogue)
    return matched.select("p_partkey", "title", "podcast", "spotify_url")


@query("""
SELECT doc_id, replace('media/doc ' || doc_id || '.mp3', '.mp3', '.txt') AS text_path,
       replace(replace('media/doc ' || doc_id || '.mp3', '.mp3', '.txt'), '.txt', '.json') AS record_path
FROM documents""")
def stem_paths(t: Tables) -> DataFrame:
    audio = F.concat(F.lit("media/doc "), F.col("doc_id"), F.lit(".mp3"))
    text = stem_path(audio, ".mp3", ".txt")
    return t.documents.select(
        "doc_id", text.alias("text_path"), stem_path(text, ".txt", ".json").alias("record_path")
    )


@query("""
SELECT 'Feed ' || c_custkey AS feed_title, pos AS feed_pos, c_name || ' ' || pos AS title,
       CASE pos WHEN 0 THEN 'https://a.example/' || c_custkey END AS audio_url,
       CASE pos WHEN 0 THEN strftime(TIMESTAMP '2024-01-01' + c_nationkey * INTERVAL 1 HOUR,
                                     '%Y-%m-%dT%H:%M:%S') END AS published
FROM customer, (VALUES (0), (1)) AS p(pos)""")
def feed_files(t: Tables) -> DataFrame:
    """Every customer becomes a feed with two entries, written as XML and read back."""
    hour = F.make_timestamp(
        F.lit(2024), F.lit(1), F.lit(1) + F.floor(F.col("c_nationkey") / 24).cast("int"),
        F.col("c_nationkey") % 24, F.lit(0), F.lit(0),
    )
    date = F.concat(F.lit("Mon, "), F.date_format(hour, "dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))

    def enclosure(kind: str, host: str) -> Column:
        return F.struct(
            F.concat(F.lit(f"https://{host}.example/"), F.col("c_custkey")).alias("_url"),
            F.lit(kind).alias("_type"), F.lit(1).cast("bigint").alias("_length"),
        )

    def entry(pos: int, published: Column, *enclosures: Column) -> Column:
        return F.struct(
            F.concat("c_name", F.lit(f" {pos}")).alias("title"), published.alias("pubDate"),
            F.lit("https://page.example/").alias("link"), F.array(*enclosures).alias("enclosure"),
        )

    items = F.array(
        entry(0, date, enclosure("image/png", "i"), enclosure("audio/mpeg", "a")),
        entry(1, F.lit(None).cast("string"), enclosure("image/png", "i")),
    )
    channels = spread(t.customer).select(
        F.concat(F.lit("Feed "), F.col("c_custkey")).alias("title"), items.alias("item")
    )
    path = fresh_dir(t.spark, "feeds")
    # a file is read whole by one task, so its feeds are bounded
    channels.write.format("xml").options(rootTag="rss", rowTag="channel", maxRecordsPerFile=FEEDS_PER_FILE).save(path)
    return read_feed(t.spark, path).select(
        "feed_title", "feed_pos", "title", feed.first_audio_link("links").alias("audio_url"), _iso()
    )

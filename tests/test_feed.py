from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sonotheca.functions.dates import parse_published, published_iso
from sonotheca.operators import feed
from sonotheca.schemas import CATALOGUE, FEED_ITEMS, FETCH_LOG, MARKS
from sonotheca.sources.feeds import read_feed

FEED = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0"><channel><title>Été</title><link>https://page.example/</link>
{items}
</channel></rss>"""
ITEM = "<item><title>{0}</title>{1}<link>https://page.example/{0}</link>{2}</item>"


def entry(title, date, *enclosures):
    day = f"<pubDate>{date}</pubDate>" if date else ""
    return ITEM.format(title, day, "".join(f"<enclosure {e}/>" for e in enclosures))


AUDIO = 'url="https://a.example/{}" type="audio/mpeg" length="5"'


@pytest.fixture
def feeds(tmp_path):
    items = [
        entry("newest", "Wed, 03 Jan 2024 10:00:00 +0200", AUDIO.format("n")),
        entry("undated", None, AUDIO.format("u")),
        entry("picture first", "Tue, 02 Jan 2024 10:00:00 GMT",
              'url="https://i.example/" type="image/png" length="1"', AUDIO.format("p")),
        entry("no audio", "Tue, 02 Jan 2024 10:00:00 GMT"),
        entry("no type", "Mon, 01 Jan 2024 10:00:00 GMT", 'url="https://x.example/" length="1"'),
    ]
    (tmp_path / "my feed é.xml").write_text(FEED.format(items="\n".join(items)), encoding="utf-8")
    (tmp_path / "empty.xml").write_text(FEED.format(items=""), encoding="utf-8")
    return str(tmp_path)


def test_read_feed_keeps_order_and_links(spark, feeds):
    rows = sorted(read_feed(spark, feeds).collect(), key=lambda r: r.feed_pos)
    assert [r.title for r in rows] == ["newest", "undated", "picture first", "no audio", "no type"]
    assert {(r.feed_id, r.feed_title) for r in rows} == {("my feed é", "Été")}
    assert rows[0].published_ts == datetime(2024, 1, 3, 8)
    assert rows[1].published_ts is None
    assert [link.type for link in rows[2].links] == ["text/html", "image/png", "audio/mpeg"]


def test_audio_link_of_feed_entries(spark, feeds):
    found = {r.title: r.audio_url for r in feed.with_audio(read_feed(spark, feeds)).collect()}
    assert found == {
        "newest": "https://a.example/n", "undated": "https://a.example/u",
        "picture first": "https://a.example/p",
    }


def test_empty_address_is_no_audio(spark):
    df = spark.createDataFrame(
        [("a", [("audio/x", ""), ("audio/y", "later")]), ("b", []), ("c", None), ("d", [("Audio/x", "u")])],
        "k STRING, links ARRAY<STRUCT<type STRING, href STRING>>",
    )
    assert feed.with_audio(df).count() == 0


def items(spark, rows):
    full = [(f, "Feed", pos, f"t{pos}", None, ts) for f, pos, ts in rows]
    return spark.createDataFrame(full, FEED_ITEMS)


def positions(df):
    return sorted((r.feed_id, r.feed_pos) for r in df.collect())


def test_new_since_is_strict_and_drops_undated(spark):
    mark = datetime(2024, 1, 2)
    df = items(spark, [
        ("a", 0, mark), ("a", 1, datetime(2024, 1, 2, 0, 0, 1)), ("a", 2, None),
        ("b", 0, datetime(2000, 1, 1)), ("b", 1, datetime(2000, 1, 1, 0, 0, 1)),
        ("old", 0, datetime(1990, 1, 2)),
    ])
    marks = spark.createDataFrame([("a", mark), ("old", datetime(1990, 1, 1))], "feed_id STRING, published_ts TIMESTAMP")
    assert positions(feed.new_since(df, marks)) == [("a", 1), ("b", 1), ("old", 0)]
    assert positions(feed.new_since(df, marks.filter("false"))) == [("a", 0), ("a", 1), ("b", 1)]


def test_read_mark_defaults(spark):
    marks = spark.createDataFrame([("a", datetime(2024, 1, 1)), ("b", None)], MARKS)
    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "collection STRING")
    got = {r.collection: r.published_ts for r in feed.read_mark(asked, marks).collect()}
    assert got == {"a": datetime(2024, 1, 1), "b": datetime(2000, 1, 1), "c": datetime(2000, 1, 1)}


@pytest.fixture
def dated(spark):
    day = [3, 1, 2, 2, 5, 4, 2, 9]
    return items(spark, [("a", pos, datetime(2024, 1, d)) for pos, d in enumerate(day)]
                 + [("b", 0, datetime(2024, 1, 1))])


def test_oldest_first(spark, dated):
    only_a = dated.filter("feed_id = 'a'")
    assert positions(feed.oldest_first(only_a, 3)) == [("a", 1), ("a", 2), ("a", 3)]
    assert positions(feed.oldest_first(only_a, 3, with_ties=True)) == [("a", p) for p in (1, 2, 3, 6)]
    assert positions(feed.oldest_first(dated, 2, per="feed_id")) == [("a", 1), ("a", 2), ("b", 0)]
    assert len(positions(feed.oldest_first(dated, 2, per="feed_id", with_ties=True))) == 5
    assert feed.oldest_first(only_a).count() == 5
    assert feed.oldest_first(dated, None).count() == 9


def test_latest_item_follows_feed_order(spark, dated):
    assert positions(feed.latest_item(dated.filter("feed_pos > 1 OR feed_id = 'b'"))) == [("a", 2), ("b", 0)]


def test_fetch_outcomes(spark):
    log = spark.createDataFrame([
        ("u1", 200, "audio/mpeg", 1, "x"), ("u2", 200, "Text/HTML; charset=utf-8", 1, "h" * 300),
        ("u3", 404, "audio/mpeg", 1, "x"), ("u4", 403, "text/html", 1, "x"), ("u5", 200, None, 1, "x"),
        ("u6", None, None, None, None), ("u7", 399, None, 1, "x"), ("u8", 600, None, 1, "x"),
    ], FETCH_LOG)
    got = {r.audio_url: (r.outcome, r.snippet) for r in feed.accept_fetch(log).collect()}
    assert {u: o for u, (o, _) in got.items()} == {
        "u1": "ok", "u2": "html", "u3": "http_error", "u4": "http_error", "u5": "ok",
        "u6": "no_response", "u7": "ok", "u8": "ok",
    }
    assert got["u2"][1] == "h" * 200 and got["u4"][1] is None
    counts = {r.outcome: r.episodes for r in feed.fetch_outcomes(log).collect()}
    assert counts == {"ok": 4, "html": 1, "http_error": 2, "no_response": 1}


def test_catalogue(spark):
    rows = [
        ("T1", 0, "T1", "My Show Extra", "wrong show"), ("T1", 1, " t1 ", "MY show ", "right"),
        ("T1", 2, "T1", "My Show", "second"), ("T2", 0, "T2 part", "My Show", "wrong title"),
        ("T3", 5, "T3", "My Show", "too late"), ("T4", 4, "T4", "My Show", "last place"),
    ]
    catalogue = spark.createDataFrame(rows, CATALOGUE)
    episodes = spark.createDataFrame([(f"T{i}", "My Show") for i in range(1, 6)], "title STRING, podcast STRING")
    want = {"T1": "right", "T2": None, "T3": None, "T4": "last place", "T5": None}
    for show in (None, "", "my show"):
        got = feed.enrich_from_catalogue(episodes, catalogue, show)
        assert {r.title: r.spotify_url for r in got.collect()} == want
    other = feed.enrich_from_catalogue(episodes, catalogue, "Another")
    assert other.filter("spotify_url IS NOT NULL").count() == 0


def test_dates(spark):
    cases = {
        "Mon, 01 Jan 2024 10:00:00 +0200": "2024-01-01T08:00:00",
        "Mon, 1 Jan 2024 10:00:00 GMT": "2024-01-01T10:00:00",
        "1 Jan 2024 10:00 EST": "2024-01-01T15:00:00",
        "Tue, 02 Jan 24 10:00:00 UT": "2024-01-02T10:00:00",
        "Tue, 02 Jan 2024 10:00:00 Z": "2024-01-02T10:00:00",
        "Tue, 2 Jan 2024 10:00:00": "2024-01-02T10:00:00",
        "2024-01-01T10:00:00Z": "2024-01-01T10:00:00",
        "2024-01-01T10:00:00+01:00": "2024-01-01T09:00:00",
        "nonsense": None, "": None, None: None,
    }
    df = spark.createDataFrame([(c,) for c in cases], "t STRING")
    got = {r.t: r.iso for r in df.select("t", published_iso(parse_published("t")).alias("iso")).collect()}
    assert got == cases


def test_episode_record(spark):
    df = spark.createDataFrame(
        [("t", "p", "a", None, None)],
        "title STRING, podcast STRING, audio_url STRING, spotify_url STRING, published_ts TIMESTAMP",
    )
    assert feed.episode_record(df).first().asDict() == {
        "title": "t", "podcast": "p", "audio_url": "a", "spotify_url": None, "published_date": None,
    }


def test_plans(spark, dated, plan_of):
    assert "TakeOrderedAndProject" in plan_of(feed.oldest_first(dated, 3))
    assert plan_of(feed.oldest_first(dated, 3, per="feed_id")).count("WindowGroupLimit") == 2
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    feedlike = orders.select(F.col("o_custkey").alias("feed_id"), F.col("o_orderdate").alias("published_ts"))
    marks = feedlike.limit(1)
    scan = plan_of(feed.new_since(feedlike, marks))
    assert "DataFilters: [isnotnull(o_orderdate" in scan and "CartesianProduct" not in scan


def test_many_rows_per_hot_key_are_ranked_in_parts(spark, plan_of):
    from sonotheca.operators.ranking import first_per

    df = spark.range(0, 20_000, 1, 8).select(
        F.expr("if(id % 10 < 9, 'hot', 'x')").alias("k"), (F.col("id") * 7919 % 20_011).alias("v"))
    got = first_per(df, ["k"], [F.col("v")], 5000)
    assert plan_of(got).count("Window [") == 2 and "_salt" in plan_of(got)
    want = {}
    for r in sorted(df.collect(), key=lambda r: r.v):
        want.setdefault(r.k, [])
        if len(want[r.k]) < 5000:
            want[r.k].append(r.v)
    have = {}
    for r in got.collect():
        have.setdefault(r.k, []).append(r.v)
    assert {k: sorted(v) for k, v in have.items()} == want


def test_pushed_bound_follows_the_marks(spark, tmp_path, plan_of):
    from datetime import datetime

    from sonotheca.operators.feed import earliest_mark, new_since

    days = [datetime(2024, 1, n) for n in range(1, 20)]
    spark.createDataFrame([("a", d) for d in days] + [("b", d) for d in days], "feed_id STRING, published_ts TIMESTAMP").write.parquet(str(tmp_path / "items"))
    items = spark.read.parquet(str(tmp_path / "items"))
    marks = spark.createDataFrame([("a", days[10]), ("b", days[15])], "feed_id STRING, published_ts TIMESTAMP")
    found = new_since(items, marks)
    bound = lambda: earliest_mark(items, marks.withColumnRenamed("published_ts", "_mark")).first()[0]
    assert found.count() == 8 + 3 and bound() == days[10]
    assert plan_of(found).count("ReadSchema: struct<feed_id:string,published_ts:timestamp>") == 1  # the others read the keys alone
    marks = marks.filter("feed_id = 'a'")
    assert new_since(items, marks).count() == 8 + 19 and bound() == datetime(2000, 1, 1)


def test_steps_by_counting_older_items(spark):
    import random

    rnd = random.Random(4)
    rows = [(rnd.choice("aab"), datetime(2024, 1, rnd.randint(1, 4), rnd.choice([0, 0, 5, 9]), rnd.choice([0, 1])), i) for i in range(150)]
    df = spark.createDataFrame(rows, "feed_id STRING, published_ts TIMESTAMP, feed_pos INT")
    got = feed.in_steps(df, 7).collect()
    assert len(got) == 150
    for r in got:
        older = sum(f == r["feed_id"] and d < r["published_ts"] for f, d, _ in rows)
        assert r["step"] == older // 7
    assert feed.in_steps(df.limit(0), 7).count() == 0


def test_landed_feed_files_are_bounded(spark, tmp_path, monkeypatch):
    from sonotheca.plans import feed_queries
    from sonotheca.plans.registry import QUERIES

    spark.range(50).selectExpr("id AS c_custkey", "id % 25 AS c_nationkey", "concat('n', id) AS c_name").coalesce(1).write.parquet(
        str(tmp_path / "customer.parquet"))
    monkeypatch.setattr(feed_queries, "FEEDS_PER_FILE", 4)
    rows = QUERIES["feed_files"](spark, str(tmp_path))
    assert rows.count() == 100 and len(rows.inputFiles()) >= 13

import pytest
from pyspark.sql import functions as F

from sonotheca.operators import store as st
from sonotheca.plans import batch
from sonotheca.streaming import feeds

ENTRY = ('<item><title>{t}</title>{d}<enclosure url="https://a.example/{t}" type="audio/mpeg" length="1"/></item>')


def land(folder, name, entries):
    """A feed file: titles with the day of January they are dated, or None."""
    body = "".join(ENTRY.format(t=t, d=f"<pubDate>Mon, {d:02d} Jan 2024 00:00:00 GMT</pubDate>" if d else "") for t, d in entries)
    (folder / f"{name}.xml").write_text(f"<rss><channel><title>Feed</title>{body}</channel></rss>")


@pytest.fixture
def place(tmp_path):
    folder = tmp_path / "feeds"
    folder.mkdir()
    return folder, str(tmp_path / "store"), str(tmp_path / "checkpoint")


def texts(spark):
    rows = [(c, t, f"Text of {t}.") for c in ("a", "b") for t in ("one", "two", "three", "late", "new", "undated")]
    return batch.landed_transcripts(spark.createDataFrame(rows, "collection STRING, stem STRING, text STRING"))


def caught_up(spark, place, transcripts):
    folder, root, checkpoint = place
    # a snapshot of a feed lands under its name, again and again, in folders of their own
    entries = feeds.stream_feed_files(spark, str(folder), recursiveFileLookup="true")
    feeds.stream_feeds(entries, root, transcripts, checkpoint, compact_every=None).awaitTermination()


def stored(spark, root):
    return sorted((r["collection"], r["id"]) for r in st.current_chunks(spark, root).collect())


def handled(spark, root):
    return sorted((r["collection"], r["stem"]) for r in st.read_handled(spark, root).collect())


def test_only_what_is_new_passes_and_a_restart_goes_on(spark, place):
    folder, root, _ = place
    for step in ("1", "2"):
        (folder / step).mkdir()
    land(folder / "1", "a", [("two", 2), ("one", 1), ("undated", None), ("two", 2)])
    land(folder / "1", "b", [("one", 5)])
    caught_up(spark, place, texts(spark))
    first = [("a", "one"), ("a", "two"), ("b", "one")]
    assert handled(spark, root) == first
    caught_up(spark, place, texts(spark))
    assert handled(spark, root) == first
    land(folder / "2", "a", [("new", 9), ("late", 1), ("two", 2), ("one", 1)])
    land(folder / "2", "b", [("late", 4), ("one", 5)])
    caught_up(spark, place, texts(spark))
    assert handled(spark, root) == sorted([*first, ("a", "new")])
    assert stored(spark, root) == [("a", "new_0"), ("a", "one_0"), ("a", "two_0"), ("b", "one_0")]
    assert {r["collection"]: r["published_ts"].day for r in st.read_marks(spark, root).collect()} == {"a": 9, "b": 5}


def test_marks_of_the_store_are_where_a_stream_begins(spark, place):
    folder, root, _ = place
    st.write_marks(spark, root, spark.createDataFrame([("a", "2024-01-03 00:00:00")], "collection STRING, t STRING").select(
        "collection", F.to_timestamp("t").alias("published_ts")), 0)
    land(folder, "a", [("one", 1), ("three", 3), ("new", 4)])
    land(folder, "b", [("one", 1)])
    caught_up(spark, place, texts(spark))
    assert handled(spark, root) == [("a", "new"), ("b", "one")]


def test_a_crash_loses_and_repeats_nothing(spark, place):
    folder, root, checkpoint = place
    land(folder, "a", [("one", 1), ("two", 2)])
    find = texts(spark)

    def crashing(episodes):
        raise RuntimeError("driver lost")

    with pytest.raises(Exception, match="driver lost"):
        caught_up(spark, place, crashing)
    caught_up(spark, place, find)
    assert handled(spark, root) == [("a", "one"), ("a", "two")]
    assert stored(spark, root) == [("a", "one_0"), ("a", "two_0")]

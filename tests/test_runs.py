from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sonotheca.operators import store as st
from sonotheca.plans import batch
from sonotheca.schemas import CATALOGUE, EPISODE, FEED_ITEMS, FETCH_LOG
from sonotheca.streaming import ingest

START = datetime(2024, 1, 1)


def item(feed, pos, day, audio=True):
    links = [("text/html", "p")] + ([("audio/mpeg", f"{feed}/{pos}")] if audio else [])
    when = None if day is None else START + timedelta(days=day)
    return (feed, f"Feed {feed}", pos, f"Talk: {pos}", links, when)


@pytest.fixture
def items(spark):
    rows = [item("a", pos, 9 - pos) for pos in range(9)]  # newest first, as feeds are
    rows += [item("b", 0, 3), item("b", 1, 3), item("b", 2, None), item("b", 3, 1, audio=False)]
    return spark.createDataFrame(rows, FEED_ITEMS)


@pytest.fixture
def texts(spark):
    rows = [("a", f"Talk {n}", f"First {n}. Second {n}.") for n in range(9)]
    rows += [("b", "Talk 0", "Hello."), ("b", "Talk 1", " \n ")]
    return batch.landed_transcripts(
        spark.createDataFrame(rows, "collection STRING, stem STRING, text STRING")
    )


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")


def stored(spark, root):
    rows = st.latest_by_id(st.read_batches(spark, root)).collect()
    return {(r.collection, r.id): r.document for r in rows}


def marks(spark, root):
    return {r.collection: (r.published_ts - START).days for r in st.read_marks(spark, root).collect()}


def summary(df):
    return {(r.collection, r.outcome): r["items"] for r in df.collect()}


def test_runs_go_oldest_first(spark, root, items, texts):
    first = batch.run_batch(spark, root, items, texts, n=5)
    assert summary(first) == {("a", "stored"): 5, ("b", "stored"): 1, ("b", "blank"): 1}
    assert set(stored(spark, root)) == {("a", f"Talk_{p}_0") for p in range(4, 9)} | {("b", "Talk_0_0")}
    assert marks(spark, root) == {"a": 5, "b": 3}
    second = batch.run_batch(spark, root, items, texts, n=5)
    assert summary(second) == {("a", "stored"): 4}
    third = batch.run_batch(spark, root, items, texts, n=5)
    assert summary(third) == {}
    assert marks(spark, root) == {"a": 9, "b": 3} and len(stored(spark, root)) == 10
    chunk = st.current_chunks(spark, root, "a").filter("id = 'Talk_3_0'").first()
    assert chunk.metadata.asDict() == {
        "title": "Talk: 3", "podcast": "Feed a", "audio_url": "a/3", "spotify_url": None,
        "published_date": "2024-01-07T00:00:00",
    }
    assert chunk.document == "First 3. Second 3." and len(chunk.embedding) == 384


def test_replaying_a_run_changes_nothing(spark, root, items, texts):
    batch.run_batch(spark, root, items, texts, n=2)
    batch.run_batch(spark, root, items, texts, n=2)
    before, moved = stored(spark, root), marks(spark, root)
    batch.run_batch(spark, root, items, texts, n=2, batch_seq=2)
    assert (stored(spark, root), marks(spark, root)) == (before, moved)


def test_backfill_in_steps_equals_one_pass(spark, tmp_path, items, texts):
    one, steps = str(tmp_path / "one"), str(tmp_path / "steps")
    assert batch.backfill(spark, one, items, texts) == 1
    assert batch.backfill(spark, steps, items, texts, n=4) == 3
    assert stored(spark, one) == stored(spark, steps) and marks(spark, one) == marks(spark, steps)


def test_failures_are_isolated_and_retried(spark, root, items, texts):
    log = [(f"a/{p}", 404 if p == 8 else 200, "audio/mpeg", 1, "") for p in range(9)]
    fetched = spark.createDataFrame(log + [("b/0", 200, "text/html", 1, "<html>")], FETCH_LOG)
    hits = spark.createDataFrame([("Talk: 7", 0, "talk: 7", "FEED A", "link")], CATALOGUE)
    first = batch.run_batch(spark, root, items, texts, n=3, fetch_log=fetched, catalogue=hits)
    assert summary(first) == {("a", "stored"): 2, ("a", "failed"): 1, ("b", "failed"): 2}
    failed = {(r.collection, r.stem): r.error for r in st.failed_items(spark, root).collect()}
    assert failed == {
        ("a", "Talk 8"): "Fetch failed: http_error", ("b", "Talk 0"): "Fetch failed: html",
        ("b", "Talk 1"): "Fetch failed: no_response",
    }
    assert marks(spark, root) == {"a": 3}
    chunk = st.current_chunks(spark, root, "a").filter("id = 'Talk_7_0'").first()
    assert chunk.metadata.spotify_url == "link"
    again = batch.run_batch(spark, root, items, texts, n=1, retry_failed=True)
    # one new item of each feed, and the earlier failures of both
    assert summary(again) == {("a", "stored"): 2, ("b", "stored"): 1, ("b", "blank"): 1}
    assert st.failed_items(spark, root).count() == 0
    assert ("a", "Talk_8_0") in stored(spark, root)


def test_missing_transcript_fails_only_itself(spark, root, items):
    none = batch.landed_transcripts(
        spark.createDataFrame([("a", "Talk 8", "x.")], "collection STRING, stem STRING, text STRING")
    )
    got = batch.run_batch(spark, root, items.filter("feed_id = 'a'"), none, n=2)
    assert summary(got) == {("a", "stored"): 1, ("a", "failed"): 1}


def test_model_of_a_collection_is_fixed(spark, root, items, texts):
    from sonotheca.operators.embedding import offline_embedder

    batch.run_batch(spark, root, items, texts, n=1)
    with pytest.raises(ValueError, match="hashed-words-384"):
        batch.run_batch(spark, root, items, texts, n=1, embedder=offline_embedder(8))


def episodes(spark, rows):
    schema = "stem STRING, collection STRING, audio_url STRING, published_ts TIMESTAMP"
    df = spark.createDataFrame(rows, schema)
    empty = F.struct(*(F.lit(None).cast("string").alias(f) for f in EPISODE.fieldNames()))
    return df.withColumn("metadata", empty)


def test_stream_ingest(spark, tmp_path, root):
    landing, state = tmp_path / "landing", str(tmp_path / "state")
    landing.mkdir()
    (landing / "talk 1.txt").write_text("Un. Deux.")
    (landing / "lost.txt").write_text("Nobody knows me.")
    (landing / "blank.txt").write_text("  ")
    known = episodes(spark, [
        ("talk 1", "a", "u", START), ("blank", "a", "u", START + timedelta(days=8)),
        ("talk 2", "a", "u", START + timedelta(days=1)), ("late", "a", "u", START),
    ])

    def catch_up():
        stream = ingest.stream_transcript_files(spark, str(landing))
        ingest.stream_ingest(stream, root, known, state).awaitTermination()

    catch_up()
    assert stored(spark, root) == {("a", "talk_1_0"): "Un. Deux."}
    assert marks(spark, root) == {"a": 0}
    assert [r.stem for r in st.failed_items(spark, root).collect()] == ["lost"]
    (landing / "talk 2.txt").write_text("Trois.")
    (landing / "late.txt").write_text("Dated at the mark.")
    catch_up()
    catch_up()
    assert stored(spark, root) == {
        ("a", "talk_1_0"): "Un. Deux.", ("a", "talk_2_0"): "Trois.", ("a", "late_0"): "Dated at the mark."}
    assert marks(spark, root) == {"a": 1}


def test_undated_late_and_equal_stems_are_stored(spark, root):
    known = episodes(spark, [("x", "a", "u", None), ("y", "a", "u", START), ("y", "b", "v", START)])
    schema = "collection STRING, stem STRING, text STRING"
    ingest.ingest_batch(spark.createDataFrame([("a", "x", "One."), ("a", "y", "Two."), ("b", "y", "Other.")], schema), 1, root, known)
    assert stored(spark, root) == {("a", "x_0"): "One.", ("a", "y_0"): "Two.", ("b", "y_0"): "Other."}
    assert marks(spark, root) == {"a": 0, "b": 0}


def test_two_streams_on_one_store_keep_both(spark, tmp_path, root):
    known = episodes(spark, [("one", "a", "u", START), ("two", "a", "u", START)])
    for name in ("one", "two"):
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name}.txt").write_text(f"{name}.")
        stream = ingest.stream_transcript_files(spark, str(tmp_path / name))
        ingest.stream_ingest(stream, root, known, str(tmp_path / f"state-{name}")).awaitTermination()
    assert set(stored(spark, root)) == {("a", "one_0"), ("a", "two_0")}


def test_backfill_in_steps_is_not_blocked(spark, root):
    rows = [item("a", pos, pos, audio=pos >= 5) for pos in range(12)]
    items = spark.createDataFrame(rows, FEED_ITEMS)
    texts = batch.landed_transcripts(spark.createDataFrame(
        [("a", f"Talk {n}", f"Text {n}.") for n in range(12) if n != 6] + [("a", "Talk 6", "  ")], "collection STRING, stem STRING, text STRING"))
    assert batch.backfill(spark, root, items, texts, n=5) == 3
    assert set(stored(spark, root)) == {("a", f"Talk_{n}_0") for n in range(5, 12) if n != 6}
    assert {r.error for r in st.read_handled(spark, root).filter("error IS NOT NULL").collect()} == {batch.NO_AUDIO}


def test_runs_compact_the_store(spark, root, items, texts):
    for _ in range(2):
        batch.run_batch(spark, root, items, texts, n=2, compact_every=2)
    assert spark.read.parquet(f"{root}/merges").select("version").distinct().count() == 1
    assert len(st.current_chunks(spark, root).collect()) == len(stored(spark, root))


def test_one_episode_of_a_stem_wins_whole(spark):
    rows = [("a", "s", "u1", START, "first text"), ("a", "s", "u2", START, "second text"), ("a", "s", "u9", None, "undated"),
            ("a", "t", "u", None, "alone"), ("b", "s", "u", None, "elsewhere"), ("a", "t", "u", None, "alone")]
    df = spark.createDataFrame(rows, "collection STRING, stem STRING, audio_url STRING, published_ts TIMESTAMP, text STRING")
    assert sorted(r.text for r in batch.one_per_stem(df).collect()) == ["alone", "elsewhere", "second text"]


def refusing_model():
    def load():
        def outputs(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("refused")
            return [[float(len(t)), 1.0] for t in texts]

        return outputs

    from sonotheca.operators.embedding import model_embedder
    return model_embedder("refusing", load)


def test_a_text_the_model_refuses_costs_only_its_episode(spark, root, items):
    texts = batch.landed_transcripts(spark.createDataFrame(
        [("a", f"Talk {n}", "A bad text." if n == 3 else f"Good {n}.") for n in range(9)], "collection STRING, stem STRING, text STRING"))
    done = batch.run_batch(spark, root, items.filter("feed_id = 'a'"), texts, n=None, embedder=refusing_model())
    assert summary(done) == {("a", "stored"): 8, ("a", "failed"): 1}
    assert ("a", "Talk_3_0") not in stored(spark, root) and len(stored(spark, root)) == 8
    assert [(r.stem, r.error) for r in st.failed_items(spark, root).collect()] == [("Talk 3", "refused")]


def test_store_folder(spark, tmp_path, root):
    folder = tmp_path / "landing"
    folder.mkdir()
    record = '{"title": "T", "podcast": "P", "audio_url": "u", "spotify_url": null, "published_date": %s}'
    for stem, text, date in (("one", "Un. Deux.", '"2024-01-03T00:00:00"'), ("undated", "Trois.", "null"), ("blank", " ", "null")):
        (folder / f"{stem}.txt").write_text(text)
        (folder / f"{stem}.json").write_text(record % date)
    (folder / "lost.txt").write_text("No record.")
    done = batch.store_folder(spark, root, str(folder), "shelf")
    assert summary(done) == {("shelf", "stored"): 2, ("shelf", "blank"): 1, ("shelf", "failed"): 1}
    assert stored(spark, root) == {("shelf", "one_0"): "Un. Deux.", ("shelf", "undated_0"): "Trois."}
    assert marks(spark, root) == {"shelf": 2}


def test_replayed_micro_batch_changes_nothing(spark, root):
    known = episodes(spark, [("x", "a", "u", START), ("y", "a", "u", START + timedelta(days=1))])
    landed = spark.createDataFrame([("x", "One."), ("y", "Two.")], "stem STRING, text STRING")
    for _ in range(2):
        ingest.ingest_batch(landed, 1, root, known)
        assert len(stored(spark, root)) == 2 and marks(spark, root) == {"a": 1}

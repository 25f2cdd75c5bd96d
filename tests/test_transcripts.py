import json
import random

import pytest
from pyspark.sql import functions as F

from sonotheca.functions import audio
from sonotheca.operators import transcripts as tr
from sonotheca.schemas import PART_RESULTS
from sonotheca.session import written

MIB = 1024 * 1024


def test_formats(spark):
    paths = {
        "a/x.mp3": True, "a/x.WAV": True, "x.txt": False, "dir.mp3/x": False, ".mp3": False,
        "a/.flac": False, "a.b.ogg": True, "x.mp3.": False, "x": False, "x.Flac": True,
    }
    df = spark.createDataFrame([(p,) for p in paths], "path STRING")
    got = df.select("path", audio.is_audio("path").alias("ok"), audio.format_error("path").alias("e"))
    rows = {r.path: r for r in got.collect()}
    assert {p: r.ok for p, r in rows.items()} == paths
    assert rows["x.txt"].e == "Unsupported format: .txt" and rows["x.Flac"].e is None


def test_sizes(spark):
    df = spark.createDataFrame([(26214400,), (26214401,), (24 * MIB,), (24 * MIB + 1,)], "n BIGINT")
    rows = df.select(
        audio.size_class("n").alias("c"), audio.size_class("n", auto_split=False).alias("d"),
        audio.size_error("n", auto_split=False).alias("e"), audio.needs_splitting("n").alias("s"),
    ).collect()
    assert [r.c for r in rows] == ["single", "split", "single", "single"]
    assert [r.d for r in rows] == ["single", "too_large", "single", "single"]
    assert rows[1].e == "File too large: 25.0MB" and rows[0].e is None
    assert [r.s for r in rows] == [True, True, False, True]


def test_transcript_path_keeps_the_relative_path(spark):
    paths = {"in/a.mp3": "out/a.txt", "in/sub.d/b c.WAV": "out/sub.d/b c.txt", "in/sub.d/plain": "out/sub.d/plain.txt"}
    df = spark.createDataFrame([(p,) for p in paths], "path STRING")
    for base in ("in", "in/"):
        got = df.select("path", audio.transcript_path("path", base, "out/").alias("t")).collect()
        assert {r.path: r.t for r in got} == paths


def test_split_plan(spark):
    durations = {"a b.mp3": 0.0, "b.x.mp3": 599.9, "c.mp3": 600.0, "d.mp3": 1200.0, "e.mp3": 1500.5}
    plan = tr.split_plan(spark.createDataFrame(list(durations.items()), "path STRING, duration DOUBLE"))
    got = {}
    for r in plan.orderBy("path", "part_ix").collect():
        got.setdefault(r.path, []).append((r.part_ix, r.start_s, r.len_s, r.part_name))
    assert {p: len(v) for p, v in got.items()} == {
        "a b.mp3": 1, "b.x.mp3": 1, "c.mp3": 2, "d.mp3": 3, "e.mp3": 3,
    }
    assert got["e.mp3"][2] == (2, 1200, 600, "e_chunk002.mp3")
    assert got["b.x.mp3"][0][3] == "b.x_chunk000.mp3" and got["a b.mp3"][0][3] == "a b_chunk000.mp3"
    sized = spark.createDataFrame([("a", 0), ("b", 5)], "part STRING, length BIGINT")
    assert [r.part for r in tr.drop_empty_parts(sized).collect()] == ["b"]


@pytest.fixture
def parts(spark):
    rows = [
        ("long", i, f"p{i}", 10.0 + i, "fr", [(0.0, 5.0, "s"), (None, 10.0, "t")]) for i in range(12)
    ]
    rows[4] = ("long", 4, "p4", None, "fr", [(1.0, None, "u")])
    rows[5] = ("long", 5, "p5", 0.0, "en", None)
    rows += [("one", 0, "only", None, "en", [])]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, PART_RESULTS)


@pytest.mark.parametrize("block", [1024, 5, 1])
def test_reassembly(parts, monkeypatch, block):
    monkeypatch.setattr(tr, "BLOCK", block)
    got = {r.file: r for r in tr.combine_results(parts).collect()}
    long = got["long"]
    assert long.text == " ".join(f"p{i}" for i in range(12))
    reported = [0.0 if i in (4, 5) else 10.0 + i for i in range(12)]
    assert (long.duration, long.parts, long.language) == (sum(reported), 12, "fr")
    want = []
    for i in range(12):
        before = sum(reported[:i])
        segments = [(0.0, 5.0), (0.0, 10.0)] if i not in (4, 5) else [(1.0, 0.0)] if i == 4 else []
        want += [(a + before, b + before) for a, b in segments]
    assert [(s.start, s.end) for s in long.segments] == want
    assert (got["one"].text, got["one"].duration, got["one"].segments) == ("only", 0.0, [])
    plain = {r.file: r.text for r in tr.reassemble(parts).collect()}
    assert plain == {f: r.text for f, r in got.items()}


def test_hot_file_is_cut_into_blocks(spark, plan_of):
    """No window or first grouping runs over a whole file."""
    df = spark.range(5000).select(
        F.expr("if(id < 9999, 'hot', 'cold')").alias("file"), F.col("id").cast("int").alias("part_ix"),
        F.col("id").cast("string").alias("text"), F.lit(1.0).alias("duration"),
        F.lit("fr").alias("language"), F.array().cast(PART_RESULTS["segments"].dataType).alias("segments"),
    )
    moved = tr.earlier_total(df, F.col("duration"), "file", "part_ix", "before")
    assert moved.filter("before <> part_ix").count() == 0
    whole = tr.combine_results(df).first()
    assert whole.text == " ".join(map(str, range(5000))) and whole.duration == 5000.0
    windows = [line for line in plan_of(moved).splitlines() if "Window [sum(" in line]
    assert len(windows) == 2 and "[file#" in windows[0] and ", _block#" in windows[0]
    aggregates = [line for line in plan_of(tr.combine_results(df)).splitlines() if "listagg" in line]
    assert "_block#" in aggregates[-1] and "Exchange" in plan_of(tr.combine_results(df))


def test_normalise(spark):
    responses = [{"text": "a"}, {"text": "b", "language": "en", "duration": 2.5, "segments": [{"start": 1}]}]
    df = spark.createDataFrame([(json.dumps(r),) for r in responses], "r STRING")
    rows = [r.x for r in df.select(tr.normalise_result("r", "fr").alias("x")).collect()]
    assert (rows[0].language, rows[0].duration, rows[0].segments) == ("fr", None, [])
    assert (rows[1].language, rows[1].duration, rows[1].segments[0].start) == ("en", 2.5, 1.0)


@pytest.fixture
def speak():
    def transcriber(part, **settings):
        assert settings["language"] == "fr" and settings["temperature"] == 0.0
        if "bad" in part["file"] and part["part_ix"] == 1:
            raise ValueError("broken part")
        if "silent" in part["file"]:
            return {}
        return {
            "text": f"part {part['part_ix']} of {part['part_name']}", "duration": 600.0,
            "segments": [{"start": 0.0, "end": 1.0, "text": "x"}],
        }

    return transcriber


def test_transcribe_directory(spark, speak):
    big = 30 * MIB
    files = [
        ("m/one.mp3", 10, 5.0), ("m/two parts.mp3", big, 1200.0), ("m/bad.mp3", big, 1300.0),
        ("m/silent.mp3", 10, 5.0), ("m/notes.txt", 10, None), ("m/unknown.mp3", big, None),
        ("m/zero.mp3", big, 0.0),
    ]
    df = spark.createDataFrame(files, "path STRING, length BIGINT, duration DOUBLE")
    results = tr.transcribe_directory(df, speak)
    got = {r.file: r for r in results.collect()}
    assert len(got) == len(files)
    assert got["m/one.mp3"].text == "part 0 of one_chunk000.mp3" and got["m/one.mp3"].parts is None
    two = got["m/two parts.mp3"]
    assert (two.parts, two.duration) == (2, 1200.0)
    assert [s.start for s in two.segments] == [0.0, 600.0]
    assert got["m/bad.mp3"].error == "broken part" and got["m/bad.mp3"].text is None
    assert got["m/silent.mp3"].error == "Response without text"
    assert got["m/notes.txt"].error == "Unsupported format: .txt"
    assert got["m/unknown.mp3"].error == "Duration unknown"
    assert got["m/zero.mp3"].error == "Failed to split audio file"
    assert tr.batch_summary(results).first().asDict() == {"found": 7, "succeeded": 2, "failed": 5}
    refused = tr.transcribe_directory(df, speak, auto_split=False)
    reasons = {r.file: r.error for r in refused.collect()}
    assert reasons["m/two parts.mp3"] == "File too large: 30.0MB"
    left = tr.pending(df.withColumnRenamed("path", "file"), results)
    assert left.count() == 5


def test_sidecars_are_matched_or_quarantined(spark):
    texts = spark.createDataFrame([("a", "x"), ("b", "y")], "stem STRING, text STRING")
    records = spark.createDataFrame([("a", "Title"), ("c", "No text")], "stem STRING, title STRING")
    joined = tr.attach_sidecar(texts, records)
    [good] = tr.accepted(joined).collect()
    assert (good.stem, good.metadata.title) == ("a", "Title")
    [lost] = tr.quarantined(joined).collect()
    assert (lost.stem, lost.error) == ("b", "Metadata record not found")


def test_segments_keep_every_key(spark):
    answers = [
        ("a", 0, '{"text": "x", "duration": 2.0, "segments": [{"start": 0, "end": 1.5, "text": "é", "id": 7, "words": [{"w": "é"}], "end_": null}, {"id": 8}]}'),
        ("a", 1, '{"text": "y", "segments": [{"text": "z", "start": 0.25, "end": 1, "score": -0.5}]}'),
        ("b", 0, '{"text": "t", "segments": []}'), ("c", 0, '{"text": "t"}'), ("d", 0, "no json"),
        ("e", 0, '{"text": "t", "segments": [{"start": 1, "end": 2, "text": "s", "score": NaN}]}'),
    ]
    rows = spark.createDataFrame(answers, "file STRING, part_ix INT, response STRING")
    parts = rows.select("file", "part_ix", tr.normalise_result("response").alias("r")).select("file", "part_ix", "r.*")
    whole = tr.combine_results(parts).select("file", tr.segments_json("segments").alias("s")).collect()
    got = {r["file"]: json.loads(r["s"]) for r in whole}
    assert got["a"] == [
        {"start": 0, "end": 1.5, "text": "é", "id": 7, "words": [{"w": "é"}], "end_": None}, {"start": 0, "end": 0, "id": 8},
        {"start": 2.25, "end": 3, "text": "z", "score": -0.5}]
    assert got["b"] == got["c"] == got["d"] == [] and got["e"] == [{"start": 1, "end": 2, "text": "s"}]


def test_directory_run_hands_on_all_keys(spark):
    def speak(part, **settings):
        return {"text": "t", "duration": 600.0, "segments": [{"start": 1.0, "end": 2.0, "text": "s", "part": part["part_ix"]}]}

    files = spark.createDataFrame([("long.mp3", 30_000_000, 900.0), ("short.mp3", 10, 5.0)], "path STRING, length BIGINT, duration DOUBLE")
    found = tr.transcribe_directory(files, speak).select("file", tr.segments_json("segments").alias("s")).collect()
    got = {r["file"]: [(s["start"], s["part"]) for s in json.loads(r["s"])] for r in found}
    assert got == {"long.mp3": [(1.0, 0), (601.0, 1)], "short.mp3": [(1.0, 0)]}


def counted(log):
    """A batch transcriber that notes how many parts each call gets."""
    def speak(parts, **settings):
        with open(log, "a") as out:
            out.write(f"{len(parts)}\n")
        if any(p["text"] == "crash" for p in parts):
            raise RuntimeError("service down")
        return [ValueError("noisy") if p["text"] == "bad" else {"text": p["text"].upper()} for p in parts]

    return speak


def test_a_batch_transcriber_gets_one_call_per_list(spark, tmp_path):
    rows = [(f"f{i}", 0, "bad" if i == 3 else f"t{i}") for i in range(10)]
    parts = spark.createDataFrame(rows, "file STRING, part_ix INT, text STRING").coalesce(1)
    log = str(tmp_path / "calls")
    got = written(tr.transcribe(parts, counted(log), ["file", "part_ix"], batch_size=4), "batched").collect()
    assert {r["file"]: (r["text"], r["error"]) for r in got} == {
        f: (None, "noisy") if t == "bad" else (t.upper(), None) for f, _, t in rows}
    assert open(log).read().split() == ["4", "4", "2"]


def test_a_failed_list_is_tried_part_by_part(spark, tmp_path):
    rows = [("a", 0, "x"), ("b", 0, "crash"), ("c", 0, "y")]
    parts = spark.createDataFrame(rows, "file STRING, part_ix INT, text STRING").coalesce(1)
    log = str(tmp_path / "calls")
    got = written(tr.transcribe(parts, counted(log), ["file", "part_ix"], batch_size=8), "batched").collect()
    assert {r["file"]: (r["text"], r["error"]) for r in got} == {"a": ("X", None), "b": (None, "service down"), "c": ("Y", None)}
    assert open(log).read().split() == ["3", "1", "1", "1"]


def test_directory_run_moves_a_payload_once_and_saves_texts(spark, tmp_path, plan_of):
    files = spark.createDataFrame(
        [("media/show/long one.mp3", 30_000_000, 1500.0, "L" * 1500), ("media/short.mp3", 10, None, "s"), ("media/x.doc", 1, 1.0, "?")],
        "path STRING, length BIGINT, duration DOUBLE, sound STRING")

    def speak(part, **settings):
        text = part["sound"][part["start_s"]:part["start_s"] + part["len_s"]] if part["is_split"] else part["sound"]
        return {"text": f"{part['part_name'] if part['is_split'] else ''}{len(text)}", "duration": float(len(text))}

    results = tr.transcribe_directory(files, speak, ["sound"], save_to=str(tmp_path / "texts"), base="media/")
    got = {r["file"]: (r["text"], r["parts"], r["error"]) for r in results.collect()}
    assert got["media/show/long one.mp3"][0] == " ".join(f"long one_chunk{i:03d}.mp3{n}" for i, n in enumerate((600, 600, 300)))
    assert got["media/short.mp3"][0] == "1" and got["media/x.doc"][2].startswith("Unsupported format")
    saved = {str(p.relative_to(tmp_path / "texts")): p.read_text() for p in (tmp_path / "texts").rglob("*.txt")}
    assert saved == {"show/long one.txt": got["media/show/long one.mp3"][0], "short.txt": "1"}
    tr.save_transcripts(results, str(tmp_path / "whole"))
    assert (tmp_path / "whole" / "media" / "short.txt").read_text() == "1"
    without = tr.transcribe_directory(files.drop("sound"), lambda part, **s: {"text": str(part["start_s"])})
    assert {r["file"]: r["text"] for r in without.collect() if not r["error"]} == {"media/show/long one.mp3": "0 600 1200", "media/short.mp3": "0"}

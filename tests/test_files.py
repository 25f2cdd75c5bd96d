import json

import pytest
from pyspark.errors import AnalysisException

from sonotheca.operators.transcripts import attach_sidecar, quarantined
from sonotheca.schemas import EPISODE
from sonotheca.sources import files, named


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "médias +1"
    (root / "sub").mkdir(parents=True)
    for name in ("a b.mp3", "c.WAV", "d.txt", "é+%.flac", "sub/e.mp3", "sub/f.ogg"):
        (root / name).write_bytes(b"12345")
    return str(root)


def names(df):
    return sorted(r.path.rsplit("/", 1)[1] for r in df.collect())


def test_list_audio(spark, folder):
    assert names(files.list_audio(spark, folder)) == ["a b.mp3", "c.WAV", "é+%.flac"]
    deep = files.list_audio(spark, folder, recursive=True)
    assert names(deep) == ["a b.mp3", "c.WAV", "e.mp3", "f.ogg", "é+%.flac"]
    assert deep.columns == ["path", "modificationTime", "length"]
    assert {r.length for r in deep.collect()} == {5}
    with pytest.raises(AnalysisException):
        files.list_audio(spark, folder + "/none")


def test_list_audio_does_not_read_contents(spark, folder, plan_of):
    assert "content" not in plan_of(files.list_audio(spark, folder))


def test_list_mp3(spark, folder):
    assert names(files.list_mp3(spark, folder)) == ["a b.mp3"]
    assert files.list_mp3(spark, folder + "/none").count() == 0


def test_transcripts_and_sidecars(spark, tmp_path):
    record = {"title": "Été", "podcast": "P", "audio_url": "u", "spotify_url": None, "published_date": None}
    for stem, text in {"Ép 1+%": "Bonjour.\nÇa va?\n", "sans fiche": "x", "cassé": "y"}.items():
        (tmp_path / f"{stem}.txt").write_text(text, encoding="utf-8")
    (tmp_path / "Ép 1+%.json").write_text(json.dumps(record, ensure_ascii=False, indent=4), encoding="utf-8")
    (tmp_path / "cassé.json").write_text("{not json", encoding="utf-8")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "deep.txt").write_text("no")
    texts = files.read_transcripts(spark, str(tmp_path))
    assert {(r.file, r.stem, r.text) for r in texts.collect()} == {
        ("Ép 1+%.txt", "Ép 1+%", "Bonjour.\nÇa va?\n"), ("sans fiche.txt", "sans fiche", "x"),
        ("cassé.txt", "cassé", "y"),
    }
    records = files.read_sidecars(spark, str(tmp_path))
    assert [r.asDict() for r in records.collect()] == [{"stem": "Ép 1+%", **record}]
    lost = quarantined(attach_sidecar(texts, records))
    assert {r.stem for r in lost.collect()} == {"sans fiche", "cassé"}


def test_folders_are_listed_and_read_by_tasks(spark, tmp_path, plan_of):
    many = tmp_path / "many"
    for at in ("", "x/y"):
        (many / at).mkdir(parents=True, exist_ok=True)
        for i in range(30):
            (many / at / f"{at[:1]}{i}.txt").write_text(f"{i}\n")
        (many / at / "empty.txt").write_text("")
        (many / at / "_hidden.txt").write_text("no")
    flat, deep = (files.read_transcripts(spark, str(many), recursive=r) for r in (False, True))
    assert sorted(r.text for r in flat.collect()) == sorted(f"{i}\n" for i in range(30))
    assert deep.count() == 60
    for rows in (flat, files.read_sidecars(spark, str(many)), files.list_audio(spark, str(many))):
        assert "FileScan" not in plan_of(rows)  # whose files the driver would hold
        assert not rows.inputFiles()
    assert files.read_transcripts(spark, f"{many}/x/*").count() == 30  # a pattern is left to Spark


def test_records_of_any_encoding_and_lists_of_records(spark, tmp_path):
    record = {"title": "Été", "podcast": None, "audio_url": "u", "spotify_url": None, "published_date": "d"}
    text = json.dumps(record, ensure_ascii=False)
    for name, body in {"plain": text.encode(), "wide": text.encode("utf-16"), "list": f" [{text}, {text}]".encode(),
                       "null": b'{"title": null}', "blank": b"  ", "number": b"5", "cut": text[:20].encode()}.items():
        (tmp_path / f"{name}.json").write_bytes(body)
    got = sorted((r.stem, r.title) for r in files.read_sidecars(spark, str(tmp_path)).collect())
    assert got == [("list", "Été"), ("list", "Été"), ("null", None), ("plain", "Été"), ("wide", "Été")]


def test_episode_records_round_trip(spark, tmp_path):
    rows = [("Été", "P", "u", None, None), ("b", "P", "u", "s", "2024-01-01T00:00:00")]
    path = str(tmp_path / "records")
    files.write_episode_records(spark.createDataFrame(rows, EPISODE), path)
    assert sorted(map(tuple, files.read_episode_records(spark, path).collect())) == sorted(rows)
    lines = spark.read.text(path).collect()
    assert any("Été" in r.value and '"spotify_url":null' in r.value for r in lines)


def test_text_export_round_trip(spark, tmp_path):
    rows = [("007", "one\ntwo\n"), ("a b", ""), ("é=1", "x\n\n")]
    path = str(tmp_path / "texts")
    files.export_texts(spark.createDataFrame(rows, "stem STRING, text STRING"), path)
    assert sorted(map(tuple, files.read_exported_texts(spark, path).collect())) == sorted(rows)


def test_transcript_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a.mp3", "x")], "file STRING, text STRING")
    files.write_transcripts(df, path)
    files.write_transcripts(df, path)
    assert spark.read.parquet(path).count() == 2


def found(folder):
    return {str(p.relative_to(folder)): p.read_text() for p in folder.rglob("*") if p.is_file() and not p.name.startswith((".", "_"))}


def named_rows(spark, rows):
    return spark.createDataFrame(rows, "name STRING, text STRING")


def test_named_files_keep_names_paths_and_texts(spark, tmp_path):
    rows = [("talk 7.txt", "one\ntwo"), ("show/é + %.txt", ""), ("a:b?.txt", None), (".hidden.txt", "h"), ("../up.txt", "u"), ("/abs//x.txt", "x")]
    named.write_named(named_rows(spark, rows), str(tmp_path / "flat"))
    files_there = found(tmp_path / "flat")
    assert files_there["talk 7.txt"] == "one\ntwo" and files_there["show/é + %25.txt"] == "" and len(files_there) == 6
    got = {r["name"]: r["text"] for r in named.read_named(spark, str(tmp_path / "flat"), ".txt").collect()}
    assert got == {n.replace("/abs//", "abs/"): t or "" for n, t in rows}
    named.write_named(named_rows(spark, rows), str(tmp_path / "dealt"), folders=16)
    assert all(p[:4].isdigit() for p in found(tmp_path / "dealt"))
    assert {r["name"]: r["text"] for r in named.read_named(spark, str(tmp_path / "dealt"), ".txt", 16).collect()} == got
    assert not list((tmp_path / "flat" / "_manifests").iterdir())
    assert json.loads((tmp_path / "flat" / "_SUCCESS").read_text()) == {"files": 6, "bytes": 10}


def test_rows_of_one_name_and_written_again(spark, tmp_path):
    folder = tmp_path / "again"
    named.write_named(named_rows(spark, [("a.txt", "1"), ("a.txt", "3"), ("a.txt", "2"), ("b.txt", "b")]), str(folder))
    assert found(folder) == {"a.txt": "3", "b.txt": "b"}
    named.write_named(named_rows(spark, [("a.txt", "new")]), str(folder))
    assert found(folder) == {"a.txt": "new", "b.txt": "b"}
    named.write_named(named_rows(spark, []), str(folder))
    assert found(folder) == {"a.txt": "new", "b.txt": "b"}


def test_failed_job_takes_its_new_files_back(spark, tmp_path):
    folder = tmp_path / "failed"
    named.write_named(named_rows(spark, [("old.txt", "o")]), str(folder))
    with pytest.raises(Exception, match="a file needs a name"):
        named.write_named(named_rows(spark, [(f"n{i}.txt", "x") for i in range(20)] + [(None, "lost")]), str(folder))
    assert found(folder) == {"old.txt": "o"}


def test_named_files_need_no_data_source_worker(spark, tmp_path, monkeypatch):
    def refused(self, source):
        raise AssertionError("each write through a data source leaves three Python workers beside the driver")

    monkeypatch.setattr(type(spark.dataSource), "register", refused)
    named.write_named(named_rows(spark, [(f"n{i}.txt", str(i)) for i in range(30)]), str(tmp_path / "out"), folders=4)
    assert sorted(found(tmp_path / "out").values(), key=int) == [str(i) for i in range(30)]
    assert json.loads((tmp_path / "out" / "_SUCCESS").read_text())["files"] == 30


def test_a_repeated_task_leaves_one_file(monkeypatch, tmp_path):
    import pyarrow as pa

    class Context:
        def partitionId(self):
            return 0

        def taskAttemptId(self):
            return next(attempts)

    attempts = iter(range(9))
    monkeypatch.setattr(named.TaskContext, "get", Context)
    writer = named._Writer(str(tmp_path), 0)
    batch = pa.RecordBatch.from_pydict({"name": ["a.txt", "b.txt"], "text": ["1", "2"]})

    def lost():
        yield batch
        raise OSError("executor lost")

    with pytest.raises(OSError):
        writer.write(lost())
    message = writer.write(iter([batch]))
    writer.commit([message])
    assert found(tmp_path) == {"a.txt": "1", "b.txt": "2"}
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith(".")] == []

"""Rows as files of their own, under the row's name: a sink, and the source that reads them back.

Tasks write the files, and the job is committed, or taken back, once they have ended.
``write_named`` runs them as a map over Arrow batches; the data source ``named_files`` has the
same writer, but Spark keeps three more Python workers beside the driver for each of its writes.
Files go through ``pyarrow.fs``, which knows the local file system and the common stores; the
folder must be one that all executors reach.

Names are relative paths such as ``show/talk 7.txt``; what lies between slashes is
percent-encoded where a file system or Spark would not take it as it is.  With ``folders``
above 0 the files are dealt to that many sub-folders by a hash of the name, because stores
slow down with very many files in one folder.

A file is written under a hidden name and then moved to its own, so a reader sees it whole
or not at all, and a task that is repeated, or runs twice at a time, leaves one file.  Each
task lists what it wrote in a manifest.  The commit leaves ``_SUCCESS`` with the totals;
when a job fails, the manifests tell which new files to take back.  Files of other names in
the folder stay.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

FORMAT = "named_files"
FILES_PER_TASK = 256
BATCH_BYTES = 1 << 20
_UNSAFE = re.compile(r'[\x00-\x1f\x7f"*:<>?\\|%#]')


def _piece(text: str) -> str:
    """One step of a path: unsafe characters, a hidden start and names made of dots are encoded."""
    safe = _UNSAFE.sub(lambda m: quote(m[0], safe=""), text)
    return "%" + format(ord(safe[0]), "02X") + safe[1:] if safe[:1] in (".", "_") else safe


def file_path(name: str, folders: int = 0) -> str:
    """Where the file of a name lies below the folder of the sink."""
    steps = [_piece(step) for step in name.split("/") if step]
    if not steps:
        raise ValueError("a file needs a name")
    if folders:
        steps.insert(0, f"{zlib.crc32(name.encode()) % folders:04d}")
    return "/".join(steps)


@dataclass
class Written(WriterCommitMessage):
    files: int
    bytes: int
    manifest: str


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"[a-z0-9]+:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    return fs.LocalFileSystem(), path


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, folders: int):
        self.folder, self.folders, self.job = folder, folders, uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, root = _file_system(self.folder)
        context = TaskContext.get()
        attempt = f"{self.job}-{context.partitionId()}-{context.taskAttemptId()}"
        new, files, size, made = [], 0, 0, set()
        manifest = f"{root}/_manifests/{attempt}"
        try:
            for batch in batches:
                for name, text in zip(batch.column("name"), batch.column("text")):
                    if not name.is_valid:
                        raise ValueError("a file needs a name")
                    path = f"{root}/{file_path(name.as_py(), self.folders)}"
                    above, _, last = path.rpartition("/")
                    if above not in made:
                        system.create_dir(above, recursive=True)
                        made.add(above)
                    body = (text.as_py() or "").encode()
                    hidden = f"{above}/.{zlib.crc32(last.encode()):08x}-{attempt}"
                    with system.open_output_stream(hidden) as out:
                        out.write(body)
                    if system.get_file_info(path).type == fs.FileType.NotFound:
                        new.append(path)
                    system.move(hidden, path)
                    files, size = files + 1, size + len(body)
        finally:  # also a task that fails says what it has left
            system.create_dir(f"{root}/_manifests", recursive=True)
            with system.open_output_stream(manifest) as out:
                out.write(json.dumps(new).encode())
        return Written(files, size, manifest)

    def tasks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``write`` as a map over Arrow batches; its message is a row."""
        done = self.write(batches)
        yield pa.RecordBatch.from_pydict({"files": [done.files], "bytes": [done.bytes], "manifest": [done.manifest]})

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _file_system(self.folder)
        done = [m for m in messages if m is not None]
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/_SUCCESS") as out:
            out.write(json.dumps({"files": sum(m.files for m in done), "bytes": sum(m.bytes for m in done)}).encode())
        self._forget(system, root)

    def abort(self, messages: list[Written | None]) -> None:
        system, root = _file_system(self.folder)
        for path in self._manifests(system, root):
            with system.open_input_stream(path) as given:
                for file in json.loads(given.read()):
                    if system.get_file_info(file).type == fs.FileType.File:
                        system.delete_file(file)
        self._forget(system, root)

    def _manifests(self, system: fs.FileSystem, root: str) -> list[str]:
        found = system.get_file_info(fs.FileSelector(f"{root}/_manifests", allow_not_found=True))
        return [f.path for f in found if f.base_name.startswith(self.job)]

    def _forget(self, system: fs.FileSystem, root: str) -> None:
        for path in self._manifests(system, root):
            system.delete_file(path)


@dataclass
class _Share(InputPartition):
    """A sub-folder to read whole, or files of the folder itself."""

    folder: str | None
    files: list[str]


class _Reader(DataSourceReader):
    """Sub-folders are listed by the tasks that read them; the driver lists the folder itself only."""

    def __init__(self, folder: str, folders: int, suffix: str):
        self.folder, self.folders, self.suffix = folder, folders, suffix

    def _wanted(self, info: fs.FileInfo) -> bool:
        below = info.path[len(_file_system(self.folder)[1]):].strip("/")
        hidden = any(step[:1] in ("_", ".") for step in below.split("/"))
        return info.type == fs.FileType.File and below.endswith(self.suffix) and not hidden

    def partitions(self) -> list[_Share]:
        system, root = _file_system(self.folder)
        there = system.get_file_info(fs.FileSelector(root))
        files = [i.path for i in there if self._wanted(i)]
        shares = [_Share(None, files[at:at + FILES_PER_TASK]) for at in range(0, len(files), FILES_PER_TASK)]
        inner = [_Share(i.path, []) for i in there if i.type == fs.FileType.Directory and i.base_name[:1] not in ("_", ".")]
        return [*shares, *inner] or [_Share(None, [])]

    def read(self, share: _Share) -> Iterator[pa.RecordBatch]:
        system, root = _file_system(self.folder)
        files = share.files
        if share.folder:
            files = [i.path for i in system.get_file_info(fs.FileSelector(share.folder, recursive=True)) if self._wanted(i)]
        names, texts, size = [], [], 0
        for path in [*sorted(files), None]:
            if names and (path is None or size > BATCH_BYTES):
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["name", "text"])
                names, texts, size = [], [], 0
            if path is not None:
                with system.open_input_stream(path) as given:
                    body = given.read()
                below = path[len(root):].strip("/")
                names.append(unquote(below.split("/", 1)[1] if self.folders else below))
                texts.append(body.decode("utf-8", "replace"))
                size += len(body)


class NamedFiles(DataSource):
    """``named_files``: rows ``name, text``, each a file below the option ``path``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name STRING, text STRING"

    def _options(self) -> tuple[str, int]:
        return self.options["path"].rstrip("/"), int(self.options.get("folders", 0))

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(*self._options())

    def reader(self, schema) -> _Reader:
        return _Reader(*self._options(), self.options.get("suffix", ""))


def write_named(rows: DataFrame, folder: str, name: str = "name", text: str = "text", folders: int = 0) -> None:
    """Write ``text`` of every row to a file ``name`` below ``folder``.

    Rows of one name share a file; the greatest text stays.  A null text is an empty file, a
    row without name an error.  Creating the files is the work here, so they are spread over
    all tasks however few bytes they hold.
    """
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = rows.select(F.col(name).cast("string").alias("name"), F.col(text).cast("string").alias("text")).repartition(tasks, "name")
    writer = _Writer(folder.rstrip("/"), folders)
    written = placed.sortWithinPartitions("name", "text").mapInArrow(writer.tasks, "files BIGINT, bytes BIGINT, manifest STRING")
    try:
        messages = [Written(*row) for row in written.collect()]  # a row a task
    except Exception:
        writer.abort([])
        raise
    writer.commit(messages)


def read_named(spark: SparkSession, folder: str, suffix: str = "", folders: int = 0) -> DataFrame:
    """``name, text`` of the files that ``write_named`` left, also of empty ones.

    Spark's own file sources list no empty files, so this is the sink's counterpart.
    """
    spark.dataSource.register(NamedFiles)
    return spark.read.format(FORMAT).options(path=folder, folders=folders, suffix=suffix).load()

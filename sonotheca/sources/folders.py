"""Folders of very many files, listed and read by tasks.

Spark's own file sources keep the status of every file in the driver and plan a partition for
every few small files.  Here one task names what a folder holds, the names are dealt out, and the
tasks look at the files themselves, so the driver sees one path however many files there are.

Files go through ``pyarrow.fs``, as in ``named``.  What counts as a file is what Spark's
sources count: names that start with ``.`` or ``_`` and empty files do not.  ``names`` gives None
for what it cannot list as a folder (a pattern, a single file, a store that only Spark knows,
a missing folder); the caller then leaves it to Spark.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonotheca.sources.named import _file_system

NAMES_PER_BATCH = 10_000
BATCH_BYTES = 1 << 20


def _is_hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(system: fs.FileSystem, folder: str) -> Iterator[tuple[str, bool]]:
    """Path of everything visible in a folder, and whether it is a folder itself."""
    if isinstance(system, fs.LocalFileSystem):
        with os.scandir(folder) as found:
            for entry in found:
                if not _is_hidden(entry.name):
                    yield f"{folder}/{entry.name}", entry.is_dir()
    else:
        for info in system.get_file_info(fs.FileSelector(folder)):
            if not _is_hidden(info.base_name):
                yield info.path, info.type == fs.FileType.Directory


def _below(system: fs.FileSystem, folder: str) -> Iterator[tuple[str, bool]]:
    """The files of a folder and of all folders inside it."""
    for path, is_dir in _entries(system, folder):
        if is_dir:
            yield from _below(system, path)
        else:
            yield path, False


def _list(uri: str, suffix: str, deep: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``place, is_dir`` of what the given folders hold, files of the suffix only."""
    system = _file_system(uri)[0]
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            places, are_dirs = [], []
            for path, is_dir in _below(system, folder) if deep else _entries(system, folder):
                if is_dir or path.endswith(suffix):
                    places.append(path)
                    are_dirs.append(is_dir)
                if len(places) == NAMES_PER_BATCH:
                    yield _listed(places, are_dirs)
                    places, are_dirs = [], []
            if places:
                yield _listed(places, are_dirs)


def _listed(places: list[str], are_dirs: list[bool]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(places, pa.string()), pa.array(are_dirs, pa.bool_())], names=["place", "is_dir"])


def _stat(uri: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Time in milliseconds and size of the files, as Spark reports them."""
    system = _file_system(uri)[0]
    for batch in batches:
        infos = system.get_file_info(batch.column(0).to_pylist())
        times = [None if i.mtime_ns is None else i.mtime_ns // 1_000_000 * 1000 for i in infos]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(times, pa.timestamp("us", "UTC")), pa.array([i.size for i in infos], pa.int64())],
            names=["place", "modificationTime", "length"])


def _read(uri: str, of: Callable[[bytes], bytes] | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Name and content of the files that hold something."""
    system = _file_system(uri)[0]

    def made(names: list[str], bodies: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bodies, pa.binary())], names=["name", "body"])

    for batch in batches:
        names, bodies, size = [], [], 0
        for place in batch.column(0).to_pylist():
            with system.open_input_file(place) as given:
                body = given.read()
            if not body:
                continue
            names.append(place.rpartition("/")[2])
            bodies.append(body if of is None else of(body))
            size += len(body)
            if size > BATCH_BYTES:
                yield made(names, bodies)
                names, bodies, size = [], [], 0
        if names:
            yield made(names, bodies)


def as_utf8(body: bytes) -> bytes:
    """JSON in any of its encodings as UTF-8 without byte order mark."""
    code = json.detect_encoding(body)
    return body if code == "utf-8" else body.decode(code, "replace").encode()


def _folder(folder: str) -> tuple[str, str] | None:
    """The folder as the tasks know it: its address, and its path in the file system of that address."""
    uri = folder if ":/" in folder else os.path.abspath(folder)
    try:
        system, root = _file_system(uri)
        return (uri, root.rstrip("/")) if system.get_file_info(root.rstrip("/") or "/").type == fs.FileType.Directory else None
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None


def _dealt(names: DataFrame) -> DataFrame:
    """Looking at a file is the work, so names are dealt to all tasks however few bytes they are."""
    spark = names.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return names.repartition(tasks)


def _names(spark: SparkSession, uri: str, root: str, suffix: str, recursive: bool) -> DataFrame:
    listing = functools.partial(_list, uri, suffix)
    top = spark.range(0, 1, 1, 1).select(F.lit(root).alias("folder")).mapInArrow(
        functools.partial(listing, False), "place STRING, is_dir BOOLEAN")
    files = top.filter("NOT is_dir").select("place")
    if not recursive:
        return files
    inner = _dealt(top.filter("is_dir").select("place")).mapInArrow(
        functools.partial(listing, True), "place STRING, is_dir BOOLEAN")
    return files.unionByName(inner.select("place"))


def list_files(spark: SparkSession, folder: str, suffix: str = "", recursive: bool = False) -> DataFrame | None:
    """``path, modificationTime, length`` of the files of a folder, as Spark's ``binaryFile`` gives them."""
    found = _folder(folder)
    if found is None:
        return None
    uri, root = found
    above = uri[:uri.index(":") + 1] if ":/" in uri else "file:"
    if above != "file:":
        above += "//"
    looked = _dealt(_names(spark, uri, root, suffix, recursive)).mapInArrow(
        functools.partial(_stat, uri), "place STRING, modificationTime TIMESTAMP, length BIGINT")
    return looked.filter("length > 0").select(F.concat(F.lit(above), F.col("place")).alias("path"), "modificationTime", "length")


def read_files(
    spark: SparkSession, folder: str, suffix: str, recursive: bool = False, of: Callable[[bytes], bytes] | None = None,
) -> DataFrame | None:
    """``name, body`` of the files of a folder; ``of`` is applied to every body on the way."""
    found = _folder(folder)
    if found is None:
        return None
    uri, root = found
    names = _dealt(_names(spark, uri, root, suffix, recursive))
    return names.mapInArrow(functools.partial(_read, uri, of), "name STRING, body BINARY")

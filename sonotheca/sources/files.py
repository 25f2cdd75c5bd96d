"""Audio listings, transcript texts and metadata records: reading and writing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonotheca.fixed_values import EPISODE_FIELDS
from sonotheca.functions.audio import is_audio
from sonotheca.schemas import EPISODE, LISTING
from sonotheca.sources.feeds import file_stem, stem_of
from sonotheca.sources.folders import as_utf8, list_files, read_files
from sonotheca.sources.named import read_named, write_named

EXPORT_FOLDERS = 256


def _missing(problem: AnalysisException) -> bool:
    return problem.getCondition() == "PATH_NOT_FOUND"


def _listing(spark: SparkSession, folder: str, recursive: bool, suffix: str = "") -> DataFrame:
    listed = list_files(spark, folder, suffix, recursive)
    if listed is not None:
        return listed
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", f"*{suffix}")
    return reader.load(folder).select(*LISTING.fieldNames())


def list_audio(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Path, time and size of the audio files in a folder; contents are not read.

    A missing folder is an error.  Spark lists no files that start with ``.`` or ``_``.
    """
    return _listing(spark, folder, recursive).filter(is_audio("path"))


def list_mp3(spark: SparkSession, folder: str) -> DataFrame:
    """Only ``*.mp3`` of the folder itself; a missing folder means no work."""
    try:
        return _listing(spark, folder, False, ".mp3")
    except AnalysisException as problem:
        if not _missing(problem):
            raise
        return spark.createDataFrame([], LISTING)


def read_transcripts(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """``file, stem, text``: every ``*.txt`` of the folder as one row."""
    found = read_files(spark, folder, ".txt", recursive)
    if found is None:
        texts = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt", recursiveFileLookup=recursive)
        stem, text = file_stem(F.col("_metadata.file_name")), F.col("value")
    else:
        texts, stem, text = found, stem_of(F.col("name")), F.col("body").cast("string")
    return texts.select(F.concat(stem, F.lit(".txt")).alias("file"), stem.alias("stem"), text.alias("text"))


def read_sidecars(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """``stem`` and the five metadata fields of every ``*.json`` of the folder.

    A file that is not a readable record yields no row, so its transcript ends up
    among the quarantined ones.
    """
    schema = T.StructType(EPISODE.fields + [T.StructField("_bad", T.StringType())])
    found = read_files(spark, folder, ".json", recursive, as_utf8)
    if found is None:
        records = spark.read.schema(schema).json(
            folder, multiLine=True, columnNameOfCorruptRecord="_bad", pathGlobFilter="*.json", recursiveFileLookup=recursive
        )
        stem = file_stem(F.col("_metadata.file_name")).alias("stem")
        return records.select(stem, *EPISODE_FIELDS, "_bad").filter("_bad IS NULL").drop("_bad")
    text = F.col("body").cast("string")
    one = F.from_json(text, schema, {"columnNameOfCorruptRecord": "_bad"})
    # a list of records is a row for each, as in Spark's own source
    records = F.when(text.rlike(r"\A\s*\["), F.from_json(text, T.ArrayType(EPISODE))).otherwise(
        F.when(one.isNotNull() & one["_bad"].isNull(), F.array(F.struct(*(one[c].alias(c) for c in EPISODE_FIELDS)))))
    return found.select(stem_of(F.col("name")).alias("stem"), F.explode(records).alias("record")).filter(
        "record IS NOT NULL").select("stem", "record.*")


def write_episode_records(episodes: DataFrame, path: str, mode: str = "append") -> None:
    """The five-field records as JSON lines; nulls are written, text stays UTF-8."""
    episodes.select(*EPISODE_FIELDS).write.mode(mode).json(path, ignoreNullFields=False)


def read_episode_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EPISODE).json(path)


def write_transcripts(transcripts: DataFrame, path: str, mode: str = "append") -> None:
    """The transcripts as a table keyed by ``file``."""
    transcripts.write.mode(mode).parquet(path)


def export_texts(transcripts: DataFrame, path: str, stem: str = "stem", folders: int = EXPORT_FOLDERS) -> None:
    """A text file per transcript, named by its stem, for readers of plain text.

    A stem may be a relative path, which is kept.  The files are dealt to ``folders``
    sub-folders; 0 puts them into ``path`` itself.
    """
    named = transcripts.select(F.concat(F.col(stem), F.lit(".txt")).alias("name"), "text")
    write_named(named, path, folders=folders)


def read_exported_texts(spark: SparkSession, path: str, folders: int = EXPORT_FOLDERS) -> DataFrame:
    """``stem, text`` of an export, exactly as they were."""
    texts = read_named(spark, path, ".txt", folders)
    return texts.select(F.regexp_replace("name", r"\.txt$", "").alias("stem"), "text")

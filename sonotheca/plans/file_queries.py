"""File sources: rows of a table written as one file each and read back through the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonotheca.fixed_values import EPISODE_FIELDS
from sonotheca.operators import store as st
from sonotheca.plans import batch
from sonotheca.plans.registry import Tables, query
from sonotheca.plans.transcript_queries import CHUNKS_SQL
from sonotheca.session import fresh_dir
from sonotheca.sources import files
from sonotheca.sources.named import write_named


def _file_each(rows: DataFrame, body: Column, suffix: Column, path: str, folders: int = 0) -> str:
    """Every row as a file of its own under a running number, dealt to sub-folders where there are very many."""
    name = F.concat(F.lit("part "), F.monotonically_increasing_id(), F.lit("."), suffix)
    write_named(rows.select(name.alias("name"), F.concat(body, F.lit("\n")).alias("text")), path, folders=folders)
    return path


def _recordings(t: Tables) -> str:
    """A folder with a file per supplier, of three suffixes in turn; contents stand for sound."""
    sound = F.repeat(F.lit("x"), (F.col("s_suppkey") % 50 + 1).cast("int")).alias("sound")
    suffix = F.get(F.array(*(F.lit(s) for s in ("mp3", "wav", "txt"))), (F.col("s_suppkey") % 3).cast("int"))
    chosen = t.supplier.filter(F.col("s_suppkey") % 3 >= 0)
    return _file_each(chosen, F.to_csv(F.struct(sound)), suffix, fresh_dir(t.spark, "audio"))


def _suffix() -> Column:
    return F.regexp_extract("path", r"[^.]+$", 0).alias("suffix")


_RECORDINGS_SQL = """
SELECT s_suppkey % 50 + 2 AS length, CASE s_suppkey % 3 WHEN 0 THEN 'mp3' ELSE 'wav' END AS suffix
FROM supplier WHERE s_suppkey % 3 IN {}"""


@query(_RECORDINGS_SQL.format("(0, 1)"))
def list_audio_files(t: Tables) -> DataFrame:
    return files.list_audio(t.spark, _recordings(t)).select("length", _suffix())


@query(_RECORDINGS_SQL.format("(0)"))
def list_mp3_files(t: Tables) -> DataFrame:
    return files.list_mp3(t.spark, _recordings(t)).select("length", _suffix())


@query("SELECT text, true AS named FROM documents")
def transcript_files(t: Tables) -> DataFrame:
    """Every document as a text file; the writer ends it with a line break."""
    folder = _file_each(t.documents, F.coalesce("text", F.lit("")), F.lit("txt"), fresh_dir(t.spark, "texts"), files.EXPORT_FOLDERS)
    return files.read_transcripts(t.spark, folder, recursive=True).select(
        F.regexp_replace("text", r"\n\z", "").alias("text"),
        (F.col("file") == F.concat("stem", F.lit(".txt"))).alias("named"),
    )


def _record(number: Column) -> list[Column]:
    """The five fields of a record; every third has no date and none has a catalogue link."""
    date = F.date_format(F.timestamp_seconds(F.lit(1704067200) + number * 60), "yyyy-MM-dd'T'HH:mm:ss")
    values = (F.concat(F.lit("talk "), number), F.concat(F.lit("Show é "), number % 7), F.concat(F.lit("https://a.example/"), number),
              F.lit(None).cast("string"), F.when(number % 3 > 0, date))
    return [value.alias(name) for value, name in zip(values, EPISODE_FIELDS)]


_RECORD_SQL = """'talk ' || {0} AS title, 'Show é ' || {0} % 7 AS podcast, 'https://a.example/' || {0} AS audio_url,
       CAST(NULL AS VARCHAR) AS spotify_url,
       CASE WHEN {0} % 3 > 0 THEN strftime(TIMESTAMP '2024-01-01' + {0} * INTERVAL 1 MINUTE, '%Y-%m-%dT%H:%M:%S') END
         AS published_date"""


@query(f"SELECT {_RECORD_SQL.format('doc_id')} FROM labels")
def sidecar_files(t: Tables) -> DataFrame:
    """Every label as a metadata record in a file of its own."""
    record = F.to_json(F.struct(*_record(F.col("doc_id"))), {"ignoreNullFields": "false"})
    folder = _file_each(t.labels, record, F.lit("json"), fresh_dir(t.spark, "records"), files.EXPORT_FOLDERS)
    return files.read_sidecars(t.spark, folder, recursive=True).select(*EPISODE_FIELDS)


@query(f"""
WITH RECURSIVE {CHUNKS_SQL}
SELECT 'talk_' || c.doc_id || '_' || c.chunk_ix AS id, c.document, r.published_date
FROM chunks c JOIN (SELECT doc_id, {_RECORD_SQL.format('doc_id')} FROM labels) r ON r.doc_id = c.doc_id""")
def store_folder(t: Tables) -> DataFrame:
    """A landing folder with a text file per document, and a record for those with a label."""
    folder, root = fresh_dir(t.spark, "landing"), fresh_dir(t.spark, "store")
    number = F.col("doc_id")

    def name(suffix: str) -> Column:
        return F.concat(F.lit("talk "), number, F.lit(suffix)).alias("name")

    record = F.to_json(F.struct(*_record(number)), {"ignoreNullFields": "false"})
    landed = t.documents.select(name(".txt"), "text").unionByName(t.labels.select(name(".json"), record.alias("text")))
    write_named(landed, folder, folders=files.EXPORT_FOLDERS)
    batch.store_folder(t.spark, root, folder, "shelf", recursive=True)
    return st.current_chunks(t.spark, root, "shelf").select("id", "document", F.col("metadata.published_date").alias("published_date"))

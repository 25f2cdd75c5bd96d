"""Transcript-side queries.  Documents stand for recordings and transcripts, conversations
for the part results of split recordings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonotheca.functions import audio
from sonotheca.functions.sql import register_functions
from sonotheca.functions.text import non_blank
from sonotheca.operators import chunking, dispatch, service_log
from sonotheca.operators import transcripts as tr
from sonotheca.plans.registry import Tables, query
from sonotheca.session import fresh_dir, spread, written
from sonotheca.sources.files import export_texts, read_exported_texts, write_transcripts

SENTENCES_SQL = r"""
sents AS (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?]) +', '\1' || chr(1), 'g'), chr(1)) AS s
  FROM documents WHERE regexp_matches(text, '\S'))"""

# The chunk boundaries as a recurrence on prefix sums p of the sentence lengths:
# chunk [a, c) ends before the first sentence that would pass 1000, and the next one
# starts at the first sentence whose distance to c stays below 100.
CHUNKS_SQL = f"""
{SENTENCES_SQL},
lens AS (SELECT doc_id, s, len(s) AS n, list_transform(s, lambda x: length(x)) AS l FROM sents),
sums AS (
  SELECT doc_id, s, n,
         list_transform(range(0, n + 1), lambda q: coalesce(list_sum(l[1:q]), 0)::BIGINT) AS p
  FROM lens),
cuts AS (
  SELECT doc_id, 0::BIGINT AS chunk_ix, 0::BIGINT AS a,
         coalesce(list_min(list_filter(range(1, n), lambda q: p[q + 2] > 1000)), n) AS c
  FROM sums
  UNION ALL
  SELECT doc_id, chunk_ix + 1, a2,
         coalesce(list_min(list_filter(range(c + 1, n), lambda q: p[q + 2] - p[a2 + 1] > 1000)), n)
  FROM (
    SELECT k.doc_id, k.chunk_ix, k.c, u.n, u.p,
           coalesce(list_min(list_filter(range(k.a, k.c), lambda q: u.p[k.c + 1] - u.p[q + 1] < 100)), k.c) AS a2
    FROM cuts k JOIN sums u ON k.doc_id = u.doc_id WHERE k.c < u.n)),
chunks AS (
  SELECT k.doc_id, k.chunk_ix, array_to_string(u.s[k.a + 1:k.c], ' ') AS document
  FROM cuts k JOIN sums u ON k.doc_id = u.doc_id)"""


def doc_file(suffix: str = ".txt") -> Column:
    return F.concat(F.lit("doc "), F.col("doc_id"), F.lit(suffix)).alias("file")


def chunk_rows(t: Tables) -> DataFrame:
    """``doc_id, file, chunk_ix, document, id`` of all documents."""
    return chunking.chunk_transcripts(spread(t.documents.select("doc_id", doc_file(), "text")))


@query(rf"""
WITH {SENTENCES_SQL}
SELECT doc_id, unnest(range(len(s))) AS sentence_ix, unnest(s) AS sentence FROM sents""")
def sentences(t: Tables) -> DataFrame:
    return chunking.sentences(spread(t.documents.select("doc_id", "text")))


@query(rf"""
WITH {SENTENCES_SQL}
SELECT doc_id, sentence_ix FROM (
  SELECT doc_id, unnest(range(len(s))) AS sentence_ix, unnest(s) AS sentence FROM sents)
WHERE regexp_matches(sentence, '\S')""")
def non_blank_sentences(t: Tables) -> DataFrame:
    cut = chunking.sentences(spread(t.documents.select("doc_id", "text")))
    return cut.filter(non_blank("sentence")).select("doc_id", "sentence_ix")


@query(f"WITH RECURSIVE {CHUNKS_SQL} SELECT doc_id, chunk_ix, document FROM chunks")
def chunks(t: Tables) -> DataFrame:
    return chunk_rows(t).select("doc_id", "chunk_ix", "document")


@query(f"""
WITH RECURSIVE {CHUNKS_SQL}
SELECT replace('doc ' || doc_id, ' ', '_') || '_' || chunk_ix AS id, length(document) AS chars FROM chunks""")
def chunk_ids(t: Tables) -> DataFrame:
    return chunk_rows(t).select("id", F.length("document").alias("chars"))


@query(f"""
WITH RECURSIVE {CHUNKS_SQL}
SELECT 'doc ' || doc_id || '.txt' AS file, count(*) AS chunks FROM chunks GROUP BY ALL""")
def chunks_per_doc(t: Tables) -> DataFrame:
    return chunking.chunks_per_file(chunk_rows(t))


def _sidecars(t: Tables) -> DataFrame:
    return t.labels.select("doc_id", "quality", "toxic")


@query("""
SELECT d.doc_id, md5(d.text) AS digest, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def sidecar_join(t: Tables) -> DataFrame:
    joined = tr.attach_sidecar(t.documents.select("doc_id", "text"), _sidecars(t), "doc_id")
    return tr.accepted(joined).select("doc_id", F.md5("text").alias("digest"), "metadata.*")


@query("""
SELECT doc_id, 'Metadata record not found' AS error
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def sidecar_missing(t: Tables) -> DataFrame:
    joined = tr.attach_sidecar(t.documents.select("doc_id"), _sidecars(t), "doc_id")
    return tr.quarantined(joined).select("doc_id", "error")


@query(f"""
WITH RECURSIVE {CHUNKS_SQL}
SELECT 'doc_' || c.doc_id || '_' || c.chunk_ix AS id, l.quality, l.toxic
FROM chunks c JOIN labels l ON c.doc_id = l.doc_id""")
def chunk_metadata(t: Tables) -> DataFrame:
    texts = spread(t.documents.select("doc_id", doc_file(), "text"))
    joined = tr.accepted(tr.attach_sidecar(texts, _sidecars(t), "doc_id"))
    return chunking.chunk_transcripts(joined).select("id", "metadata.*")


def _listing(t: Tables) -> DataFrame:
    """A file listing made of the documents, with mixed suffixes and sizes around the limit."""
    kinds = F.array(*(F.lit(s) for s in (".mp3", ".WAV", ".txt", ".flac", ".m4a", ".Ogg", "")))
    suffix = F.get(kinds, (F.col("doc_id") % 7).cast("int"))
    return t.documents.select(
        "doc_id", F.concat(F.lit("media/v1.0/doc "), F.col("doc_id"), suffix).alias("path"),
        (F.col("n_chars") * 20000).alias("length"),
    )


_LISTING_SQL = """
listing AS (
  SELECT doc_id, ['.mp3', '.WAV', '.txt', '.flac', '.m4a', '.Ogg', ''][doc_id % 7 + 1] AS suffix,
         n_chars * 20000 AS length FROM documents)"""
_BAD_SQL = "suffix IN ('.txt', '')"


@query(f"WITH {_LISTING_SQL} SELECT doc_id, length FROM listing WHERE NOT {_BAD_SQL}")
def list_audio(t: Tables) -> DataFrame:
    return _listing(t).filter(audio.is_audio("path")).select("doc_id", "length")


@query(f"""
WITH {_LISTING_SQL}
SELECT doc_id, CASE WHEN {_BAD_SQL} THEN 'Unsupported format: ' || suffix END AS error FROM listing""")
def valid_format(t: Tables) -> DataFrame:
    return _listing(t).select("doc_id", audio.format_error("path").alias("error"))


@query(f"""
WITH {_LISTING_SQL}
SELECT doc_id, CASE WHEN length > 26214400 THEN 'split' ELSE 'single' END AS class,
       CASE WHEN length > 26214400 THEN printf('File too large: %.1fMB', length / 1048576.0) END AS error
FROM listing""")
def size_class(t: Tables) -> DataFrame:
    return _listing(t).select(
        "doc_id", audio.size_class("length").alias("class"),
        audio.size_error("length", auto_split=False).alias("error"),
    )


@query(f"WITH {_LISTING_SQL} SELECT doc_id, length > 24 * 1048576 AS needs_splitting FROM listing")
def needs_splitting(t: Tables) -> DataFrame:
    return _listing(t).select("doc_id", audio.needs_splitting("length").alias("needs_splitting"))


@query(f"""
WITH {_LISTING_SQL} SELECT doc_id, 'texts/v1.0/doc ' || doc_id || '.txt' AS output FROM listing""")
def transcript_paths(t: Tables) -> DataFrame:
    return _listing(t).select(
        "doc_id", audio.transcript_path("path", "media/", "texts").alias("output")
    )


_PLAN_SQL = """
plan AS (
  SELECT doc_id, n_chars, unnest(range(CAST(floor(n_chars / 600.0) AS BIGINT) + 1)) AS part_ix
  FROM documents)"""


def _plan(t: Tables) -> DataFrame:
    files = t.documents.select("doc_id", doc_file(".mp3").alias("path"), "n_chars")
    return tr.split_plan(files, duration="n_chars")


@query(f"""
WITH {_PLAN_SQL}
SELECT doc_id, part_ix, part_ix * 600 AS start_s, 600 AS len_s,
       printf('doc %d_chunk%03d.mp3', doc_id, part_ix) AS part_name FROM plan""")
def split_plan(t: Tables) -> DataFrame:
    return _plan(t).select("doc_id", "part_ix", "start_s", "len_s", "part_name")


@query(f"""
WITH {_PLAN_SQL}
SELECT doc_id, part_ix, least(600, n_chars - part_ix * 600) AS length
FROM plan WHERE n_chars > part_ix * 600""")
def drop_empty_parts(t: Tables) -> DataFrame:
    real = F.least(F.col("len_s"), F.col("n_chars") - F.col("start_s"))
    cut = _plan(t).withColumn("length", F.greatest(real, F.lit(0)))
    return tr.drop_empty_parts(cut).select("doc_id", "part_ix", "length")


_PARTS_SQL = """
parts AS (
  SELECT conv_id AS file, turn AS part_ix, text,
         CASE WHEN turn % 3 <> 1 THEN length(text)::DOUBLE / 4 END AS duration,
         length(text)::DOUBLE / 8 AS half
  FROM conversations)"""


def _parts(t: Tables) -> DataFrame:
    """Turns as part results; some report no duration, some no segments."""
    length = F.length("text")

    def segment(start: Column, end: Column, text: str) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), F.lit(text).alias("text"))

    nothing = F.lit(None).cast("double")
    segments = F.array(
        segment(nothing, length * 0.125, "first"), segment(length * 0.125, length * 0.25, "second")
    )
    return t.conversations.select(
        F.col("conv_id").alias("file"), F.col("turn").alias("part_ix"), "text",
        F.when(F.col("turn") % 3 != 1, length * 0.25).alias("duration"),
        F.when(F.col("turn") % 4 != 2, segments).alias("segments"),
    )


@query(f"""
WITH {_PARTS_SQL}
SELECT file, string_agg(text, ' ' ORDER BY part_ix) AS text, 'fr' AS language,
       coalesce(sum(duration), 0) AS duration, count(*) AS parts
FROM parts GROUP BY file""")
def reassemble(t: Tables) -> DataFrame:
    return tr.reassemble(_parts(t))


_SHIFTED_SQL = """
shifted AS (
  SELECT file, part_ix, half,
         coalesce(sum(duration) OVER (PARTITION BY file ORDER BY part_ix
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM parts)"""


@query(f"""
WITH {_PARTS_SQL}, {_SHIFTED_SQL}
SELECT file, part_ix, 0 AS segment_ix, earlier AS "start", earlier + half AS "end"
FROM shifted WHERE part_ix % 4 <> 2
UNION ALL
SELECT file, part_ix, 1, earlier + half, earlier + 2 * half FROM shifted WHERE part_ix % 4 <> 2""")
def shift_segments(t: Tables) -> DataFrame:
    moved = tr.shift_segments(_parts(t))
    one = moved.select("file", "part_ix", F.posexplode("segments").alias("segment_ix", "seg"))
    return one.select("file", "part_ix", "segment_ix", "seg.start", "seg.end")


@query(f"""
WITH {_PARTS_SQL}, {_SHIFTED_SQL}
SELECT p.file, md5(string_agg(p.text, ' ' ORDER BY p.part_ix)) AS digest,
       coalesce(sum(p.duration), 0) AS duration, count(*) AS parts,
       2 * count(*) FILTER (WHERE p.part_ix % 4 <> 2) AS segments,
       coalesce(string_agg(concat_ws(' ', CAST(8 * s.earlier AS BIGINT), CAST(8 * (s.earlier + s.half) AS BIGINT), 'first,')
         || concat_ws(' ', CAST(8 * (s.earlier + s.half) AS BIGINT), CAST(8 * (s.earlier + 2 * s.half) AS BIGINT), 'second'), ','
         ORDER BY p.part_ix) FILTER (WHERE p.part_ix % 4 <> 2), '') AS eighths
FROM parts p JOIN shifted s ON p.file = s.file AND p.part_ix = s.part_ix GROUP BY p.file""")
def combine_results(t: Tables) -> DataFrame:
    return tr.combine_results(_parts(t)).select(
        "file", F.md5("text").alias("digest"), "duration", "parts",
        F.size("segments").alias("segments"), _eighths("segments").alias("eighths"),
    )


def _eighths(segments: str) -> Column:
    """Times of segments in eighths of a second, and their texts, in order."""
    times = lambda s: [F.coalesce(F.round(s[n] * 8).cast("bigint").cast("string"), F.lit("-")) for n in ("start", "end")]
    return F.array_join(F.transform(segments, lambda s: F.concat_ws(" ", *times(s), s["text"])), ",")


@query("""
SELECT conv_id, turn, text, CASE WHEN role = 'user' THEN 'en' ELSE 'fr' END AS language,
       CASE WHEN turn % 3 <> 1 THEN length(text)::DOUBLE / 4 END AS duration,
       CASE WHEN turn % 4 <> 2 THEN 1 ELSE 0 END AS segments,
       CASE WHEN turn % 4 <> 2 THEN '0 ' || 8 * length(text) || ' said' ELSE '' END AS eighths
FROM conversations""")
def normalise_result(t: Tables) -> DataFrame:
    """Responses written as JSON, where some fields are left out."""
    segment = F.struct(F.lit(0.0).alias("start"), F.length("text").cast("double").alias("end"), F.lit("said").alias("text"))
    response = F.to_json(
        F.struct(
            "text", F.when(F.col("role") == "user", "en").alias("language"),
            F.when(F.col("turn") % 3 != 1, F.length("text") * 0.25).alias("duration"),
            F.when(F.col("turn") % 4 != 2, F.array(segment)).alias("segments"),
        )
    )
    answer = t.conversations.select("conv_id", "turn", tr.normalise_result(response).alias("r"))
    return answer.select(
        "conv_id", "turn", "r.text", "r.language", "r.duration", F.size("r.segments").alias("segments"),
        _eighths("r.segments").alias("eighths"),
    )


@query(f"""
WITH {_PARTS_SQL}, {_SHIFTED_SQL},
cut AS (SELECT file, part_ix, earlier, half, unnest(range(3)) AS i FROM shifted WHERE part_ix % 4 <> 2),
listed AS (
  SELECT file, row_number() OVER (PARTITION BY file ORDER BY part_ix, i) - 1 AS segment_ix, i,
         earlier + CASE i WHEN 0 THEN 0 ELSE half END AS "start", earlier + CASE i WHEN 2 THEN 0 ELSE half * (i + 1) END AS "end",
         part_ix FROM cut)
SELECT file, segment_ix, "start", "end", CASE WHEN i < 2 THEN 'part ' || part_ix END AS text,
       CASE WHEN i < 2 THEN CAST(part_ix * 10 + i AS BIGINT) END AS id,
       CAST(CASE i WHEN 0 THEN -0.5 WHEN 1 THEN 0.25 END AS DOUBLE) AS avg_logprob,
       CASE WHEN i < 2 THEN '[' || part_ix || ',"w"]' END AS tokens, CASE i WHEN 2 THEN 'true' END AS silent,
       CASE WHEN i < 2 THEN 6 ELSE 3 END AS keys
FROM listed""")
def segments_all_keys(t: Tables) -> DataFrame:
    """Responses whose segments carry further keys, shifted and concatenated with all of them."""
    half, turn = F.length("text") * 0.125, F.col("turn")
    text = F.concat(F.lit("part "), turn.cast("string"))
    tokens = F.concat(F.lit("["), turn.cast("string"), F.lit(',"w"]'))
    said = [F.format_string('{"id":%d,"start":%s,"end":%s,"text":"%s","avg_logprob":%s,"tokens":%s}',
                            turn * 10 + i, (half * i).cast("string"), (half * (i + 1)).cast("string"), text, F.lit(score), tokens)
            for i, score in enumerate(("-0.5", "0.25"))]
    silent = F.format_string('{"start":%s,"silent":true}', half.cast("string"))
    listed = F.when(turn % 4 != 2, F.concat(F.lit(',"segments":['), F.concat_ws(",", *said, silent), F.lit("]"))).otherwise("")
    duration = F.when(turn % 3 != 1, F.concat(F.lit(',"duration":'), (F.length("text") * 0.25).cast("string"))).otherwise("")
    response = F.concat(F.lit('{"text":"x"'), duration, listed, F.lit("}"))
    parts = t.conversations.select(F.col("conv_id").alias("file"), turn.alias("part_ix"), tr.normalise_result(response).alias("r"))
    whole = tr.combine_results(parts.select("file", "part_ix", "r.*"))
    one = whole.select("file", F.posexplode("segments").alias("segment_ix", "s"), F.from_json(
        tr.segments_json("segments"), "array<map<string,string>>").alias("json"))

    def other(key: str, kind: str) -> Column:
        return F.try_variant_get(F.element_at("s.other", key), "$", kind).alias(key)

    return one.select(
        "file", "segment_ix", "s.start", "s.end", "s.text", other("id", "bigint"), other("avg_logprob", "double"),
        F.to_json(F.element_at("s.other", "tokens")).alias("tokens"), F.to_json(F.element_at("s.other", "silent")).alias("silent"),
        F.size(F.get("json", F.col("segment_ix"))).alias("keys"))


def _read_aloud(part: dict, **settings) -> dict:
    """Stand-in for a speech model: the recording "contains" its text."""
    if len(part["text"]) > 400:
        raise ValueError("audio too noisy")
    return {"text": part["text"], "duration": len(part["text"]) * 0.5}


@query("""
SELECT conv_id AS file, turn AS part_ix,
       CASE WHEN length(text) <= 400 THEN text END AS text,
       CASE WHEN length(text) <= 400 THEN length(text)::DOUBLE / 2 END AS duration,
       CASE WHEN length(text) > 400 THEN 'audio too noisy' END AS error
FROM conversations""")
def transcribe(t: Tables) -> DataFrame:
    parts = spread(
        t.conversations.select(F.col("conv_id").alias("file"), F.col("turn").alias("part_ix"), "text")
    )
    return tr.transcribe(parts, _read_aloud, ["file", "part_ix"]).select(
        "file", "part_ix", "text", "duration", "error"
    )


def _read_part(part: dict, **settings) -> dict:
    """Stand-in for a speech model on split recordings: one character per second."""
    if part["lang"] == "de" and part["part_ix"] == 1:
        raise ValueError("audio too noisy")
    text, start = part["text"], part["start_s"]
    if part["is_split"]:
        text = text[start : start + part["len_s"]]
    return {"text": text, "duration": float(len(text)), "language": "fr"}


@query(f"""
WITH {_LISTING_SQL},
files AS (SELECT d.doc_id, d.text, d.lang, length(d.text) AS chars, l.suffix, l.length
          FROM documents d JOIN listing l ON d.doc_id = l.doc_id),
cut AS (SELECT doc_id, text, chars, unnest(range((chars - 1) // 600 + 1)) AS i
        FROM files WHERE length > 26214400 AND NOT {_BAD_SQL}),
joined AS (SELECT doc_id, string_agg(substr(text, i * 600 + 1, 600), ' ' ORDER BY i) AS text,
                  count(*) AS parts FROM cut GROUP BY doc_id),
marked AS (
  SELECT f.doc_id, f.text, j.text AS joined, f.chars, j.parts,
         CASE WHEN {_BAD_SQL} THEN 'Unsupported format: ' || suffix
              WHEN f.lang = 'de' AND j.parts > 1 THEN 'audio too noisy' END AS error
  FROM files f LEFT JOIN joined j ON f.doc_id = j.doc_id)
SELECT doc_id, CASE WHEN error IS NULL THEN coalesce(joined, text) END AS text,
       CASE WHEN error IS NULL THEN CAST(chars AS DOUBLE) END AS duration,
       CASE WHEN error IS NULL THEN parts END AS parts, error
FROM marked""")
def transcribe_directory(t: Tables) -> DataFrame:
    texts = t.documents.select("doc_id", "text", "lang", F.length("text").cast("double").alias("duration"))
    files = spread(_listing(t)).join(texts, "doc_id")
    results = tr.transcribe_directory(
        files, _read_part, ["text", "lang"]
    )
    number = F.regexp_extract("file", r"doc (\d+)", 1).cast("bigint")
    return results.select(number.alias("doc_id"), "text", "duration", "parts", "error")


def _results(t: Tables) -> DataFrame:
    """Documents with a label succeeded when the label says so; others were never tried."""
    return t.labels.select(
        "doc_id", F.when(F.col("quality") == 0, "rejected").alias("error")
    )


@query("""
SELECT count(*) AS found, count(*) FILTER (WHERE quality <> 0) AS succeeded,
       count(*) FILTER (WHERE quality = 0) AS failed FROM labels""")
def batch_summary(t: Tables) -> DataFrame:
    return tr.batch_summary(_results(t))


@query("""
SELECT doc_id FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality <> 0)""")
def pending(t: Tables) -> DataFrame:
    return tr.pending(t.documents.select("doc_id"), _results(t), "doc_id")


@query("SELECT 'doc ' || doc_id || '.mp3' AS file, text, length(text) AS chars FROM documents")
def transcript_table(t: Tables) -> DataFrame:
    """The transcripts written as a table keyed by file, and read back."""
    path = fresh_dir(t.spark, "transcripts")
    made = t.documents.select(doc_file(".mp3"), "text", F.length("text").alias("chars"))
    write_transcripts(made, path)
    return t.spark.read.schema(made.schema).parquet(path)


@query("""
SELECT 'talk ' || conv_id AS stem, string_agg(text, ' ' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""")
def text_export(t: Tables) -> DataFrame:
    """Reassembled conversations exported as text files, and read back."""
    path = fresh_dir(t.spark, "texts")
    whole = tr.reassemble(_parts(t))
    export_texts(whole.select(F.concat(F.lit("talk "), F.col("file")).alias("stem"), "text"), path)
    return read_exported_texts(t.spark, path)


def _attempts(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    error = (
        F.when(kind == "click", "Model is LOADING")
        .when(kind == "error", "HTTP 429")
        .when(kind == "purchase", "could not generate")
        .when(kind == "view", "503 busy")
        .otherwise("timeout")
    )
    embedding = kind.isin("click", "view", "purchase")
    return t.events.select(
        F.col("user_id").alias("item"),
        F.when(embedding, "embedding").otherwise("transcription").alias("service"),
        (F.col("event_id") % 3).alias("attempt"), error.alias("error"),
    )


@query("""
WITH attempts AS (
  SELECT user_id AS item,
         CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'embedding'
              ELSE 'transcription' END AS service,
         event_id % 3 AS attempt,
         CASE event_type WHEN 'click' THEN 'Model is LOADING' WHEN 'error' THEN 'HTTP 429'
              WHEN 'purchase' THEN 'could not generate' WHEN 'view' THEN '503 busy'
              ELSE 'timeout' END AS error
  FROM events),
latest AS (
  SELECT *, CASE error WHEN 'Model is LOADING' THEN 'loading' WHEN '503 busy' THEN 'loading'
                       WHEN 'HTTP 429' THEN 'rate' WHEN 'could not generate' THEN 'rate'
                       ELSE 'other' END AS error_class
  FROM attempts
  QUALIFY row_number() OVER (PARTITION BY item, service ORDER BY attempt DESC, error DESC) = 1)
SELECT item, service, attempt, error, error_class,
       CASE WHEN error_class = 'loading' THEN 20
            WHEN error_class = 'other' AND attempt >= 2 THEN 0
            WHEN service = 'embedding' THEN CAST(pow(2, attempt) AS BIGINT)
            WHEN error_class = 'rate' THEN 60 * (attempt + 1)
            ELSE 5 * (attempt + 1) END AS wait_s,
       CASE WHEN attempt >= 2 THEN 'give_up' ELSE 'retry' END AS action
FROM latest""")
def retry_plan(t: Tables) -> DataFrame:
    return service_log.retry_plan(_attempts(t))


@query("""
WITH seconds AS (
  SELECT event_type AS account, CAST(floor(epoch(ts)) AS BIGINT) AS second, count(*) AS calls,
         sum(floor(value)) AS audio_s FROM events GROUP BY ALL),
used AS (
  SELECT *,
    sum(calls) OVER (w RANGE BETWEEN 59 PRECEDING AND CURRENT ROW) AS requests_minute,
    sum(calls) OVER (w RANGE BETWEEN 86399 PRECEDING AND CURRENT ROW) AS requests_day,
    sum(audio_s) OVER (w RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW) AS audio_s_hour,
    sum(audio_s) OVER (w RANGE BETWEEN 86399 PRECEDING AND CURRENT ROW) AS audio_s_day
  FROM seconds WINDOW w AS (PARTITION BY account ORDER BY second))
SELECT account, second, calls, audio_s, CAST(requests_minute AS BIGINT) AS requests_minute,
       CAST(requests_day AS BIGINT) AS requests_day, audio_s_hour, audio_s_day,
       requests_minute > 20 OR requests_day > 2000 OR audio_s_hour > 7200
         OR audio_s_day > 28800 AS over_quota
FROM used""")
def quota_usage(t: Tables) -> DataFrame:
    calls = t.events.select(
        F.col("event_type").alias("account"), "ts",
        F.floor("value").cast("double").alias("audio_seconds"),
    )
    return service_log.quota_usage(calls)


@query("""
WITH RECURSIVE logged AS (
  SELECT event_id, user_id % 20 AS account, CAST(floor(value * 20) AS BIGINT) AS audio, event_type,
         CAST(floor(epoch(ts)) AS BIGINT) AS second, ts, event_id % 3 AS attempt FROM events),
calls AS (
  SELECT account, second, count(*) AS n, sum(audio) AS audio FROM logged WHERE ts < TIMESTAMP '2024-01-08' GROUP BY ALL),
recent AS (
  SELECT account, second, n, audio FROM calls
  QUALIFY second > max(second) OVER (PARTITION BY account) - 86400),
queued AS (
  SELECT event_id AS item, account, audio,
         greatest(CAST(epoch(date_trunc('week', ts)) AS BIGINT),
                  CASE WHEN event_type = 'error'
                       THEN CAST(ceil(epoch(ts)) AS BIGINT) + 60 * (attempt + 1) END) AS ready,
         CASE WHEN event_type = 'error' AND attempt >= 2 THEN 'give_up' WHEN event_type = 'error' THEN 'retry' ELSE 'first' END AS action
  FROM logged WHERE ts >= TIMESTAMP '2024-01-08' AND event_type <> 'purchase'),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY account ORDER BY ready, item) AS place
  FROM queued WHERE action <> 'give_up' AND audio <= 7200 QUALIFY place <= 2000),
sums AS (
  SELECT account, list(second ORDER BY second) AS t, list(upto ORDER BY second) AS c, list(heard ORDER BY second) AS a
  FROM (SELECT account, second, CAST(sum(n) OVER w AS BIGINT) AS upto, CAST(sum(audio) OVER w AS BIGINT) AS heard
        FROM recent WINDOW w AS (PARTITION BY account ORDER BY second)) GROUP BY account),
-- t: seconds with calls, c and a: requests and audio up to them; what has to leave a window
-- for the next item are the calls up to the first whose sum exceeds all sums less the limit
sent AS (
  SELECT account, 0 AS place, coalesce(list_last(t), 0) AS send_s, t, c, a
  FROM (SELECT DISTINCT account FROM placed) LEFT JOIN sums USING (account)
  UNION ALL
  SELECT account, place, s, list_append(coalesce(t, []), s), list_append(coalesce(c, []), coalesce(list_last(c), 0) + 1),
         list_append(coalesce(a, []), coalesce(list_last(a), 0) + audio)
  FROM (
    SELECT p.account, p.place, p.audio, x.t, x.c, x.a,
           greatest(x.send_s, p.ready,
             x.t[len(list_filter(x.c, lambda v: v < list_last(x.c) + 1 - 20)) + 1] + 60
               + CASE WHEN list_last(x.c) + 1 > 20 THEN 0 END,
             x.t[len(list_filter(x.c, lambda v: v < list_last(x.c) + 1 - 2000)) + 1] + 86400
               + CASE WHEN list_last(x.c) + 1 > 2000 THEN 0 END,
             x.t[len(list_filter(x.a, lambda v: v < list_last(x.a) + p.audio - 7200)) + 1] + 3600
               + CASE WHEN list_last(x.a) + p.audio > 7200 THEN 0 END,
             x.t[len(list_filter(x.a, lambda v: v < list_last(x.a) + p.audio - 28800)) + 1] + 86400
               + CASE WHEN list_last(x.a) + p.audio > 28800 THEN 0 END) AS s
    FROM sent x JOIN placed p ON p.account = x.account AND p.place = x.place + 1))
SELECT q.account, q.item, q.action, q.ready AS ready_s, x.send_s,
       CASE WHEN q.action = 'give_up' THEN 'give_up' WHEN q.audio > 7200 THEN 'too_long'
            WHEN x.send_s IS NOT NULL THEN 'planned' ELSE 'later' END AS state
FROM queued q LEFT JOIN placed p ON p.item = q.item LEFT JOIN sent x ON x.account = p.account AND x.place = p.place
""")
def dispatch_plan(t: Tables) -> DataFrame:
    """Events of the first week as calls made; later ones as items, queued in bursts, of which some failed before."""
    events = t.events.withColumn("account", F.col("user_id") % 20).withColumn("audio_seconds", F.floor(F.col("value") * 20))
    early = F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz")
    later = events.filter(~early)
    items = later.select(F.col("event_id").alias("item"), "account", "audio_seconds", F.date_trunc("week", "ts").alias("queued_ts"))
    failed = later.filter("event_type = 'error'").select(
        F.col("event_id").alias("item"), F.lit("transcription").alias("service"), (F.col("event_id") % 3).alias("attempt"),
        F.lit("HTTP 429").alias("error"), F.col("ts").cast("timestamp").alias("ts"))
    done = later.filter("event_type = 'purchase'").select(F.col("event_id").alias("item"), F.lit(None).cast("string").alias("error"))
    plan = dispatch.dispatch_plan(
        dispatch.open_items(items, failed, done), events.filter(early).select("account", F.col("ts").cast("timestamp").alias("ts"), "audio_seconds"))
    return plan.select("account", "item", "action", "state", F.unix_seconds("ready_at").alias("ready_s"), F.unix_seconds("send_at").alias("send_s"))


@query(f"WITH RECURSIVE {CHUNKS_SQL} SELECT doc_id, chunk_ix, document, 'doc_' || doc_id || '_' || chunk_ix AS id FROM chunks")
def chunks_by_sql(t: Tables) -> DataFrame:
    """The chunks asked for in SQL, with a table function per transcript."""
    register_functions(t.spark)
    spread(t.documents.select("doc_id", doc_file(), "text")).createOrReplaceTempView("chunks_by_sql_documents")
    return t.spark.sql("""
        SELECT d.doc_id, c.chunk_ix, c.document, chunk_id(d.file, c.chunk_ix) AS id
        FROM chunks_by_sql_documents d, LATERAL chunk_text(d.text) c""")

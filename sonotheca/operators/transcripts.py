"""Transcript side: split plans, part results, reassembly, sidecars, open work."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonotheca.fixed_values import NOT_SPLIT, PART_SECONDS, TRANSCRIPT_LANGUAGE, TRANSCRIPT_MODEL
from sonotheca.functions.audio import format_error, part_name, size_class, size_error, transcript_path
from sonotheca.functions.text import _col
from sonotheca.schemas import RESPONSE, SEGMENTS
from sonotheca.session import written
from sonotheca.sources.named import write_named

# Parts of one file that are worked on together.  A file with more parts is cut
# into blocks of this many, so no task ever holds a whole long file part by part.
BLOCK = 1024
_FIXED_KEYS = ("start", "end", "text")


def planned_parts(path: str, duration: Column, part_seconds: int = PART_SECONDS) -> Column:
    """The planned parts of a file as an array of structs: ``part_ix, start_s, len_s, part_name``."""
    last = F.floor(duration / part_seconds).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        i.alias("part_ix"), (i.cast("bigint") * part_seconds).alias("start_s"), F.lit(part_seconds).alias("len_s"),
        part_name(path, i).alias("part_name")))


def split_plan(
    files: DataFrame, path: str = "path", duration: str = "duration",
    part_seconds: int = PART_SECONDS,
) -> DataFrame:
    """One row per planned part: ``part_ix, start_s, len_s, part_name``.

    A duration that is an exact multiple of the part length plans one part more,
    which turns out empty and is dropped later.
    """
    last = F.floor(F.col(duration) / part_seconds).cast("int")
    return (
        files.withColumn("part_ix", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("start_s", F.col("part_ix").cast("bigint") * part_seconds)
        .withColumn("len_s", F.lit(part_seconds))
        .withColumn("part_name", part_name(path, "part_ix"))
    )


def drop_empty_parts(parts: DataFrame, length: str = "length") -> DataFrame:
    return parts.filter(F.col(length) > 0)


def normalise_result(response: Column | str, language: str = TRANSCRIPT_LANGUAGE) -> Column:
    """A JSON response as a struct, with defaults for what it leaves out.

    A segment keeps all its keys: ``start``, ``end`` and ``text`` are fields, and ``other`` maps
    the rest to variants.  A key that is no JSON for a variant, such as NaN, leaves ``other`` null.
    """
    parsed = F.from_json(_col(response), RESPONSE)
    whole = F.try_variant_get(F.try_parse_json(_col(response)), "$.segments", "array<map<string,variant>>")

    def segment(fixed: Column, keys: Column) -> Column:
        other = F.map_filter(keys, lambda name, _: ~name.isin(*_FIXED_KEYS))
        return F.struct(*(fixed[n].alias(n) for n in _FIXED_KEYS), other.alias("other"))

    segments = F.when(whole.isNull(), F.transform(parsed["segments"], lambda s: segment(s, F.lit(None).cast("map<string,variant>")))) \
        .otherwise(F.zip_with(parsed["segments"], whole, segment))
    return F.struct(
        parsed["text"].alias("text"),
        F.coalesce(parsed["language"], F.lit(language)).alias("language"),
        parsed["duration"].alias("duration"),
        F.coalesce(segments, F.array().cast(SEGMENTS)).alias("segments"),
    )


def segments_json(segments: Column | str) -> Column:
    """Segments as JSON text with all their keys, which come in alphabetical order; a missing one stays out."""
    def whole(s: Column) -> Column:
        fixed = F.map_from_arrays(
            F.array(*map(F.lit, _FIXED_KEYS)), F.array(*(s[n].cast("variant") for n in _FIXED_KEYS)))
        given = F.map_filter(fixed, lambda _, value: value.isNotNull())
        other = F.coalesce(s["other"], F.create_map().cast("map<string,variant>"))
        return F.to_json(F.to_variant_object(F.map_concat(given, other)))

    return F.concat(F.lit("["), F.array_join(F.transform(_col(segments), whole), ","), F.lit("]"))


def _in_blocks(rows: DataFrame, pos: str) -> DataFrame:
    """Adds the block of each row, unless an earlier step has placed the rows already."""
    return rows if "_block" in rows.columns else rows.withColumn("_block", F.floor(F.col(pos) / BLOCK))


def earlier_total(
    rows: DataFrame, value: Column, key: str, pos: str, name: str
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of ``key`` before this one.

    A running sum in two levels.  Totals per block of positions are aggregated
    first and accumulated over the blocks; inside a block a window adds the rest.
    The window therefore never sees more than one block of a key, however many
    rows the key has.
    """
    blocked = _in_blocks(rows, pos)
    totals = blocked.groupBy(key, "_block").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        key, "_block", F.coalesce(F.sum("_total").over(before), F.lit(0.0)).alias("_offset")
    )
    inside = (
        Window.partitionBy(key, "_block").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        blocked.join(offsets, [key, "_block"])
        .withColumn(name, F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0.0)))
        .drop("_offset")
    )


def shift_segments(parts: DataFrame, key: str = "file") -> DataFrame:
    """Parts with segment times moved by the reported durations of the earlier parts.

    A missing time counts as 0, a missing duration adds nothing.
    """
    return _shifted(parts, key).drop("_block")


def _shifted(parts: DataFrame, key: str) -> DataFrame:
    """Shifted parts that still carry their block, so that grouping by it needs no shuffle."""
    reported = F.coalesce(F.col("duration"), F.lit(0.0))
    placed = earlier_total(parts, reported, key, "part_ix", "_earlier")
    kind = parts.schema["segments"].dataType
    kept = [name for name in kind.elementType.fieldNames() if name not in ("start", "end")]
    shifted = F.transform(
        F.coalesce("segments", F.array().cast(kind)),
        lambda s: F.struct(
            (F.coalesce(s["start"], F.lit(0.0)) + F.col("_earlier")).alias("start"),
            (F.coalesce(s["end"], F.lit(0.0)) + F.col("_earlier")).alias("end"),
            *(s[name].alias(name) for name in kept),
        ),
    )
    return placed.withColumn("segments", shifted).drop("_earlier")


def _in_order(value: str) -> Column:
    """Array columns of the grouped rows, concatenated in part order."""
    by_place = lambda a, b: F.when(a["_ix"] < b["_ix"], -1).when(a["_ix"] > b["_ix"], 1).otherwise(0)
    collected = F.array_sort(F.collect_list(F.struct("_ix", value)), by_place)
    return F.flatten(F.transform(collected, lambda s: s[value]))


def _joined(text: str) -> Column:
    return F.expr(f"listagg({text}, ' ') WITHIN GROUP (ORDER BY _ix)")


def reassemble(
    parts: DataFrame, key: str = "file", language: str = TRANSCRIPT_LANGUAGE,
    with_segments: bool = False,
) -> DataFrame:
    """One record per file: texts joined by a space in part order, durations summed.

    Blocks of parts are joined first and then the blocks, so the final group of a
    long file holds a few long strings instead of all of its parts.
    ``with_segments`` also concatenates the segments, which must be shifted already.
    """
    segments = [_in_order("segments").alias("segments")] if with_segments else []
    blocks = (
        _in_blocks(parts, "part_ix")
        .withColumn("_ix", F.col("part_ix"))
        .groupBy(key, "_block")
        .agg(
            _joined("text").alias("text"),
            F.sum(F.coalesce(F.col("duration"), F.lit(0.0))).alias("duration"),
            F.count("*").alias("parts"),
            *segments,
        )
    )
    return (
        blocks.withColumnRenamed("_block", "_ix")
        .groupBy(key)
        .agg(
            _joined("text").alias("text"),
            F.lit(language).alias("language"),
            F.sum("duration").alias("duration"),
            F.sum("parts").alias("parts"),
            *segments,
        )
    )


def combine_results(
    parts: DataFrame, key: str = "file", language: str = TRANSCRIPT_LANGUAGE
) -> DataFrame:
    """The complete record of a split file: text, durations and shifted segments."""
    return reassemble(_shifted(parts, key), key, language, with_segments=True)


def _one_by_one(transcriber: Callable[..., dict], parts: list[dict], settings: dict) -> list[tuple]:
    """The response and the error of every part; what a part raises ends it alone."""
    out = []
    for part in parts:
        try:
            out.append((json.dumps(transcriber(part, **settings)), None))
        except Exception as problem:  # one bad part must not end the batch
            out.append((None, str(problem) or type(problem).__name__))
    return out


def _all_at_once(transcriber: Callable[..., list], parts: list[dict], settings: dict) -> list[tuple]:
    """One call for all parts; if it fails as a whole, one call for each of them."""
    try:
        found = transcriber(parts, **settings)
        if len(found) != len(parts):
            raise ValueError(f"{len(found)} results for {len(parts)} parts")
    except Exception:
        def alone(part: dict, **same) -> dict:
            (result,) = transcriber([part], **same)
            if isinstance(result, Exception):
                raise result
            return result

        return _one_by_one(alone, parts, settings)
    return [(None, str(r) or type(r).__name__) if isinstance(r, Exception) else (json.dumps(r), None) for r in found]


def transcribe(
    parts: DataFrame, transcriber: Callable[..., dict], keys: list[str],
    language: str = TRANSCRIPT_LANGUAGE, model: str = TRANSCRIPT_MODEL,
    prompt: str | None = None, temperature: float = 0.0, batch_size: int | None = None,
    nested: str | None = None,
) -> DataFrame:
    """Run a user's speech-to-text function over the parts.

    ``transcriber(part, model=…, language=…, prompt=…, temperature=…)`` gets one part
    as a dict and returns a response dict.  What it raises ends up in ``error`` of that
    part only.  With ``batch_size`` it gets a list of up to so many parts and returns a list of
    responses, of which those that are exceptions become errors; if the call itself fails, the
    parts are tried one by one.  ``nested`` names an array of structs with the parts of a row:
    the row's other columns then reach the task once, however many parts there are.  Write
    the result once before using it twice: every use runs the function again.
    """
    settings = {
        "model": model, "language": language, "prompt": prompt, "temperature": temperature
    }

    def listed(batch: pd.DataFrame) -> Iterator[dict]:
        for row in batch.to_dict("records"):
            if nested is None:
                yield row
                continue
            planned = row.pop(nested)
            for part in planned if planned is not None else ():
                yield {**row, **(part if isinstance(part, dict) else part.asDict())}

    def answered(some: list[dict]) -> pd.DataFrame:
        call = _one_by_one if batch_size is None else _all_at_once
        found = call(transcriber, some, settings)
        rows = [[*(part[k] for k in keys), *answer] for part, answer in zip(some, found)]
        return pd.DataFrame(rows, columns=[*keys, "response", "error"], dtype="object")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = listed(batch)
            while some := list(islice(rows, batch_size or 64)):
                yield answered(some)

    given = {f.name: f.dataType for f in parts.schema}
    if nested is not None:
        given |= {f.name: f.dataType for f in parts.schema[nested].dataType.elementType}
    kept = ", ".join(f"`{k}` {given[k].simpleString()}" for k in keys)
    raw = parts.mapInPandas(run, f"{kept}, response STRING, error STRING")
    answered_rows = raw.withColumn("_answer", normalise_result("response", language))
    no_text = F.when(F.col("_answer.text").isNull(), F.lit("Response without text"))
    return answered_rows.select(*keys, "_answer.*", F.coalesce("error", no_text).alias("error"))


def transcribe_directory(
    files: DataFrame, transcriber: Callable[..., dict], payload: list[str] | None = None,
    auto_split: bool = True, part_seconds: int = PART_SECONDS, save_to: str | None = None, base: str = "",
    **settings,
) -> DataFrame:
    """Every listed file to one result row; failures are rows with ``error``.

    ``files`` holds ``path, length, duration``; ``payload`` names further columns
    the transcriber needs.  Small files are one part, large ones follow the split
    plan, and one part that fails fails its file.  Without payload the parts are rows of
    their own, spread over the tasks, and the transcriber reads its part by path and offset.
    With a payload a file stays one row, so what it holds is moved once and not for every
    part.  The answers are written to the shared folder before they are combined, so the
    transcriber runs once per part.  ``save_to`` names a folder for a ``.txt`` file per
    transcript, which keeps the path of its recording below ``base``.
    """
    language = settings.get("language", TRANSCRIPT_LANGUAGE)
    is_split = size_class("length", auto_split) == "split"
    reason = F.coalesce(
        format_error("path"),
        size_error("length", auto_split),
        F.when(is_split & F.col("duration").isNull(), F.lit("Duration unknown")),
        F.when(is_split & (F.col("duration") <= 0), F.lit(NOT_SPLIT)),
    )
    checked = files.withColumn("error", reason).withColumn("is_split", is_split)
    refused = checked.filter(F.col("error").isNotNull()).select(F.col("path").alias("file"), "error")

    # what is not split is one part, whatever its duration
    planned_length = F.when(F.col("is_split"), F.col("duration")).otherwise(F.lit(0.0))
    parts = F.filter(planned_parts("path", planned_length, part_seconds),
                     lambda p: ~F.col("is_split") | (p["start_s"] < F.col("duration")))
    keys = ["file", "part_ix", "is_split"]
    good_files = checked.filter(F.col("error").isNull()).select(
        F.col("path").alias("file"), "is_split", *(payload or []), parts.alias("_parts"))
    if payload:
        raw = transcribe(good_files, transcriber, keys, nested="_parts", **settings)
    else:
        rows = good_files.select("file", "is_split", F.explode("_parts").alias("_part")).select("file", "is_split", "_part.*")
        raw = transcribe(rows, transcriber, keys, **settings)
    answers = written(raw, "answers")
    failed = (
        answers.filter(F.col("error").isNotNull())
        .groupBy("file")
        .agg(F.min_by("error", "part_ix").alias("error"))
    )
    good = answers.filter(F.col("error").isNull()).join(failed, "file", "left_anti")
    single = good.filter(~F.col("is_split")).select(
        "file", "text", "language", "duration", "segments", F.lit(None).cast("bigint").alias("parts")
    )
    joined = combine_results(good.filter("is_split"), "file", language)
    results = (
        single.unionByName(joined)
        .withColumn("error", F.lit(None).cast("string"))
        .unionByName(failed.unionByName(refused), allowMissingColumns=True)
    )
    if save_to is None:
        return results
    results = written(results, "results")
    save_transcripts(results, save_to, base)
    return results


def save_transcripts(results: DataFrame, folder: str, base: str = "") -> None:
    """The texts of results without error as files below ``folder``, at the path of their recording below ``base``."""
    inside = F.col("file") if base else F.concat(F.lit("./"), F.col("file"))
    name = F.regexp_replace(transcript_path(inside, base or ".", ""), "^/+", "")
    write_named(accepted(results).filter(F.col("text").isNotNull()).select(name.alias("name"), "text"), folder)


def batch_summary(results: DataFrame) -> DataFrame:
    """Files found, succeeded and failed."""
    return results.agg(
        F.count("*").alias("found"),
        F.count_if(F.col("error").isNull()).alias("succeeded"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )


def attach_sidecar(transcripts: DataFrame, sidecars: DataFrame, key: str = "stem") -> DataFrame:
    """Transcripts with their ``metadata`` record; ``error`` says when there is none.

    One join serves both sides: keep ``accepted`` of the result and report its
    ``quarantined`` rows.  Both sides hold one row per file, so no key is hot.
    """
    fields = [c for c in sidecars.columns if c != key]
    records = sidecars.select(key, F.struct(*fields).alias("metadata"))
    joined = transcripts.join(records, key, "left")
    return joined.withColumn(
        "error", F.when(F.col("metadata").isNull(), F.lit("Metadata record not found"))
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("error").isNull()).drop("error")


def quarantined(df: DataFrame) -> DataFrame:
    return df.filter(F.col("error").isNotNull())


def pending(files: DataFrame, done: DataFrame, key: str = "file") -> DataFrame:
    """Files without a successful result yet."""
    return files.join(done.filter(F.col("error").isNull()).select(key), key, "left_anti")

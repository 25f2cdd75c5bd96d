"""URL filter: rules first, then naive Bayes over segmented host names and paths.

**Segmentation.**  A host's labels are split into words by Viterbi search for the most
probable sequence under unigram word counts, taken from the visible text of all pages.
Every different label is split once: its substrings are joined with the word counts, so
a task holds the words inside one label, never the vocabulary.

**Naive Bayes.**  Pages that a rule decides are the training rows.  Tokens of the
segmented host and of the path are counted by verdict in ``2**bits`` hashed buckets; this
bounded table is the model, with add-one smoothing.  Pages without a rule get the more
probable verdict; ``allow`` where nothing tells them apart.

Nulls and edge cases: a null url, or one without ``://``, has an empty host and path; no
rule fits it and the method decides from the class sizes.  A null html has no words.
Without training rows, or with one class only, that class (or ``allow``) is the verdict.
Repeated rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonotheca.session import written

#: (verdict, host, path) of the fixed rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
LONGEST_WORD = 24
BITS = 18
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as struct (rule, verdict), or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def word_counts(html: DataFrame, column: str) -> DataFrame:
    """``word``, ``n`` over the visible text of all rows."""
    visible = F.regexp_replace(F.col(column), "<[^>]*+>", " ")
    words = F.split(F.lower(visible), r"[^\p{L}\p{Nd}]+", -1)
    return html.select(F.explode(words).alias("word")).where(
        (F.length("word") > 0) & (F.length("word") <= LONGEST_WORD)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def viterbi(label: str, known: dict[str, int], total: int) -> list[str]:
    """The most probable split of ``label``; a string that is no word costs more the longer it is."""
    best = [(0.0, 0)]
    for end in range(1, len(label) + 1):
        choices = []
        for start in range(max(0, end - LONGEST_WORD), end):
            part = label[start:end]
            n = known.get(part)
            cost = math.log(total) - math.log(n) if n else math.log(total) + len(part) * math.log(10)
            choices.append((best[start][0] + cost, start))
        best.append(min(choices))
    words, end = [], len(label)
    while end:
        start = best[end][1]
        words.append(label[start:end])
        end = start
    return words[::-1]


def _segment_rows(total: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [viterbi(label, {w["word"]: w["n"] for w in known}, total)
                 for label, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], names=["label", "words"])


def segments(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """``host``, ``words`` for every different host: the words of its labels, in order."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    own = hosts.select("host").distinct()
    labels = own.select("host", F.posexplode(F.split("host", "[^a-z0-9\\x80-\\x{10ffff}]+", -1)).alias("at", "label"))
    labels = written(labels.where("label <> ''"), "labels")
    distinct = labels.select("label").distinct()
    starts = F.explode(F.sequence(F.lit(1), F.length("label"))).alias("start")
    sizes = F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("label") - F.col("start") + 1))).alias("size")
    parts = distinct.select("label", starts).select("label", "start", sizes).select(
        "label", F.substr("label", F.col("start"), F.col("size")).alias("word")).distinct()
    known = parts.join(counts, "word").groupBy("label").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    rows = distinct.join(known, "label", "left").select(
        "label", F.coalesce("known", F.array().cast("array<struct<word:string,n:bigint>>")).alias("known"))
    split = rows.mapInArrow(functools.partial(_segment_rows, total), "label STRING, words ARRAY<STRING>")
    return labels.join(split, "label").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("at", "words"))).alias("w")).select(
        "host", F.flatten("w.words").alias("words"))


def tokens(host_words: Column, path: Column) -> Column:
    """Tokens of a page: host words, and lower-cased path words with numbers reduced to a mark."""
    parts = F.array_remove(F.split(F.lower(path), r"[^\p{L}\p{Nd}]+", -1), "")
    shaped = F.transform(parts, lambda p: F.concat(F.lit("p:"), F.regexp_replace(p, "[0-9]+", "#")))
    names = F.transform(F.coalesce(host_words, F.array().cast("array<string>")), lambda w: F.concat(F.lit("h:"), w))
    return F.concat(names, shaped)


def _score_rows(model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    prior, weight = model.value
    for batch in batches:
        at = batch.schema.names.index("_buckets")
        lists = batch.column(at)
        sums = np.array([prior + weight[np.asarray(b.values, dtype=np.int64)].sum() for b in lists])
        kept = [c for i, c in enumerate(batch.columns) if i != at]
        names = [n for n in batch.schema.names if n != "_buckets"]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(sums, pa.float64())], names=[*names, "score"])


def judged(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    rules: Sequence[tuple[str, str, str]] = RULES, bits: int = BITS,
) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule``, ``verdict``, ``words`` and ``score`` (log odds of block) per row."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    split = split.withColumn("host", F.coalesce("host", F.lit(""))).withColumn("path", F.coalesce("path", F.lit("")))
    counts = written(word_counts(pages, html_col), "words")
    words = written(segments(split, counts), "segments")
    rows = split.join(words, "host", "left").withColumn("found", matched_rule(F.col("host"), F.col("path"), rules))
    buckets = F.transform(tokens(F.col("words"), F.col("path")),
                          lambda t: F.pmod(F.xxhash64(t), F.lit(1 << bits)).cast("int"))
    rows = written(rows.withColumn("_buckets", buckets), "tokens")
    known = rows.where("found IS NOT NULL").select((F.col("found.verdict") == "block").cast("int").alias("block"), "_buckets")
    sizes = {r["block"]: r["n"] for r in known.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
    # at most 2 ** (bits + 1) rows
    found = known.select("block", F.explode("_buckets").alias("bucket")).groupBy("block", "bucket").agg(
        F.count(F.lit(1)).alias("n")).toArrow()
    table = np.ones((2, 1 << bits))
    np.add.at(table, (found["block"].to_numpy(), found["bucket"].to_numpy()), found["n"].to_numpy())
    odds = np.log(table[1] / table[1].sum()) - np.log(table[0] / table[0].sum())
    prior = math.log((sizes.get(1, 0) + 0.5) / (sizes.get(0, 0) + 0.5))
    if len(sizes) < 2:
        odds, prior = np.zeros(1 << bits), 1.0 if sizes.get(1) else -1.0
    model = spark.sparkContext.broadcast((prior, odds))
    schema = T.StructType([f for f in rows.schema.fields if f.name != "_buckets"] + [T.StructField("score", T.DoubleType())])
    scored = rows.mapInArrow(functools.partial(_score_rows, model), schema)
    verdict = F.coalesce("found.verdict", F.when(F.col("score") > 0, "block").otherwise("allow"))
    return scored.select("id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"), "words", "score")

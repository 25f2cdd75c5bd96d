"""The corpus pipeline: from raw documents to a mix of clean, distinct text.

Five stages run one after the other, each over all that the one before it kept and wrote.
All but the last return the columns of ``documents``; the last returns the mix: blocks of
words by output shard, with the ids of the documents they come from.

Nulls and edge cases are those of the operators: null texts count as empty, rows with a
null id are kept apart by their text, an empty table gives an empty mix, and other columns
pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonotheca.llm import decontamination, line_dedup, mixing, quality, simhash
from sonotheca.llm.queries import held_out
from sonotheca.session import written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the quality threshold go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.fit(docs, labels, usable=~held_out(2, 4)))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines go, and documents of which nothing is left; ``n_chars`` follows."""
    kept = line_dedup.deduplicated(docs)
    return kept.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.deduplicated(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The blocks of a mix in which every source has its target share."""
    return mixing.Mix(docs).blocks()


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", repeated_lines),
    ("near-dedup", near_duplicates),
    ("decontamination", benchmark_passages),
    ("source mix", source_mix),
]

#: The first stage learns its model, so no SQL gives these rows; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table that the next stage reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

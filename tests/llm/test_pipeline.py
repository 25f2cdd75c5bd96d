from collections import Counter

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from sonotheca.llm import decontamination, quality, simhash
from sonotheca.session import written

FOLDER = "/root/testdata/sf0.01"
NAMES = ["quality classifier", "line dedup", "near-dedup", "decontamination", "source mix"]


def test_stages_chain_and_take_effect(spark):
    assert [n for n, _ in pipeline.STAGES] == NAMES and pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for name, stage in pipeline.STAGES:
        tables.append(written(stage(spark, tables[-1], FOLDER), "stage"))
    raw, good, lines, near, clean, mix = tables
    assert all(t.columns == columns for t in tables[:-1])
    counts = [t.count() for t in tables[:-1]]
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[1] > counts[2] and counts[-1] > 0.7 * counts[0]

    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = {r[0]: r[1] for r in labels.join(good, "doc_id").groupBy("quality").count().collect()}
    every = {r[0]: r[1] for r in labels.join(raw, "doc_id").groupBy("quality").count().collect()}
    assert kept[1] >= 0.98 * every[1] and kept.get(0, 0) <= 0.1 * every[0]

    # no text twice, no near-duplicates, no contaminated document is left
    # (line dedup leaves runs below 20 words, near-dedup takes one of each text)
    texts = Counter(r["text"] for r in lines.collect() if len(r["text"].split()) >= 20)
    assert max(texts.values()) == 1
    assert max(Counter(r["text"] for r in near.collect()).values()) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())
    found = simhash.near_duplicates(near)
    assert found.where("id <> component").count() == 0
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    hit = decontamination.hit_words(F.col("spans"))
    judged = decontamination.contamination(near, items).select("id", decontamination.is_contaminated(hit, F.col("n_words")).alias("bad"))
    assert {r["id"] for r in judged.where("NOT bad").collect()} == {r["doc_id"] for r in clean.collect()}

    # the mix holds words of kept documents only, at most twice
    words = {r["doc_id"]: len(r["text"].split()) for r in clean.collect()}
    taken = Counter()
    for r in mix.collect():
        assert set(r["doc_ids"]) <= set(words)
        taken[r["source"]] += len(r["text"].split())
    assert 1.4 < sum(taken.values()) / sum(words.values()) <= 1.51


def test_run_copes_with_odd_tables(spark, tmp_path):
    rows = [(1, "some words here", "en", "a", 15), (None, None, None, None, None), (2, "", "en", None, 0), (1, "some words here", "en", "a", 15)]
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    for name, df in (("documents", spark.createDataFrame(rows, schema).withColumn("size", F.lit(1))),
                     ("labels", spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")),
                     ("benchmark", spark.createDataFrame([(1, None)], "item_id BIGINT, text STRING"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    mix = pipeline.run(spark, str(tmp_path)).collect()
    assert all(r["doc_ids"] == [1] and r["text"] == "some words here" for r in mix)


def test_quality_stage_matches_its_operator(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality.fit(docs, labels, usable=pipeline.held_out(2, 4))
    again = quality.fit(docs.repartition(5), labels, usable=pipeline.held_out(2, 4))
    assert (model.weights == again.weights).all() and model.threshold == again.threshold

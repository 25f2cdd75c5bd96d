import random
import re

import pytest
from pyspark.sql import functions as F

from sonotheca.llm import decontamination as D
from sonotheca.llm.words import window_minima


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items):
    out = {}
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for item, itext in items:
            v = words(itext)
            size = min(len(v), 13)
            windows = {tuple(v[i:i + size]) for i in range(len(v) - size + 1)} if size else set()
            for i in range(len(w) - size + 1):
                if size and tuple(w[i:i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found.add("" if item is None else str(item))
        out[key, text] = (len(w), len(hit), sorted(found))
    return out


def run(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id BIGINT, text STRING").withColumn("id", F.lit("x")).withColumn("n_words", F.lit(1))
    i = spark.createDataFrame(items, "item_id BIGINT, text STRING").withColumn("pos", F.lit(3))
    rows = D.contamination(d, i, **options).withColumn("hit", D.hit_words(F.col("spans"))).collect()
    return rows


def test_agrees_with_brute_force(spark):
    rnd = random.Random(3)
    vocabulary = ["Alpha", "beta", "ça", "dEL", "e", "f2", "日本", "g-h"]
    some = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(k, some(n)) for k, n in enumerate([1, 2, 4, 12, 13, 14, 20, 40, 40])]
    items += [(50, items[7][1]), (51, None), (52, ""), (53, "---"), (None, some(30)), (7, some(15))]
    docs = [(k, some(rnd.randint(0, 120))) for k in range(40)]
    for k, (_, text) in enumerate(items):
        if text:
            docs.append((100 + k, f"{some(9)} x{k} {text.upper()}, {some(5)}"))
            docs.append((200 + k, " ".join(text.split()[1:])))
    docs += [(900, None), (901, ""), (902, "..."), (None, items[8][1]), (0, docs[0][1]), (0, items[7][1])]
    rows = run(spark, docs, items)
    assert len(rows) == len(docs)
    want = brute(docs, items)
    by_key = {}
    for r in rows:
        by_key.setdefault((r["id"], r["n_words"], r["hit"], tuple(r["items"])), 0)
    assert set(by_key) == {(k[0], v[0], v[1], tuple(v[2])) for k, v in want.items()}


@pytest.mark.parametrize("docs,items", [([], [(1, "a b")]), ([(1, "a b")], [])])
def test_empty_tables(spark, docs, items):
    rows = run(spark, docs, items)
    assert [(r["hit"], r["items"]) for r in rows] == [(0, [])] * len(docs)


def test_long_text_and_clean_documents_stay(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    long = " ".join(f"z{i % 977}" for i in range(60_000)) + " " + passage
    docs = spark.createDataFrame([(1, long), (2, passage), (3, "clean words only"), (4, None)], "doc_id BIGINT, text STRING")
    items = spark.createDataFrame([(9, passage)], "item_id BIGINT, text STRING")
    found = {r["id"]: (r["hit"], r["n_words"]) for r in
             D.contamination(docs, items).withColumn("hit", D.hit_words(F.col("spans"))).collect()}
    assert found == {1: (30, 60_030), 2: (30, 30), 3: (0, 3), 4: (0, 0)}
    kept = D.decontaminated(docs, items)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 3, 4}


def test_every_window_holds_a_selected_minimum():
    rnd = random.Random(1)
    import numpy as np
    values = np.array([rnd.randrange(5) for _ in range(200)], dtype=np.uint64)
    chosen = set(window_minima(values, 9).tolist())
    for i in range(192):
        assert any(j in chosen and values[j] == values[i:i + 9].min() for j in range(i, i + 9))


def test_hot_passage_joins_once_per_document(spark):
    passage = " ".join(f"w{i}" for i in range(14))
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit(passage).alias("text"))
    items = spark.createDataFrame([(k, passage) for k in range(5)], "item_id BIGINT, text STRING")
    rows = D.contamination(docs, items).collect()
    assert len(rows) == 300 and all(r["items"] == ["0", "1", "2", "3", "4"] for r in rows)

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sonotheca.llm import graph_ann as G


def clustered(n=1500, d=24, seed=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, d))
    return centres[draw.integers(0, 12, n)] + 0.4 * draw.normal(size=(n, d))


def exact(ids, vectors, query, k):
    score = (vectors * vectors[ids == query][0]).sum(axis=1)
    other = ids != query
    order = np.lexsort((ids[other], -score[other]))[:k]
    return ids[other][order].tolist()


def table(spark, ids, vectors):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")


def test_recall_over_shards(spark):
    vectors = clustered()
    vectors[::7] *= 3  # lengths differ, so nearness is not distance
    ids = np.arange(len(vectors))
    df = table(spark, ids, vectors).withColumn("score", F.lit("x")).withColumn("id", F.lit(1))
    index = G.build_index(df, shard_size=400).cache()
    assert sorted(i for r in index.collect() for i in r["ids"]) == ids.tolist()
    assert index.select("shard").distinct().count() == 4
    asked = G.candidates(df, "vec_id", "embedding").where("id % 20 = 0")
    rows = G.search(index, asked, 20, block=32).toPandas()
    hits = total = 0
    for q, own in rows.groupby("query_id"):
        own = own.sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21)) and q not in set(own["id"])
        pairs = list(zip(-own["score"], own["id"]))
        assert pairs == sorted(pairs)
        assert np.allclose(own["score"], [(vectors[q] * vectors[i]).sum() for i in own["id"]], rtol=1e-12)
        hits += len(set(own["id"]) & set(exact(ids, vectors, q, 20)))
        total += 20
    assert rows["query_id"].nunique() == 75 and hits / total >= 0.95


def test_copies_and_ties(spark):
    vectors = np.concatenate((np.tile([1.0, 2.0, 0.5], (60, 1)), clustered(100, 3)))
    ids = np.arange(len(vectors))[::-1].copy()
    df = table(spark, ids, vectors)
    rows = G.search(G.build_index(df, shard_size=50), G.candidates(df, "vec_id", "embedding").where("id = 140"), 20)
    got = [r["id"] for r in rows.orderBy("rank").collect()]
    assert got == exact(ids, vectors, 140, 20)


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (1, [0.9, 0.1]), (20, None)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    found = G.search(G.build_index(df), G.candidates(df, "vec_id", "embedding").where("id % 20 = 0"), 20).collect()
    assert [(r["query_id"], r["rank"], r["id"]) for r in found] == [(0, 1, 1)]


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [1.0])]])
def test_nothing_to_find(spark, rows):
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    assert G.search(G.build_index(df), G.candidates(df, "vec_id", "embedding"), 5).count() == 0


def test_pruning_keeps_near_and_diverse_edges():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [0, 2.1]], dtype=np.float32)
    kept = G.robust_prune(points, np.array([0]), np.array([[1, 2, 3, 4, 0, -1, 1]]), 4, 1.2)
    assert kept.tolist() == [[1, 3, -1, -1]]


def test_query_recall(spark):
    from sonotheca.llm.queries import QUERIES
    folder = "/root/testdata/sf0.1"
    rows = QUERIES["op3_graph_ann"](spark, folder).toPandas()
    own = pd.read_parquet(f"{folder}/embeddings.parquet")
    vectors, ids = np.array(own["embedding"].tolist(), dtype=float), own["vec_id"].to_numpy()
    hits = sum(len(set(r["vec_id"]) & set(exact(ids, vectors, q, 20))) for q, r in rows.groupby("query_id"))
    assert hits >= 0.9 * len(rows) and len(rows) == 20 * (ids % 20 == 0).sum()

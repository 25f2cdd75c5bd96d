import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonotheca.functions.vectors import squared_distance
from sonotheca.operators import embedding as em
from sonotheca.operators import search as se

TEXTS = ["Été ok, été! 2 fois", "", "...", "mot " * 500, "un deux " * 60000, "a b c a", "ß Straße 日本 x_y"]


def test_offline_embedding_by_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i INT, document STRING")
    for row in em.embed(df).collect():
        want = np.zeros(384)
        for word in re.split(r"[\W_]+", row.document.lower()):
            if word:
                want[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 384] += 1
        norm = np.sqrt((want**2).sum())
        assert np.allclose(row.embedding, want / norm if norm else want, atol=0, rtol=1e-15)
        assert row.model == "hashed-words-384"


def test_offline_embedding_counts_in_spark_ml(spark, plan_of):
    texts = [*TEXTS, None, "", "...", "a " * 5000, "ß É 12 ١٢ ﬁ"]
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, document STRING").withColumn("embedding", F.lit("old"))
    made = em.embed(df)
    assert made.columns == ["i", "document", "embedding", "model", "embed_error"]
    assert "sort_array" not in plan_of(made.select("embedding"))
    for dim in (1, 8, 384):
        chosen = em.offline_embedder(dim)
        both = em.embed(df, embedder=chosen).withColumn("want", chosen.column(F.col("document")))
        assert both.filter("NOT (embedding <=> want)").count() == 0


def test_offline_embedding_has_no_python_and_no_shuffle(spark, plan_of):
    df = spark.createDataFrame([("a",)], "document STRING")
    plan = plan_of(em.embed(df.select(F.col("document"))))
    assert "Python" not in plan.split("Scan")[0] and "Exchange" not in plan


def test_empty_input_gives_empty_output(spark):
    none = spark.createDataFrame([], "document STRING")
    assert em.embed(none).count() == 0
    assert em.embed(none, embedder=counting_model()).count() == 0


def counting_model():
    def load():
        def outputs(texts):
            # a vector, token vectors, and a batch of token vectors, by text length
            shapes = [lambda n: [n, 1.0], lambda n: [[n, 0.0], [n, 2.0]], lambda n: [[[n, 1.0]], [[9.0, 9.0]]]]
            return [shapes[len(t) % 3](float(len(t))) for t in texts]

        return outputs

    return em.model_embedder("counting", load)


def test_model_embedder_pools_every_shape(spark):
    df = spark.createDataFrame([("x" * n,) for n in range(9)], "document STRING").repartition(3)
    got = {len(r.document): (r.embedding, r.model) for r in em.embed(df, embedder=counting_model()).collect()}
    assert got == {n: ([float(n), 1.0], "counting") for n in range(9)}


def test_pool(spark):
    df = spark.createDataFrame(
        [([1.0, 2.0], [[1.0, 2.0], [3.0, 6.0]], [[[1.0, 2.0], [3.0, 6.0]], [[9.0, 9.0]]])],
        "v1 ARRAY<DOUBLE>, v2 ARRAY<ARRAY<DOUBLE>>, v3 ARRAY<ARRAY<ARRAY<DOUBLE>>>",
    )
    row = df.select(*(em.pool(f"v{n}", n).alias(f"p{n}") for n in (1, 2, 3))).first()
    assert (row.p1, row.p2, row.p3) == ([1.0, 2.0], [2.0, 4.0], [2.0, 4.0])
    with pytest.raises(ValueError):
        em.pool("v3", 4)
    long = df.select(F.lit("k").alias("k"), F.explode("v2").alias("embedding"))
    assert em.pool_rows(long, "k").first().asDict() == {"k": "k", "embedding": [2.0, 4.0], "tokens": 2}


def vectors(spark, rows, names):
    return spark.createDataFrame(rows, names)


@pytest.fixture
def random_sets(spark):
    rng = np.random.default_rng(5)
    points = rng.integers(-2, 3, (300, 4)).astype(float)  # many equal distances
    asked = rng.integers(-2, 3, (25, 4)).astype(float)
    store = [(f"id{i:03}", "m" if i % 3 else "other", p.tolist()) for i, p in enumerate(points)]
    queries = [(i, "m", q.tolist()) for i, q in enumerate(asked)]
    return (
        spark.createDataFrame(queries, "qid BIGINT, model STRING, embedding ARRAY<DOUBLE>"),
        spark.createDataFrame(store, "id STRING, model STRING, embedding ARRAY<DOUBLE>").repartition(4),
        queries, store,
    )


def brute(queries, store, k, distance):
    out = set()
    for qid, model, q in queries:
        ranked = sorted((distance(np.array(q), np.array(v)), i) for i, m, v in store if m == model)
        out |= {(qid, rank, i, d) for rank, (d, i) in enumerate(ranked[:k], 1)}
    return out


@pytest.mark.parametrize("layout", ["broadcast", "grid"])
@pytest.mark.parametrize("k", [1, 7, 500])
def test_nearest_is_exact_with_ties_by_id(random_sets, layout, k, monkeypatch):
    monkeypatch.setattr(se, "QUERY_CELL_ROWS", 10)
    monkeypatch.setattr(se, "STORE_CELL_ROWS", 70)
    queries, store, q_rows, s_rows = random_sets
    got = {tuple(r) for r in se.nearest(queries, store, k, layout=layout).collect()}
    assert got == brute(q_rows, s_rows, k, lambda a, b: ((a - b) ** 2).sum())


def test_small_blocks_and_batches(random_sets, monkeypatch, spark):
    monkeypatch.setattr(se, "QUERY_BLOCK_ROWS", 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    queries, store, q_rows, s_rows = random_sets
    want = brute(q_rows, s_rows, 3, lambda a, b: ((a - b) ** 2).sum())
    try:
        for layout in ("broadcast", "grid"):
            hits = se.nearest(queries, store, 3, layout=layout)
            assert {tuple(r) for r in hits.collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_cosine(spark):
    store = spark.createDataFrame(
        [("far", "m", [0.0, 5.0]), ("near", "m", [10.0, 0.1]), ("opposite", "m", [-1.0, 0.0])],
        "id STRING, model STRING, embedding ARRAY<DOUBLE>",
    )
    asked = spark.createDataFrame([(1, "m", [1.0, 0.0])], "qid INT, model STRING, embedding ARRAY<DOUBLE>")
    rows = se.nearest(asked, store, metric="cosine").orderBy("rank").collect()
    assert [(r.id, round(r.distance, 3)) for r in rows] == [("near", 0.0), ("far", 1.0), ("opposite", 2.0)]
    with pytest.raises(ValueError):
        se.nearest(asked, store, metric="l3")


def test_zero_vectors_have_no_direction(spark):
    store = spark.createDataFrame(
        [("blank", "m", [0.0, 0.0]), ("weak", "m", [1.0, 2.0]), ("missing", "m", None)],
        "id STRING, model STRING, embedding ARRAY<DOUBLE>",
    )
    asked = spark.createDataFrame(
        [(1, "m", [1.0, 0.0]), (2, "m", [0.0, 0.0]), (3, "m", None), (4, None, [1.0, 0.0])], "qid INT, model STRING, embedding ARRAY<DOUBLE>"
    )
    rows = se.nearest(asked, store, metric="cosine").orderBy("qid", "rank").collect()
    got = [(r.qid, r.id, round(r.distance, 6)) for r in rows]
    assert got == [(1, "weak", 0.552786), (1, "blank", 1.0), (2, "blank", 1.0), (2, "weak", 1.0)]


@pytest.mark.parametrize("layout", ["broadcast", "grid"])
def test_odd_vectors_are_passed_over_one_by_one(spark, layout):
    nan, inf = float("nan"), float("inf")
    store = spark.createDataFrame(
        [("a", "m", [1.0, 0.0]), ("b", "m", [nan, 0.0]), ("c", "m", [0.0, 1.0]), ("d", "m", [inf, 0.0]),
         ("e", "m", [None, 1.0]), ("f", "m", None), ("g", None, [1.0, 0.0]), ("h", "m", [1e200, 0.0]), ("i", "m", [2.0, 0.0])],
        "id STRING, model STRING, embedding ARRAY<DOUBLE>",
    ).coalesce(1)
    asked = spark.createDataFrame(
        [(1, "m", None), (2, "m", [1.0, 0.0]), (3, "m", [nan, 1.0]), (4, "m", [1e200, 1.0])],
        "qid INT, model STRING, embedding ARRAY<DOUBLE>",
    ).coalesce(1)
    rows = se.nearest(asked, store, 3, layout=layout).orderBy("qid", "rank").collect()
    assert [(r.qid, r.id) for r in rows] == [(2, "a"), (2, "i"), (2, "c"), (4, "h"), (4, "a"), (4, "c")]
    reasons = {r.id: r.reason for r in se.unusable(store).collect()}
    assert reasons == {"b": "not finite", "d": "not finite", "e": "not finite", "f": "no vector", "g": "no model"}


@pytest.mark.parametrize("scale", [1e-5, 1.0, 1e100])
def test_order_does_not_depend_on_the_scale(spark, scale):
    rng = np.random.default_rng(2)
    points, question = rng.normal(size=(60, 5)) * scale, rng.normal(size=5) * scale
    store = spark.createDataFrame(
        [(f"v{i:02}", "m", p.tolist()) for i, p in enumerate(points)], "id STRING, model STRING, embedding ARRAY<DOUBLE>")
    asked = spark.createDataFrame([(1, "m", question.tolist())], "qid INT, model STRING, embedding ARRAY<DOUBLE>")
    got = [r.id for r in se.nearest(asked, store, 10).orderBy("rank").collect()]
    assert got == [f"v{i:02}" for i in np.argsort(((points - question) ** 2).sum(axis=1))[:10]]


def test_too_many_queries_for_a_broadcast_are_refused(random_sets, monkeypatch):
    monkeypatch.setattr(se, "BROADCAST_BYTES", 100)
    with pytest.raises(ValueError, match="grid"):
        se.nearest(*random_sets[:2], layout="broadcast")


def test_vectors_of_different_length_are_refused(spark):
    store = spark.createDataFrame(
        [("a", "m", [0.0]), ("b", "m", [1.0, 2.0, 3.0])], "id STRING, model STRING, embedding ARRAY<DOUBLE>"
    )
    asked = spark.createDataFrame([(1, "m", [1.0, 0.0])], "qid INT, model STRING, embedding ARRAY<DOUBLE>")
    with pytest.raises(Exception, match="different length|differ in vector length"):
        se.nearest(asked, store.coalesce(1)).collect()


def test_nearest_without_neighbours(random_sets, spark):
    queries, store, _, _ = random_sets
    assert se.nearest(queries, store.filter("false")).count() == 0
    assert se.nearest(queries.filter("false"), store).count() == 0
    assert se.nearest(queries, store.filter("model = 'm'").limit(2), k=3).filter("qid = 0").count() == 2


def test_distance_expression_agrees(spark):
    df = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0])], "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>")
    assert df.select(squared_distance("a", "b")).first()[0] == 25.0


def test_plan_prunes_before_the_shuffle(random_sets, plan_of):
    queries, store, _, _ = random_sets
    plan = plan_of(se.nearest(queries, store, layout="broadcast"))
    assert plan.count("WindowGroupLimit") == 2 and "MapInArrow" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.fixture
def library(spark):
    rows = [
        ("a_0", "la crise en public", ("Crise", "P")), ("b_0", "le jardin au printemps", ("Jardin", "P")),
        ("c_0", "gérer une crise", ("Gestion", "Q")), ("d_0", "rien", ("Rien", "Q")),
    ]
    df = spark.createDataFrame(rows, "id STRING, document STRING, metadata STRUCT<title STRING, podcast STRING>")
    return em.embed(df)


def test_search(spark, library):
    asked = spark.createDataFrame([(1, "Comment gérer une crise en public ?")], "qid INT, text STRING")
    rows = se.search(asked, library).orderBy("rank").collect()
    assert [(r.rank, r.id, r.source, r.title) for r in rows[:2]] == [
        (1, "c_0", "Unknown", "Gestion"), (2, "a_0", "Unknown", "Crise"),
    ]
    assert len(rows) == 3 and rows[0].distance < rows[1].distance < rows[2].distance
    assert se.search(asked, library.filter("false")).count() == 0


def test_search_refuses_another_model(spark, library):
    asked = spark.createDataFrame([(1, "x")], "qid INT, text STRING")
    with pytest.raises(ValueError, match="hashed-words-16"):
        se.search(asked, library, embedder=em.offline_embedder(16))
    queries = spark.createDataFrame([(1, "hashed-words-384"), (2, "no")], "qid INT, model STRING")
    got = {r.qid: r.comparable for r in se.same_model(queries, library).collect()}
    assert got == {1: True, 2: False}


def test_source_comes_from_the_record_when_it_has_one(spark):
    df = spark.createDataFrame([(("t", "f.txt"),), (("t", None),)], "metadata STRUCT<title STRING, source_file STRING>")
    assert sorted(r.source for r in se.label_source(df).collect()) == ["Unknown", "f.txt"]


def filled_store(spark, root, batches):
    """A store with one chunk a number and batch, a word for each number."""
    from sonotheca.operators.chunking import chunk_transcripts
    from sonotheca.operators.embedding import embed
    from sonotheca.operators.store import upsert

    for seq, numbers in enumerate(batches, 1):
        rows = [(f"c{n % 3}", f"talk {n}.txt", f"word{n} again word{n}. Batch {seq}.") for n in numbers]
        texts = spark.createDataFrame(rows, "collection STRING, file STRING, text STRING").withColumn(
            "metadata", F.struct(*(F.col("file").alias(n) for n in ("title", "podcast", "audio_url", "spotify_url", "published_date"))))
        upsert(spark, root, embed(chunk_transcripts(texts)), seq)


@pytest.mark.parametrize("layout", ["grid", "broadcast"])
def test_documents_are_read_from_the_files_of_the_hits_only(spark, tmp_path, layout, monkeypatch):
    from sonotheca.operators import locate
    from sonotheca.operators.store import compact, current_chunks

    root = str(tmp_path / "a store +1")
    filled_store(spark, root, [range(12), [3, 4, 20], [4, 21]])
    questions = spark.createDataFrame([(1, "word4"), (2, "word20 again"), (3, "word7")], "qid BIGINT, text STRING")

    def found(places):
        rows = se.search(questions, current_chunks(spark, root, places=places), k=2, layout=layout)
        return rows, sorted(map(tuple, rows.collect()))

    for _ in range(2):
        plain, placed = found(False), found(True)
        assert plain[1] == placed[1] and plain[0].columns == placed[0].columns
        assert any("word4 again word4. Batch 3." in r for r in placed[1])
        every = {f.rpartition("/")[2] for f in current_chunks(spark, root).inputFiles()}
        stored = [f for f in placed[0].inputFiles() if f.rpartition("/")[2] in every]
        assert 0 < len(stored) <= 6 and len(stored) < len(every)
        compact(spark, root)
    monkeypatch.setattr(locate, "MOST_FILES", 0)
    assert found(True)[1] == placed[1]


def test_search_in_an_empty_store_with_places(spark, tmp_path):
    from sonotheca.operators.store import current_chunks

    questions = spark.createDataFrame([(1, "word4")], "qid BIGINT, text STRING")
    assert se.search(questions, current_chunks(spark, str(tmp_path / "none"), places=True)).collect() == []


def test_pivots_give_the_rows_of_the_full_scan_and_skip_vectors(spark):
    from sonotheca.operators import pivots

    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(12, 6)) * 20
    vectors = np.concatenate([c + rnd.normal(size=(100, 6)) for c in centres])
    vectors[200:260] = vectors[200]  # copies
    rows = [(f"v{i:04d}", "m", v.tolist()) for i, v in enumerate(vectors)]
    rows += [("odd1", "m", None), ("odd2", "m", [float("nan")] * 6), ("far", "m", [1e200] * 6), ("other", "n", [0.0])]
    store = spark.createDataFrame(rows, "id STRING, model STRING, embedding ARRAY<DOUBLE>")
    asked = [(i, "m", (vectors[i * 40] + 0.01).tolist()) for i in range(28)]
    asked += [(100, "m", [0.0] * 6), (101, "m", vectors[200].tolist()), (102, "n", [0.0]), (103, "m", None), (104, "m", [1e200] * 6)]
    queries = spark.createDataFrame(asked, "qid BIGINT, model STRING, embedding ARRAY<DOUBLE>")
    index = pivots.build_index(store, "m", pivots=12, block_rows=25)
    for k in (1, 5, 2000):
        want = [tuple(r) for r in se.nearest(queries, store, k).filter("qid <> 102").orderBy("qid", "rank").collect()]
        assert [tuple(r) for r in index.nearest(queries, k).orderBy("qid", "rank").collect()] == want
    usable = queries.filter("qid < 100")
    rest, _ = index.reached(usable.select("qid", "model", "embedding"), 5)
    compared = rest.join(index.blocks, "block").agg(F.sum("n")).first()[0] or 0
    assert index.blocks.agg(F.sum("n")).first()[0] == 1201 and compared < 0.2 * 28 * 1201


def test_pivots_over_an_empty_store(spark):
    from sonotheca.operators import pivots

    empty = spark.createDataFrame([], "id STRING, model STRING, embedding ARRAY<DOUBLE>")
    asked = spark.createDataFrame([(1, "m", [1.0])], "qid BIGINT, model STRING, embedding ARRAY<DOUBLE>")
    assert pivots.build_index(empty, "m").nearest(asked).collect() == []


def test_distances_held_together_are_bounded():
    import tracemalloc

    draw = np.random.default_rng(3)
    queries, vectors = draw.normal(size=(2000, 4)), draw.normal(size=(20_000, 4))
    ids = np.array([f"{i:05d}" for i in range(len(vectors))], dtype=object)
    tracemalloc.start()
    found = se._closest(np.arange(2000), queries, ids, vectors, 2, np.full(2000, np.inf))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
    gap = ((vectors[None] - queries[:50, None]) ** 2).sum(axis=2).argsort(axis=1)[:, :2]
    assert [list(f[1]) for f in found[:50]] == [[ids[i] for i in row] for row in gap]


def test_queries_of_a_block_are_dealt_to_cells(spark):
    from sonotheca.operators.pivots import build_index

    rows = [(f"{i:04d}", "m", [float(i % 97), float(i % 89)]) for i in range(600)]
    index = build_index(spark.createDataFrame(rows, "id STRING, model STRING, embedding ARRAY<DOUBLE>"), "m", pivots=2, block_rows=1000)
    asked = spark.createDataFrame([(i, "m", [float(i), 0.0]) for i in range(400)], "qid BIGINT, model STRING, embedding ARRAY<DOUBLE>")
    pairs = asked.select("qid").crossJoin(index.blocks.select("block"))
    cells = index.placed(asked, pairs, cell_rows=50).groupBy("block", "q_cell", "stored").count().collect()
    assert max(c["count"] for c in cells if not c["stored"]) < 100
    # every cell of a block has all its vectors, and every pair is in one cell
    sizes = {r["block"]: r["n"] for r in index.blocks.collect()}
    assert all(c["count"] == sizes[c["block"]] for c in cells if c["stored"])
    assert sum(c["count"] for c in cells if not c["stored"]) == 400 * len(sizes)

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonotheca.llm import queries, whitening


def brute(vectors):
    """Exact centre and deviations, and the principal components of the distinct grid vectors, by eigh."""
    grid = [[math.floor(256 * float(c)) for c in v] for v in vectors]
    distinct = sorted(set(map(tuple, grid)))
    n, width = len(distinct), len(distinct[0])
    sums = [sum(x[d] for x in distinct) for d in range(width)]
    centred = np.array([[c - s / n for c, s in zip(x, sums)] for x in distinct])
    covariance = centred.T @ centred / n
    values, columns = np.linalg.eigh(covariance)
    order = np.argsort(-values)
    deviations = [sum((n * c - s) ** 2 for c, s in zip(x, sums)) for x in grid]
    all_centred = np.array([[c - s / n for c, s in zip(x, sums)] for x in grid])
    return n, deviations, values[order], all_centred @ columns[:, order] / np.sqrt(np.maximum(values[order], 1e-300)), np.trace(covariance)


def clustered(seed, n, width):
    draw = np.random.default_rng(seed)
    scale = 0.7 ** np.arange(width)
    return (draw.normal(size=(n, width)) * scale + 3).tolist()


def test_query_against_plain_linear_algebra(spark, tmp_path):
    rows = [(i, [float(np.float32(c)) for c in v], 1) for i, v in enumerate(clustered(3, 300, 9))]
    rows += [(1000 + i, rows[5][1], 2) for i in range(200)] + [(None, rows[6][1], 0), (7, rows[8][1], 0)]
    odd = [(2000, None, 0), (2001, [], 0), (2002, [1.0, None] + [0.0] * 7, 0), (2003, [float("nan")] * 9, 0),
           (2004, [float("inf")] + [0.0] * 8, 0), (2005, [1.0, 2.0], 0)]
    table = spark.createDataFrame(rows + odd, "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")
    for name in ("id", "x", "width", "vector", "deviation", "whitened", "n", "component"):
        table = table.withColumn(name, F.lit("clash"))
    table.repartition(7).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op11_whitening(spark, str(tmp_path)).collect()
    n, deviations, values, white, trace = brute([v for _, v, _ in rows])
    assert len(found) == 4 * len(rows)
    got = {}
    for r in found:
        assert (r["n"], r["identity_error"] < 1e-10) == (n, True)
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / trace, rel=1e-9)
        got.setdefault(r["vec_id"], []).append(r)
    signs = {}
    for i, (key, _, _) in enumerate(rows):
        if key in (7, None):
            continue
        own = {r["component"]: r for r in got[key]}
        assert sorted(own) == [1, 2, 3, 4]
        for c, r in own.items():
            assert r["deviation"] == deviations[i]
            sign = signs.setdefault(c, math.copysign(1, r["whitened"] * white[i][c - 1]))
            assert r["whitened"] == pytest.approx(sign * white[i][c - 1], abs=1e-8)
    assert len(got[None]) == 4 and len(got[7]) == 8


def test_spectral_split_finds_what_eigh_finds():
    draw = np.random.default_rng(5)
    for width in (1, 2, 3, 8, 40):
        for values in (draw.random(width), 0.1 ** np.arange(width), np.repeat([2.0, 1.0], width)[:width] * 3,
                       np.r_[np.zeros(width // 2), np.ones(width - width // 2)], np.ones(width)):
            turn, _ = np.linalg.qr(draw.normal(size=(width, width)))
            v = turn * values @ turn.T
            v = (v + v.T) / 2
            got, columns = whitening.principal(v)
            assert np.allclose(got, np.sort(values)[::-1], atol=1e-13 * max(1, width))
            assert np.allclose(columns.T @ columns, np.eye(width), atol=1e-12)
            assert np.allclose(v @ columns, columns * got, atol=1e-12)
            few, first = whitening.principal(v, 3)
            assert np.allclose(few, got[:3]) and np.allclose(v @ first, first * few, atol=1e-12)


def test_polar_factor_is_the_sign():
    draw = np.random.default_rng(6)
    a = draw.normal(size=(12, 12))
    a = a + a.T
    values, columns = np.linalg.eigh(a)
    assert np.allclose(whitening.polar_factor(a), columns * np.sign(values) @ columns.T, atol=1e-12)


def vectors(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "vec_id BIGINT, embedding ARRAY<DOUBLE>")


def test_no_variance_and_no_rows(spark):
    assert whitening.fit(vectors(spark, [[0.5, 1.0]] * 5)).transform(vectors(spark, [[0.5, 1.0]])).count() == 0
    empty = vectors(spark, [])
    model = whitening.fit(empty)
    assert (model.centre.n, model.transform(empty).count()) == (0, 0)
    flat = whitening.fit(vectors(spark, [[0.0, 1.0, 5.0], [0.0, 3.0, 5.0], [0.0, 9.0, 5.0]]))
    assert flat.turn.shape == (3, 1) and flat.explained == [1.0]


def test_large_entries_stay_exact_and_beyond_64_bits_null(spark):
    rows = [[1e9, 0.25], [-1e9, 0.5], [3.0, -0.0], [1e300, 0.0]]
    model = whitening.fit(vectors(spark, rows[:3]), 1)
    got = {r["id"]: r["deviation"] for r in model.transform(vectors(spark, rows)).collect()}
    exact = brute(rows[:3])[1]
    assert [got[i] for i in range(3)] == [d if d < 1 << 63 else None for d in exact] and exact[2] < 1 << 63 < exact[0]
    assert got[3] is None
    small = whitening.fit(vectors(spark, [[1e5, 0.25], [-1e5, 0.5], [3.0, -0.001]]), 1)
    got = {r["id"]: r["deviation"] for r in small.transform(vectors(spark, [[1e5, 0.25], [-1e5, 0.5], [3.0, -0.001]])).collect()}
    assert [got[i] for i in range(3)] == brute([[1e5, 0.25], [-1e5, 0.5], [3.0, -0.001]])[1]


def test_packed_vectors_come_back():
    import pyarrow as pa

    rows = [[1, -2, 3], [40000, 0, 0], [1 << 40, -(1 << 50), 0], [-32768, 32767, 0], [-(1 << 31), 0, 5], [-(1 << 63), (1 << 63) - 1, 0]]
    column = pa.array([[c / 256 for c in r] for r in rows[:5]], pa.list_(pa.float64()))
    out = [x for b in whitening._pack_rows(iter([pa.RecordBatch.from_arrays([column], names=["v"])])) for x in whitening._unpacked(b.column(1))]
    assert sorted(map(tuple, np.vstack(out).tolist())) == sorted(map(tuple, rows[:5]))

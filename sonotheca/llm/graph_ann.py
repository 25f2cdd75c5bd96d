"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard.

**Build.**  Rows are dealt to shards of about ``shard_size`` by a hash of the id.  In each
shard nodes enter the graph in batches: a greedy beam search from the entry node proposes
neighbours, and robust pruning keeps an edge only if no kept edge leads ``alpha`` times
closer to the target.  Reverse edges are added and pruned again where a node has more
than ``degree``.  A second pass over all nodes repeats this on the finished graph.

**Search.**  Queries meet every shard in blocks of at most ``block`` queries.  A beam
search of width ``beam`` runs for all queries of a block at once; each shard returns its
``k`` best, measured again exactly, and the best of all shards are ranked by Spark.

Nearness is the inner product.  A shard's vectors get one more component that makes them
equally long, so that nearest by distance is the same as largest by inner product.
Equal vectors are one node with a list of ids, so hot groups of copies cost no edges and
ties are complete: of the copies in a shard the ``k`` smallest ids are enough.

The index has a row for every usable vector; nothing is sampled.  Memory of a task is a
shard and a block of queries, whatever the table's size.

Nulls and edge cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, neither do those whose length differs from the most common one,
nor rows with a null id.  Rows that repeat an id and vector are one candidate.  A query
finds all candidates if there are fewer than ``k``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonotheca.session import written

SHARD_SIZE = 4096
DEGREE = 32
BUILD_BEAM = 48
BEAM = 96
ALPHA = 1.2
BATCH = 256
BLOCK = 2048


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, with finite components only."""
    doubles = vector.cast("array<double>")
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(doubles, lambda x: x != 0), F.lit(False))


def _distances(near: np.ndarray, targets: np.ndarray, empty: np.ndarray) -> np.ndarray:
    """Squared distances of ``targets[i]`` to the points ``near[i]``; infinite where ``empty``."""
    away = np.matmul(near, targets[:, :, None])[..., 0]
    away *= -2
    away += np.einsum("ijk,ijk->ij", near, near)
    away += np.einsum("ik,ik->i", targets, targets)[:, None]
    return np.where(empty, np.inf, np.maximum(away, 0))


def beam_search(points: np.ndarray, edges: np.ndarray, entry: int, targets: np.ndarray, width: int):
    """The ``width`` nearest nodes found for every target and their distances, nearest first.

    All targets advance together: each expands its nearest unexpanded node per round.
    Places that were not filled hold node -1.
    """
    n, m = len(points), len(targets)
    rows = np.arange(m)
    seen = np.zeros((m, n + 1), dtype=bool)
    seen[:, n] = True  # stands for the empty place -1
    nodes = np.full((m, width), -1)
    away = np.full((m, width), np.inf)
    done = np.ones((m, width), dtype=bool)
    nodes[:, 0], done[:, 0], seen[:, entry] = entry, False, True
    away[:, 0] = ((points[entry] - targets) ** 2).sum(axis=1)
    active = rows
    while len(active):
        first = np.argmin(done[active], axis=1)
        at = nodes[active, first]
        done[active, first] = True
        near = edges[at]
        fresh = ~seen[active[:, None], near]
        near = np.where(fresh, near, -1)
        seen[active[:, None], near] = True
        distance = _distances(points[near], targets[active], near < 0)
        nodes_all = np.concatenate((nodes[active], near), axis=1)
        away_all = np.concatenate((away[active], distance), axis=1)
        done_all = np.concatenate((done[active], near < 0), axis=1)
        order = np.argsort(away_all, axis=1, kind="stable")[:, :width]
        nodes[active] = np.take_along_axis(nodes_all, order, 1)
        away[active] = np.take_along_axis(away_all, order, 1)
        done[active] = np.take_along_axis(done_all, order, 1)
        active = active[~done[active].all(axis=1)]
    return nodes, away


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For every node of ``own`` up to ``degree`` of its candidates, near ones and diverse ones.

    The nearest candidate is kept; it removes those it is ``alpha`` times closer to than
    the node itself; and so on with what is left.
    """
    candidates = np.sort(np.where(candidates == own[:, None], -1, candidates), axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    near = points[candidates]
    away = _distances(near, points[own], candidates < 0)
    squares = np.einsum("ijk,ijk->ij", near, near)
    kept = np.full((len(own), degree), -1)
    rows = np.arange(len(own))
    for j in range(degree):
        best = np.argmin(away, axis=1)
        live = np.isfinite(away[rows, best])
        if not live.any():
            break
        kept[:, j] = np.where(live, candidates[rows, best], -1)
        chosen = near[rows, best]
        to_chosen = squares - 2 * np.matmul(near, chosen[:, :, None])[..., 0] + squares[rows, best][:, None]
        away = np.where(live[:, None] & (alpha * alpha * to_chosen <= away), np.inf, away)
        away[rows, best] = np.inf
    return kept


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """Edges (node by place, -1 for none) and the entry node of one shard's graph."""
    n = len(points)
    edges = np.full((n, degree), -1)
    centre = points.mean(axis=0)
    entry = int(np.argmin(((points - centre) ** 2).sum(axis=1)))
    order = np.random.default_rng(5).permutation(n)
    for factor in (1.0, alpha):
        for at in range(0, n, BATCH):
            some = order[at:at + BATCH]
            found, _ = beam_search(points, edges, entry, points[some], beam)
            # the other members of the batch are proposed too: they are not linked yet
            own = points[some]
            squares = (own ** 2).sum(axis=1)
            nearest = np.argsort(squares[None, :] - 2 * own @ own.T, axis=1)[:, :degree // 2]
            proposed = np.concatenate((edges[some], found, some[nearest]), axis=1)
            edges[some] = robust_prune(points, some, proposed, degree, factor)
            _add_reverse(points, edges, some, degree, factor)
    return edges, entry


def _add_reverse(points: np.ndarray, edges: np.ndarray, some: np.ndarray, degree: int, alpha: float) -> None:
    """An edge back from every neighbour of ``some``; nodes with too many are pruned."""
    source = np.repeat(some, degree)
    target = edges[some].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    if not len(nodes):
        return
    extra = np.full((len(nodes), count.max()), -1)
    extra[np.repeat(np.arange(len(nodes)), count), np.arange(len(target)) - np.repeat(first, count)] = source
    merged = np.concatenate((edges[nodes], extra), axis=1)
    ordered = np.sort(merged, axis=1)[:, ::-1]
    fresh = np.ones(ordered.shape, dtype=bool)
    fresh[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    ordered = np.sort(np.where(fresh, ordered, -1), axis=1)[:, ::-1]
    fits = (ordered >= 0).sum(axis=1) <= degree
    width = min(degree, ordered.shape[1])
    edges[nodes[fits], :width] = ordered[fits, :width]
    if not fits.all():
        edges[nodes[~fits]] = robust_prune(points, nodes[~fits], ordered[~fits], degree, alpha)


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """The graph of one shard: a row per different vector with its ids and edges."""
    vectors = np.array(rows["vector"].tolist(), dtype=np.float64)
    distinct, inverse = np.unique(vectors, axis=0, return_inverse=True)
    inverse = inverse.ravel()
    order = np.lexsort((rows["id"].to_numpy(), inverse))
    cuts = np.searchsorted(inverse[order], np.arange(1, len(distinct)))
    ids = [np.unique(part) for part in np.split(rows["id"].to_numpy()[order], cuts)]
    squares = (distinct ** 2).sum(axis=1)
    level = np.column_stack((distinct, np.sqrt(np.maximum(squares.max() - squares, 0)))).astype(np.float32)
    edges, entry = build(level)
    return pd.DataFrame({
        "shard": rows["shard"].iloc[0], "node": np.arange(len(distinct)), "entry": entry, "ids": ids,
        "vector": list(distinct), "level": level[:, -1].astype(float), "edges": [e[e >= 0] for e in edges]})


def build_index(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                shard_size: int = SHARD_SIZE) -> DataFrame:
    """The index table: ``shard``, ``node``, ``entry``, ``ids``, ``vector``, ``level``, ``edges``."""
    rows = candidates(vectors, id_col, vector_col)
    shards = max(1, -(-rows.count() // shard_size))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)))
    schema = ("shard BIGINT, node BIGINT, entry BIGINT, ids ARRAY<BIGINT>, vector ARRAY<DOUBLE>, "
              "level DOUBLE, edges ARRAY<BIGINT>")
    return dealt.groupBy("shard").applyInPandas(_build_shard, schema)


def candidates(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``vector`` (doubles) of the usable rows."""
    rows = vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    width = rows.groupBy(F.size("vector").alias("w")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").first()
    return rows.where(F.size("vector") == (width["w"] if width else 0))


def _search_shard(k: int, beam: int, graph: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """The ``k`` best of one shard for every query of one block."""
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"),
                          "score": pd.Series(dtype="float64")})
    if not len(graph) or not len(asked):
        return empty
    graph = graph.sort_values("node")
    vectors = np.array(graph["vector"].tolist())
    points = np.column_stack((vectors, graph["level"].to_numpy())).astype(np.float32)
    edges = np.full((len(graph), max(1, graph["edges"].map(len).max())), -1)
    for i, own in enumerate(graph["edges"]):
        edges[i, :len(own)] = own
    ids = graph["ids"].tolist()
    targets = np.array(asked["vector"].tolist())
    level = np.column_stack((targets, np.zeros(len(targets)))).astype(np.float32)
    out_q, out_id, out_s = [], [], []
    for at in range(0, len(targets), BATCH):
        found, _ = beam_search(points, edges, int(graph["entry"].iloc[0]), level[at:at + BATCH], max(beam, k + 1))
        for q, nodes in enumerate(found, at):
            nodes = nodes[nodes >= 0]
            scores = (vectors[nodes] * targets[q]).sum(axis=1)
            own = asked["id"].iloc[q]
            some = [ids[node][:k + 1] for node in nodes]
            every = np.concatenate(some)
            each = np.repeat(scores, [len(s) for s in some])
            each, every = each[every != own], every[every != own]
            best = np.lexsort((every, -each))[:k]
            out_q.append(np.full(len(best), own))
            out_id.append(every[best])
            out_s.append(each[best])
    return pd.DataFrame({"query_id": np.concatenate(out_q), "id": np.concatenate(out_id), "score": np.concatenate(out_s)})


def search(index: DataFrame, queries: DataFrame, k: int, *, id_col: str = "id", vector_col: str = "vector",
           beam: int = BEAM, block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``id``, ``score``: the ``k`` best found for each query, without its own id."""
    asked = queries.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).dropDuplicates(["id"])
    asked = written(asked, "queries")
    blocks = max(1, -(-asked.count() // block))
    shards = written(index.select("shard").distinct(), "shards")
    # every shard meets every block of queries: the stated query set against all rows, in blocks
    parts = F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")
    spread = index.withColumn("block", F.explode(parts))
    n_shards = (shards.agg(F.max("shard")).first()[0] or 0) + 1
    each = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)).cast("array<bigint>")))
    hits = spread.groupBy("shard", "block").cogroup(each.groupBy("shard", "block")).applyInPandas(
        lambda graph, some: _search_shard(k, beam, graph, some), "query_id BIGINT, id BIGINT, score DOUBLE")
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return hits.withColumn("rank", ranked).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")

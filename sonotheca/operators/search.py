"""Nearest-neighbour search over the stored vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonotheca.fixed_values import NEAREST_K, UNKNOWN_SOURCE
from sonotheca.operators.embedding import Embedder, embed, offline_embedder
from sonotheca.operators.locate import FILE, ROW, fetch, is_located
from sonotheca.operators.ranking import first_per
from sonotheca.session import written

# Limits of one task: queries that are held together, stored vectors of one grid cell,
# and the most queries whose distances to a batch are computed together.  They change no result.
# Queries may only be sent to every task up to the broadcast limit.
BROADCAST_BYTES = 64 * 1024 * 1024
QUERY_CELL_ROWS = 8192
STORE_CELL_ROWS = 500_000
QUERY_BLOCK_ROWS = 1024
#: Distances that are held together, whatever the size of a batch.
DISTANCES = 1 << 20

# Distances are compared at this many binary digits of their own size, so that distances
# that are equal but for the order of additions tie and the id decides.
DISTANCE_BITS = 40

_NEAR = pa.schema([("qid", pa.int64()), ("id", pa.string()), ("distance", pa.float64())])
_NEAR_DDL = "qid BIGINT, id STRING, distance DOUBLE"


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Equally long Arrow lists as a two-dimensional array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty((0, 0))
    widths = pc.min_max(pc.list_value_length(column)).as_py()
    if widths["min"] != widths["max"]:
        raise ValueError("vectors of different length in one model")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


def _directions(vectors: np.ndarray, side: int) -> np.ndarray:
    """Vectors scaled to length 1, so that squared distance is twice the cosine distance.

    A zero vector has no direction.  It points along an extra axis of its own side
    (0 queries, 1 store), which puts it at cosine distance 1 from everything.
    """
    length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    unit = np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)
    extra = np.zeros((len(vectors), 2))
    extra[length[:, 0] == 0, side] = 1.0
    return np.hstack([unit, extra])


def _comparable(distance: np.ndarray) -> np.ndarray:
    """Distances cut to ``DISTANCE_BITS`` significant binary digits."""
    part, power = np.frexp(distance)
    return np.ldexp(np.round(part * 2.0**DISTANCE_BITS), power - DISTANCE_BITS)


def _closest(
    qids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int,
    bound: np.ndarray,
) -> list[tuple]:
    """The ``k`` closest of some vectors for every query, ties by id.

    One matrix product gives all distances but for rounding.  Whatever lies within
    the rounding error of the k-th, and of the ``bound`` reached by earlier vectors,
    is measured again exactly and ranked.  So are vectors whose squares overflow.
    """
    if queries.shape[1] != vectors.shape[1]:
        raise ValueError("queries and store differ in vector length")
    with np.errstate(over="ignore", invalid="ignore"):
        q_norm, v_norm = (queries**2).sum(axis=1), (vectors**2).sum(axis=1)
        huge = ~np.isfinite(v_norm)
        slack = 1e-12 * (q_norm + v_norm[~huge].max(initial=0.0))
    top = min(k, len(ids))
    found = []
    rows = max(1, min(QUERY_BLOCK_ROWS, DISTANCES // max(1, len(ids))))
    for begin in range(0, len(qids), rows):
        block = slice(begin, begin + rows)
        with np.errstate(over="ignore", invalid="ignore"):
            rough = queries[block] @ vectors.T
            rough *= -2.0
            rough += q_norm[block, None] + v_norm[None, :]
        rough[:, huge] = np.inf
        kth = np.partition(rough, top - 1, axis=1)[:, top - 1]
        reach = np.minimum(kth, bound[block]) + slack[block]
        measured = ~np.isfinite(q_norm[block]) | huge.any() | (rough.min(axis=1) <= reach)
        for row in np.flatnonzero(measured):
            sure = np.isfinite(q_norm[begin + row])
            near = np.flatnonzero((rough[row] <= reach[row]) | huge) if sure else np.arange(len(ids))
            with np.errstate(over="ignore"):
                gap = vectors[near] - queries[begin + row]
                exact = _comparable((gap * gap).sum(axis=1))
            best = np.lexsort((ids[near], exact))[:top]
            found.append((np.full(len(best), qids[begin + row]), ids[near][best], exact[best]))
    return found


def _of_model(rows: pa.RecordBatch | pa.Table, model: str) -> pa.RecordBatch | pa.Table:
    """The rows of a model that have a vector."""
    return rows.filter(pc.and_(pc.equal(rows["model"], model), pc.is_valid(rows["embedding"])))


def _by_model(table: pa.Table, cosine: bool) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Query ids and vectors of each model, as plain arrays that can be broadcast."""
    grouped = {}
    for model in sorted(table["model"].unique().drop_null().to_pylist()):
        picked = _of_model(table, model)
        if not picked.num_rows:
            continue
        vectors = _matrix(picked["embedding"])
        grouped[model] = (picked["qid"].to_numpy(), _directions(vectors, 0) if cosine else vectors)
    return grouped


def _search_batch(
    queries: dict, batch: pa.RecordBatch | pa.Table, k: int, cosine: bool, best: tuple | None = None
) -> tuple | None:
    """The ``k`` best per query of this batch and of the ``best`` found before it."""
    found = [best] if best else []
    for model, (qids, q_vectors) in queries.items():
        rows = _of_model(batch, model)
        if not rows.num_rows:
            continue
        vectors = _matrix(rows["embedding"])
        if cosine:
            vectors = _directions(vectors, 1)
        ids = np.array(rows["id"].to_pylist(), dtype=object)
        found += _closest(qids, q_vectors, ids, vectors, k, _bounds(best, qids, k))
    return _k_best(found, k) if found else None


def _bounds(best: tuple | None, qids: np.ndarray, k: int) -> np.ndarray:
    """The k-th distance of every query so far, infinite until it has ``k`` candidates."""
    if not best or not len(best[0]):
        return np.full(len(qids), np.inf)
    end = np.searchsorted(best[0], qids, side="right")
    have = end - np.searchsorted(best[0], qids, side="left")
    return np.where(have >= k, best[2][np.maximum(end - 1, 0)], np.inf)


def _k_best(found: list[tuple], k: int) -> tuple:
    """Merge several sets of candidates, each within ``k`` already, into the ``k`` best per query."""
    if len(found) == 1:
        return found[0]
    qid, ids, distance = (np.concatenate(part) for part in zip(*found))
    order = np.lexsort((ids, distance, qid))
    qid, ids, distance = qid[order], ids[order], distance[order]
    place = np.arange(len(qid)) - np.searchsorted(qid, qid, side="left")
    keep = place < k
    return qid[keep], ids[keep], distance[keep]


def _as_arrow(best: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(best[0], pa.int64()), pa.array(best[1], pa.string()), pa.array(best[2], pa.float64())],
        schema=_NEAR,
    )


def usable(vector: Column | str) -> Column:
    """Whether a vector is there and all its components are finite."""
    value = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite, F.lit(False))


def unusable(vectors: DataFrame, key: str = "id") -> DataFrame:
    """``key, reason`` of the rows that a search passes over, one by one."""
    value = F.col("embedding").cast("array<double>")
    reason = F.when(F.col("model").isNull(), "no model").when(value.isNull(), "no vector").otherwise("not finite")
    return vectors.filter(F.col("model").isNull() | ~usable(value)).select(key, reason.alias("reason"))


def nearest(
    queries: DataFrame, store: DataFrame, k: int = NEAREST_K, metric: str = "l2",
    layout: str = "grid",
) -> DataFrame:
    """``qid, rank, id, distance`` of the ``k`` stored vectors nearest to every query.

    ``queries`` has ``qid, model, embedding``, ``store`` has ``id, model, embedding``
    with unique ids; only vectors of the same model are compared, and a row without
    model or with a vector that is missing or not finite takes no part (``unusable``
    lists those).  ``metric`` is ``l2`` (squared distance) or ``cosine``; equal
    distances rank by id.  The search is exact: each task keeps ``k`` candidates per
    query and only these are shuffled.

    ``layout`` only decides where the work is done.  ``grid`` works for any number of
    queries: they are hashed to cells, which meet the store in a grid.  ``broadcast``
    sends all queries to every task and scans the store in place; more than
    ``BROADCAST_BYTES`` of them are refused.
    """
    if metric not in ("l2", "cosine"):
        raise ValueError(f"unknown metric {metric}")
    if layout not in ("grid", "broadcast"):
        raise ValueError(f"unknown layout {layout}")
    cosine = metric == "cosine"
    asked = written(_vectors(queries, "qid", "bigint"), "asked")
    stored = _vectors(store, "id", "string")
    scan = _search_broadcast if layout == "broadcast" else _search_grid
    best = first_per(scan(asked, stored, k, cosine), ["qid"], [F.col("distance"), F.col("id")], k, rank_as="rank")
    distance = F.col("distance") / 2 if cosine else F.col("distance")
    return best.select("qid", "rank", "id", distance.alias("distance"))


def _vectors(rows: DataFrame, key: str, kind: str) -> DataFrame:
    cast = rows.select(
        F.col(key).cast(kind).alias(key), "model", F.col("embedding").cast("array<double>").alias("embedding")
    )
    return cast.filter(F.col("model").isNotNull() & usable("embedding"))


def _search_broadcast(asked: DataFrame, stored: DataFrame, k: int, cosine: bool) -> DataFrame:
    size = 8 * (asked.agg(F.sum(F.size("embedding"))).first()[0] or 0)
    if size > BROADCAST_BYTES:
        raise ValueError(f"{size} bytes of queries exceed the broadcast limit; use layout='grid'")
    shared = stored.sparkSession.sparkContext.broadcast(_by_model(asked.toArrow(), cosine))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            best = _search_batch(shared.value, batch, k, cosine, best)
        if best:
            yield _as_arrow(best)

    return stored.mapInArrow(scan, _NEAR_DDL)


def _search_grid(asked: DataFrame, stored: DataFrame, k: int, cosine: bool) -> DataFrame:
    """Every query cell meets every store cell in one place, without broadcast or driver.

    Both numbers of cells follow the tables.  A cell pair is one partition: it receives
    its queries first and then streams its share of the store, so a task holds one query
    cell and one batch, and no task sorts more than a cell of the store.
    """
    q_cells = max(1, -(-asked.count() // QUERY_CELL_ROWS))
    s_cells = max(1, -(-stored.count() // STORE_CELL_ROWS))
    cores = asked.sparkSession.sparkContext.defaultParallelism
    s_cells = max(s_cells, -(-cores // q_cells))

    def hashed(key: str, cells: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(cells)).cast("int")

    def every(cells: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))

    left = asked.withColumn("q_cell", hashed("qid", q_cells)).withColumn("s_cell", every(s_cells))
    right = stored.withColumn("s_cell", hashed("id", s_cells)).withColumn("q_cell", every(q_cells))
    rows = left.withColumn("stored", F.lit(0)).unionByName(
        right.withColumn("stored", F.lit(1)), allowMissingColumns=True
    )
    placed = rows.repartitionById(
        q_cells * s_cells, F.col("q_cell") * s_cells + F.col("s_cell")
    ).sortWithinPartitions("q_cell", "s_cell", "stored")

    def scan_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, queries, best = None, [], None, None
        for batch in batches:
            for here, is_store, piece in _cell_pieces(batch):
                if here != cell:
                    if best:
                        yield _as_arrow(best)
                    cell, held, queries, best = here, [], None, None
                if not is_store:
                    held.append(piece)
                    continue
                if queries is None:
                    queries = _by_model(pa.Table.from_batches(held), cosine) if held else {}
                best = _search_batch(queries, piece, k, cosine, best)
        if best:
            yield _as_arrow(best)

    return placed.mapInArrow(scan_cells, _NEAR_DDL)


def _cell_pieces(batch: pa.RecordBatch) -> Iterator[tuple[tuple, bool, pa.RecordBatch]]:
    """A sorted batch cut where the cell, or queries to store, changes."""
    place = np.stack([batch[c].to_numpy() for c in ("q_cell", "s_cell", "stored")], axis=1)
    starts = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1).tolist(), len(place)]
    for begin, end in zip(starts, starts[1:]):
        if end > begin:
            q_cell, s_cell, stored = place[begin].tolist()
            yield (q_cell, s_cell), bool(stored), batch.slice(begin, end - begin)


def require_same_model(queries: DataFrame, models: DataFrame) -> None:
    """Refuse queries whose model filled none of ``models``; an empty table is fine."""
    known = models.select("model").distinct()
    stranger = queries.select("model").distinct().join(known, "model", "left_anti").first()
    if stranger is not None and not known.isEmpty():
        raise ValueError(f"the store holds no vectors of model {stranger['model']!r}")


def same_model(queries: DataFrame, store: DataFrame) -> DataFrame:
    """``queries`` with ``comparable``: whether the store was filled by their model."""
    known = store.select("model").distinct().withColumn("comparable", F.lit(True))
    return queries.join(known, "model", "left").withColumn(
        "comparable", F.coalesce("comparable", F.lit(False))
    )


def label_source(results: DataFrame, metadata: str = "metadata") -> DataFrame:
    """Adds ``source``, ``podcast`` and ``title`` of the hits.

    The source is the record's ``source_file`` when it has one, else ``Unknown``;
    the standard record has none.
    """
    fields = results.schema[metadata].dataType.fieldNames()
    named = F.col(f"{metadata}.source_file") if "source_file" in fields else F.lit(None)
    return results.withColumn(
        "source", F.coalesce(named.cast("string"), F.lit(UNKNOWN_SOURCE))
    ).withColumns({n: F.col(f"{metadata}.{n}") for n in ("podcast", "title") if n in fields})


def search(
    queries: DataFrame, store: DataFrame, k: int = NEAREST_K, embedder: Embedder | None = None,
    metric: str = "l2", text: str = "text", layout: str = "grid", models: DataFrame | None = None,
) -> DataFrame:
    """``qid, rank, id, distance, document, source`` of the nearest chunks to query texts.

    The questions are embedded once, and the hits are a table, so Spark knows its size
    when it fetches the documents of the winning ids.  A store with the places of its rows
    (``located``, or ``current_chunks`` with that option) hands them on with the hits, and
    documents are then read from the files of the hits only; otherwise the store is scanned
    for them.  ``models`` names a small table with the ``model`` of the store, for example its
    ``collections``; without it the store's own column is read.  No neighbours give an empty
    result.
    """
    chosen = embedder or offline_embedder()
    asked = written(embed(queries.select("qid", text), text, chosen), "questions")
    require_same_model(asked, store if models is None else models)
    shown = [c for c in ("document", "metadata") if c in store.columns]
    found = None
    if is_located(store):
        hits = written(_split_place(nearest(asked, _with_place(store), k, metric, layout)), "hits")
        found = fetch(hits, store, shown)
        found = None if found is None else found.drop(FILE, ROW)
        hits = hits.drop(FILE, ROW)
    else:
        hits = written(nearest(asked, store, k, metric, layout), "hits")
    if found is None:
        found = hits.join(store.select("id", *shown), "id")
    if "metadata" in shown:
        found = label_source(found).drop("metadata")
    else:
        found = found.withColumn("source", F.lit(UNKNOWN_SOURCE))
    first = ["qid", "rank", "id", "distance", "document", "source"]
    return found.select(*first, *[c for c in found.columns if c not in first])


# The place of a row travels behind its id.  The character between them sorts before all
# others, so equal distances still rank by id.
_BEHIND = "\0"


def _with_place(store: DataFrame) -> DataFrame:
    place = F.concat(F.col("id"), F.lit(_BEHIND), F.col(ROW).cast("string"), F.lit(_BEHIND), F.col(FILE))
    return store.withColumn("id", place)


def _split_place(hits: DataFrame) -> DataFrame:
    parts = F.split("id", _BEHIND)
    size = F.size(parts)
    return hits.withColumns({
        FILE: F.get(parts, size - 1), ROW: F.get(parts, size - 2).cast("bigint"),
        "id": F.array_join(F.slice(parts, 1, size - 2), _BEHIND)})

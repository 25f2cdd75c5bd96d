"""Exact nearest neighbours with fewer comparisons: vectors ordered by their distance to pivots.

Every stored vector belongs to the cell of its nearest pivot, and inside the cell to a ring of
similar distance to it.  For a query at distance *d* from a pivot, a vector at distance *r* from
the same pivot is at least ``|d - r|`` away (triangle inequality).  Once ``k`` vectors are
known, a ring that is farther away than the worst of them cannot hold a better one and is
skipped.  The result is that of the full scan, row by row.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonotheca.fixed_values import NEAREST_K
from sonotheca.operators.ranking import first_per
from sonotheca.operators.search import QUERY_CELL_ROWS, _NEAR_DDL, _as_arrow, _by_model, _cell_pieces, _matrix, _search_batch, _vectors
from sonotheca.session import written

PIVOTS = 32
#: Vectors that pivots are chosen from: those with the smallest id hashes.
SAMPLE = 2048
#: Vectors of one block, which is compared as a whole.
BLOCK_ROWS = 20_000
_SLACK = 1e-9


def _chosen(vectors: np.ndarray, n: int) -> np.ndarray:
    """Pivots far from one another: each the vector farthest from those before."""
    picked = [0]
    with np.errstate(over="ignore"):
        gap = ((vectors - vectors[0]) ** 2).sum(axis=1)
        while len(picked) < min(n, len(vectors)) and gap.max() > 0:
            picked.append(int(gap.argmax()))
            gap = np.minimum(gap, ((vectors - vectors[picked[-1]]) ** 2).sum(axis=1))
    return vectors[picked]


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of all vectors to all pivots, each from the differences."""
    with np.errstate(over="ignore"):
        return np.stack([np.sqrt(((vectors - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def _cell_rows(pivots: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nearest pivot of every vector, and the distance to it."""
    for batch in batches:
        if batch.num_rows:
            near = _distances(_matrix(batch["embedding"]), pivots)
            cell = near.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(near[np.arange(len(cell)), cell])],
                names=[*batch.schema.names, "cell", "r"])


def _query_rows(pivots: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distance of every query to every pivot."""
    for batch in batches:
        if batch.num_rows:
            near = _distances(_matrix(batch["embedding"]), pivots)
            n, m = near.shape
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch["qid"].to_numpy(), m)), pa.array(np.tile(np.arange(m, dtype=np.int32), n)), pa.array(near.ravel())],
                names=["qid", "cell", "d"])


def _scan_blocks(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ``k`` best of every query in every block: a cell's queries come first, then the block's vectors."""
    block, held, queries, best = None, [], None, None
    for batch in batches:
        for here, is_store, piece in _cell_pieces(batch):
            if here != block:
                if best:
                    yield _as_arrow(best)
                block, held, queries, best = here, [], None, None
            if not is_store:
                held.append(piece)
                continue
            if queries is None:
                queries = _by_model(pa.Table.from_batches(held), False) if held else {}
            best = _search_batch(queries, piece, k, False, best)
    if best:
        yield _as_arrow(best)


@dataclass
class PivotIndex:
    """``rows``: vectors with their block; ``blocks``: cell, nearest and farthest distance, and size of each."""

    model: str
    pivots: np.ndarray
    rows: DataFrame
    blocks: DataFrame

    def placed(self, asked: DataFrame, pairs: DataFrame, cell_rows: int = QUERY_CELL_ROWS) -> DataFrame:
        """Queries and vectors of every block together, in cells of about ``cell_rows`` queries at most.

        A block that more queries reach is compared in several cells, each with its own copy of
        the block, so what a task holds does not grow with the queries.
        """
        cells = pairs.groupBy("block").agg(F.ceil(F.count("*") / cell_rows).cast("int").alias("_cells"))
        q_cell = F.pmod(F.xxhash64("qid"), F.col("_cells")).cast("int")
        left = pairs.select("qid", "block").join(cells, "block").withColumn("q_cell", q_cell).drop("_cells") \
            .join(asked, "qid").withColumn("stored", F.lit(0))
        # blocks that no query reaches are not read on
        right = self.rows.join(cells, "block").withColumn("q_cell", F.explode(F.sequence(F.lit(0), F.col("_cells") - 1)))
        both = left.unionByName(right.select("block", "id", "model", "embedding", "q_cell", F.lit(1).alias("stored")), allowMissingColumns=True)
        return both.withColumn("s_cell", F.col("block")).repartition("block", "q_cell").sortWithinPartitions("q_cell", "s_cell", "stored")

    def _candidates(self, asked: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
        """The ``k`` best of every query in each of its blocks."""
        return self.placed(asked, pairs).mapInArrow(functools.partial(_scan_blocks, k), _NEAR_DDL)

    def reached(self, asked: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
        """The pairs ``qid, block`` that have to be compared, and the candidates found on the way."""
        gaps = written(asked.mapInArrow(functools.partial(_query_rows, self.pivots), "qid BIGINT, cell INT, d DOUBLE"), "gaps")
        near = first_per(gaps, ["qid"], [F.col("d"), F.col("cell")])
        away = F.greatest(F.col("lo") - F.col("d"), F.col("d") - F.col("hi"), F.lit(0.0))
        pairs = near.join(self.blocks, "cell").withColumn("away", away)
        first = written(first_per(pairs, ["qid"], [F.col("away"), F.col("block")]).select("qid", "block"), "first")
        found = written(self._candidates(asked, first, k), "first-found")
        worst = found.groupBy("qid").agg(F.when(F.count("*") >= k, F.sqrt(F.max("distance"))).alias("worst"))
        slack = _SLACK * (F.lit(1.0) + F.col("d") + F.when(F.col("hi") < float("inf"), F.col("hi")).otherwise(0.0))
        within = F.coalesce(away <= F.col("worst") * (1 + _SLACK) + slack, F.lit(True))
        rest = (
            gaps.join(worst, "qid", "left").join(self.blocks, "cell").filter(within)
            .select("qid", "block").join(first, ["qid", "block"], "left_anti")
        )
        return written(rest, "rest"), found

    def nearest(self, queries: DataFrame, k: int = NEAREST_K) -> DataFrame:
        """``qid, rank, id, distance`` as ``nearest`` gives them, by squared distance.

        Queries of another model, and those without a usable vector, find nothing.
        """
        asked = written(_vectors(queries, "qid", "bigint").filter(F.col("model") == self.model), "asked")
        rest, found = self.reached(asked, k)
        every = found.unionByName(self._candidates(asked, rest, k))
        best = first_per(every, ["qid"], [F.col("distance"), F.col("id")], k, rank_as="rank")
        return best.select("qid", "rank", "id", "distance")


def build_index(store: DataFrame, model: str, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> PivotIndex:
    """Order the vectors of a model by pivots.

    ``store`` holds ``id, model, embedding`` with unique ids; rows without a usable vector are left
    out.  Pivots come from a bounded sample, everything else covers all rows.  A ring that holds
    more than ``block_rows`` vectors, such as many copies of one, is dealt to several blocks by id.
    """
    rows = _vectors(store, "id", "string").filter(F.col("model") == model)
    some = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    centres = _chosen(_matrix(some["embedding"]), pivots) if some.num_rows else np.zeros((1, 1))
    own = "id STRING, model STRING, embedding ARRAY<DOUBLE>"
    placed = written(rows.mapInArrow(functools.partial(_cell_rows, centres), f"{own}, cell INT, r DOUBLE"), "cells")

    cells = placed.groupBy("cell").agg(F.min("r").alias("_lo"), F.max("r").alias("_hi"), F.ceil(F.count("*") / block_rows).alias("_rings"))
    share = (F.col("r") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    ring = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor(F.nanvl(share, F.lit(1.0)) * F.col("_rings")), F.col("_rings") - 1)).otherwise(0)
    ringed = placed.join(F.broadcast(cells), "cell").withColumn("ring", F.coalesce(ring, F.lit(0)).cast("int"))  # a row a pivot
    sizes = ringed.groupBy("cell", "ring").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("id"), F.col("_parts"))

    def number(*names: str) -> Column:
        return F.xxhash64(*names).alias("block")  # two blocks of one number are compared together, which changes no result

    blocked = ringed.join(sizes, ["cell", "ring"]).withColumn("part", part)
    table = written(blocked.select(number("cell", "ring", "part"), "id", "model", "embedding", "cell", "r"), "pivot-index")
    blocks = table.groupBy("block", "cell").agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.count("*").alias("n"))
    return PivotIndex(model, centres, table, written(blocks, "pivot-blocks"))

"""Whitening of embeddings on principal components found by spectral divide and conquer.

Every vector is taken on a grid of 1/256 (``floor(256 * c)``), so counts, sums and
deviations are exact whole numbers.  The components come from the covariance of all
distinct grid vectors.  Its matrix has the size of a vector squared, whatever the number of
rows, and is the only thing the driver solves: a shifted copy ``V - s I`` has a polar
factor with eigenvalues +1 and -1, computed by the dynamically weighted Halley iteration
(QDWH), so half of it plus the identity projects on the components above the shift.  Both
subspaces are split again in the same way until single components are left.  The mean and
the few whitening vectors then travel to all tasks, which whiten the table in one pass
without a shuffle.

Distinct vectors are shuffled once, as packed whole numbers of the least width; copies are
merged before the shuffle, so a vector that makes up a third of the table is one row a task.
Sums and products are added up per task first.

Nulls and edge cases: vectors that are null, empty or hold null or non-finite entries take no
part.  If lengths differ, the length with most distinct vectors (of equal ones the greater)
takes part and others do not.  Entries beyond 64 bits on the grid are held at its ends.  A
deviation beyond 64 bits is null.  Components without variance cannot be whitened and are
left out, so equal vectors or a single one give no component; an empty table gives none.
Rows that repeat, also with a null id, are each whitened; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonotheca.session import written

GRID = 256
_TOP = float(1 << 63)
_LIMIT = (1 << 63) - 1


# -- the matrix side, in the driver ------------------------------------------------------

def polar_factor(a: np.ndarray, rounds: int = 40) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH."""
    m = len(a)
    x = a / np.linalg.norm(a)
    least = 1e-17  # a lower bound of the singular values; a smaller one only costs rounds
    for _ in range(rounds):
        square = least * least
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        u = root + 0.5 * np.sqrt(np.maximum(8 - 4 * d + 8 * (2 - square) / (square * root), 0))
        v = (u - 1) ** 2 / 4
        w = u + v - 1
        if w > 100:  # the stable form while the matrix is far from orthogonal
            q, _ = np.linalg.qr(np.vstack([np.sqrt(w) * x, np.eye(m)]))
            new = v / w * x + (u - v / w) / np.sqrt(w) * (q[:m] @ q[m:].T)
        else:
            new = v / w * x + (u - v / w) * np.linalg.solve(np.eye(m) + w * (x.T @ x), x.T).T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, least = new, min(1.0, least * (u + v * square) / (1 + w * square))
        if moved < 1e-13 * np.sqrt(m) and 1 - least < 1e-12:
            break
    return x


def _bases(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the invariant subspaces above and below a shift inside the spectrum."""
    m, size = len(a), np.linalg.norm(a)
    mean = np.trace(a) / m
    spread = np.linalg.norm(a - mean * np.eye(m)) / np.sqrt(m)
    best = None
    # the mean has eigenvalues on both sides; it is moved only if it meets one of them
    for step in (0, 0.11, -0.13, 0.31, -0.37, 0.71, -0.73):
        projector = (polar_factor(a - (mean + step * spread) * np.eye(m)) + np.eye(m)) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < m:
            continue
        largest = np.argsort(-np.linalg.norm(projector, axis=0), kind="stable")[:rank]
        start = projector[:, largest]
        for _ in range(3):
            q, _ = np.linalg.qr(start, mode="complete")
            above, below = q[:, :rank], q[:, rank:]
            left = np.linalg.norm(below.T @ a @ above)
            if best is None or left < best[0]:
                best = left, above, below
            start = projector @ above
        if best[0] <= 1e-14 * m * size:
            break
    if best is None:
        raise ArithmeticError("no shift splits the covariance")
    return best[1], best[2]


def principal(v: np.ndarray, wanted: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    size = len(v)
    wanted = size if wanted is None else min(wanted, size)
    nothing = 4 * np.finfo(float).eps * np.linalg.norm(v)
    values, vectors = [], []
    open_ = [(np.eye(size), v)]
    while open_ and len(values) < wanted:  # the subspace with the largest eigenvalues is on top
        basis, part = open_.pop()
        m = len(part)
        if m == 1 or np.linalg.norm(part - np.trace(part) / m * np.eye(m)) <= nothing:
            values += list(np.diag(part))
            vectors += list(basis.T)
            continue
        for q in reversed(_bases(part)):
            inner = q.T @ part @ q
            open_.append((basis @ q, (inner + inner.T) / 2))
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    columns = np.array(vectors).reshape(len(values), size)[order].T
    front = np.abs(columns).argmax(axis=0)
    return np.array(values)[order], columns * np.sign(columns[front, np.arange(columns.shape[1])])


# -- the table side, in Arrow batches ----------------------------------------------------

def _grid(values: np.ndarray) -> np.ndarray:
    scaled = np.floor(GRID * values)
    inside = np.clip(scaled, -_TOP, np.nextafter(_TOP, 0)).astype(np.int64)
    return np.where(scaled >= _TOP, _LIMIT, inside)


def grid_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and grid vectors of the usable vectors of a batch, by length."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    if flat.null_count:
        values[flat.is_null().to_numpy(zero_copy_only=False)] = np.nan
    with np.errstate(over="ignore"):
        odd = ~np.isfinite(values)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    usable = (lengths > 0) & (np.bincount(owner, odd, minlength=len(lengths)) == 0)
    first = np.cumsum(lengths) - lengths
    for width in np.unique(lengths[usable]):
        rows = np.flatnonzero(usable & (lengths == width))
        with np.errstate(over="ignore"):
            yield rows, _grid(values[first[rows][:, None] + np.arange(width)])


def _binary(table: np.ndarray) -> pa.Array:
    """Rows of a byte matrix as a binary column."""
    n, width = table.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(table.tobytes())])


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every usable vector as its whole numbers' width in bytes, then the numbers; equal ones are equal bytes."""
    for batch in batches:
        for _, x in grid_vectors(batch.column(0)):
            most = np.maximum(x.max(axis=1), -(x.min(axis=1) + 1))
            step = np.select([most < 1 << 15, most < 1 << 31], [2, 4], 8)
            for size in np.unique(step):
                part = x[step == size].astype(f"<i{size}")
                for at in range(0, len(part), 1 << 14):
                    body = np.ascontiguousarray(part[at:at + (1 << 14)]).view(np.uint8).reshape(-1, part.shape[1] * size)
                    head = np.full((len(body), 1), size, np.uint8)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(body), x.shape[1], np.int32)), _binary(np.hstack([head, body]))],
                        names=["width", "x"])


def _unpacked(column: pa.Array) -> Iterator[np.ndarray]:
    """Packed vectors of one length as matrices."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    if not len(column):
        return
    heads = data[offsets[:-1]]
    for size in np.unique(heads):
        rows = np.flatnonzero(heads == size)
        length = int(offsets[rows[0] + 1] - offsets[rows[0]])
        body = data[offsets[rows][:, None] + np.arange(1, length)]
        yield np.ascontiguousarray(body).view(f"<i{size}").astype(np.int64)


def _sum_rows(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: how many vectors, and per dimension the sums of the upper and lower 32 bits."""
    n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
    for batch in batches:
        for x in _unpacked(batch.column(0)):
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width, dtype=np.int32)), pa.array(np.full(width, n)), pa.array(high), pa.array(low)],
            names=["dim", "n", "high", "low"])


@dataclass
class Centre:
    """The number of distinct vectors and their exact sums per dimension."""

    n: int
    sums: list[int]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``, rounded once: whole parts are subtracted as whole numbers."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        safe = max(int(np.abs(x.astype(np.float64)).max(initial=0)), int(np.abs(whole.astype(np.float64)).max(initial=0))) < 1 << 62
        return (x - whole).astype(np.float64) - rest if safe else x.astype(np.float64) - (whole + rest)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n * x - S)`` squared, exact; None beyond 64 bits."""
        most = int(np.abs(x.astype(np.float64)).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        if most * most * max(1, x.shape[1]) < _LIMIT // 2:
            t = x * np.int64(self.n) - np.array(self.sums, dtype=np.int64)
            return (t * t).sum(axis=1).tolist()
        exact = [sum((self.n * c - s) ** 2 for c, s in zip(row, self.sums)) for row in x.tolist()]
        return [d if d <= _LIMIT else None for d in exact]


def _product_rows(centre: Centre, turn: np.ndarray | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: the sums of products of centred vectors, or of their images under ``turn``."""
    width = len(centre.sums) if turn is None else turn.shape[1]
    total = np.zeros((width, width))
    for batch in batches:
        for x in _unpacked(batch.column(0)):
            y = centre.centred(x) if turn is None else centre.centred(x) @ turn
            total += y.T @ y
    i, j = np.triu_indices(width)
    yield pa.RecordBatch.from_arrays(
        [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])


def _covariance(fit_list: DataFrame, centre: Centre, turn: np.ndarray | None = None) -> np.ndarray:
    rows = fit_list.mapInArrow(functools.partial(_product_rows, centre, turn), "i INT, j INT, v DOUBLE")
    width = len(centre.sums) if turn is None else turn.shape[1]
    out = np.zeros((width, width))
    for i, j, v in rows.groupBy("i", "j").agg(F.sum("v")).collect():  # a vector's length squared
        out[i, j] = out[j, i] = v / centre.n
    return out


@dataclass
class Whitening:
    """Centre, components (as columns, scaled to unit variance) and what they explain."""

    centre: Centre
    turn: np.ndarray
    explained: list[float]
    identity_error: float

    def transform(self, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
        """``id``, the exact ``deviation`` from the centre, and the ``whitened`` values of every usable vector."""
        schema = T.StructType([
            T.StructField("id", vectors.schema[id_col].dataType), T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.ArrayType(T.DoubleType()))])
        return _columns(vectors, id_col, vector_col).mapInArrow(functools.partial(_white_rows, self), schema)


def _white_rows(model: Whitening, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, x in grid_vectors(batch.column(1)):
            if x.shape[1] != len(model.centre.sums) or not model.turn.shape[1]:
                continue
            values = model.centre.centred(x) @ model.turn
            offsets = np.arange(len(x) + 1, dtype=np.int32) * values.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(model.centre.deviations(x), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))],
                names=["id", "deviation", "whitened"])


def _columns(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))


def fit(vectors: DataFrame, components: int | None = None, vector_col: str = "embedding") -> Whitening:
    """Learn the ``components`` largest components (all by default) from all distinct vectors."""
    own = vectors.select(F.col(vector_col).cast("array<double>").alias("vector"))
    distinct = written(own.mapInArrow(_pack_rows, "width INT, x BINARY").distinct(), "vectors")
    lengths = distinct.groupBy("width").count().orderBy(F.desc("count"), F.desc("width")).first()
    if lengths is None:
        return Whitening(Centre(0, []), np.empty((0, 0)), [], 0.0)
    width = lengths["width"]
    fit_list = distinct.where(F.col("width") == width).select("x")
    exact = F.sum(F.col("high").cast("decimal(38,0)")), F.sum(F.col("low").cast("decimal(38,0)"))
    sums = (fit_list.mapInArrow(functools.partial(_sum_rows, width), "dim INT, n BIGINT, high BIGINT, low BIGINT")
            .groupBy("dim").agg(F.sum("n"), *exact).orderBy("dim").collect())  # one row a dimension
    centre = Centre(sums[0][1], [(int(high) << 32) + int(low) for _, _, high, low in sums])
    covariance = _covariance(fit_list, centre)
    values, columns = principal(covariance, components)
    whole = float(np.trace(covariance))
    real = values > 16 * width * np.finfo(float).eps * whole
    turn = columns[:, real] / np.sqrt(values[real])
    error = 0.0
    if real.any():
        error = float(np.abs(_covariance(fit_list, centre, turn) - np.eye(turn.shape[1])).max())
    return Whitening(centre, turn, [float(e) / whole for e in values[real]], error)

"""Operator 12: whitening of embeddings by repeated, shifted CholeskyQR.

Rows are scaled to whole numbers (``floor(64 * c) + 1000000``), so sums and
deviations are exact. With Y the centred rows and R an upper triangle, a *Gram
pass* has every task solve its rows against R (``Q = Y R^-1``, a triangular
solve), add up ``Q^T Q`` of its rows, and the tasks' matrices are added up in
two steps. The driver takes the Cholesky factor of that one matrix and composes
it onto R. The first pass (R = I) adds a shift to the diagonal, so that its
factor exists however ill-conditioned Y is; each further pass brings Q closer
to orthonormal, until ``Q^T Q`` is the identity to rounding. Then
``Y = Q R``: the singular value decomposition of R (dimension x dimension)
gives the eigenvectors and eigenvalues of the covariance to double precision,
without squaring Y's condition number. What reaches the driver is one sum a
dimension and one matrix a pass, whatever the number of rows.

Defined results: rows whose vector is null, empty, or holds a null or
non-finite entry take no part, nor do those whose scaled entries exceed
``2 ** 52`` or whose length is not the table's most frequent one (of equally
frequent ones the longest); repeated rows and null vec_ids are rows like
others; a component without variance (to rounding) has no whitened value and
is left out, so rows that are all alike give none; an empty table gives no
rows; other input columns are ignored. A deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table

SCALE, OFFSET = 64, 1_000_000
#: Gram passes at most (three do unless the rows are rank-deficient), and when Q counts as orthonormal.
PASSES = 5
ORTHONORMAL = 1e-13
#: Of the largest eigenvalue: below it a component counts as without variance.
NO_VARIANCE = 1e-18
MATRICES_A_TASK = 256
ROUND_ROWS = 1 << 12
_LIMIT = float(1 << 52)

_OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whole_vectors(column: pa.Array, dimension: int | None, scale: int = SCALE, offset: int = OFFSET) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that take part, and their scaled vectors (int64)."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), np.int64)
    right = np.flatnonzero(lengths == dimension) if dimension else np.zeros(0, np.int64)
    if not len(right):
        return right, np.zeros((0, dimension or 0), np.int64)
    values = column.take(pa.array(right)).flatten()
    flat = values.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dimension)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(scale * flat) + offset
        fine = (np.abs(scaled) <= _LIMIT).all(axis=1) & np.isfinite(flat).all(axis=1)
    return right[fine], scaled[fine].astype(np.int64)


def _vectors(batches: Iterator[pa.RecordBatch], at: int, dimension: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROUND_ROWS):
            part = batch.slice(lo, ROUND_ROWS)
            rows, x = whole_vectors(part.column(at), dimension)
            if len(rows):
                yield part, rows, x


def _sums(vectors: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Rows that take part and their exact sums, by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dimension
        for _, _, x in _vectors(batches, 0, dimension):
            n += len(x)
            high, low = (x >> 26).sum(axis=0).tolist(), (x & ((1 << 26) - 1)).sum(axis=0).tolist()
            total = [t + (a << 26) + b for t, a, b in zip(total, high, low)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, dimension), pa.int32()), pa.array(map(Decimal, [n, *total]), pa.decimal128(38, 0))], ["dim", "total"])

    found = vectors.mapInArrow(run, "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total"))
    by_dim = {r["dim"]: int(r["total"]) for r in found.collect()}  # one row a dimension
    return by_dim.get(-1, 0), [by_dim.get(i, 0) for i in range(dimension)]


class Centre(NamedTuple):
    """The mean, as whole part and remainder of the exact division."""

    n: int
    sums: list[int]

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Rows less the mean; the large common part goes in whole numbers."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row the exact sum over dimensions of ``(n * x - S) ** 2`` (None beyond a long)."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        d = x - whole  # n * x - S = n * d - rest
        if float(np.abs(d).max(initial=0) + 1) ** 2 * float(self.n) ** 2 * len(self.sums) < 2.0**62:
            y = self.n * d - rest
            return (y * y).sum(axis=1).tolist()
        y = d.astype(object) * self.n - rest.astype(object)
        return [int(v) if v < 1 << 63 else None for v in (y * y).sum(axis=1)]


def _added(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(size)
    for batch in batches:
        for raw in batch.column(1):
            total += np.frombuffer(raw.as_buffer(), np.float64)
    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["part", "matrix"])


def _gram(vectors: DataFrame, dimension: int, project: Callable[[np.ndarray], np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of ``Q^T Q`` and of the rows of Q, where ``Q = project(x)``."""
    size = width * (width + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for _, _, x in _vectors(batches, 0, dimension):
            q = project(x)
            total[:width] += q.T @ q
            total[width] += q.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() // MATRICES_A_TASK], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["part", "matrix"])

    schema = "part bigint, matrix binary"
    first = vectors.mapInArrow(run, schema)
    spread = first.repartition("part").mapInArrow(lambda b: _added(b, size), schema)
    (row,) = spread.repartition(1).mapInArrow(lambda b: _added(b, size), schema).collect()  # one matrix
    total = np.frombuffer(row["matrix"], np.float64)
    return total.reshape(width + 1, width)[:width], total.reshape(width + 1, width)[width]


def solve_rows(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``Y R^-1`` for an upper triangle R, by substitution over its columns in blocks."""
    q = np.empty_like(y)
    step = 32
    for a in range(0, len(r), step):
        b = min(a + step, len(r))
        known = y[:, a:b] - q[:, :a] @ r[:a, a:b]
        q[:, a:b] = np.linalg.solve(r[a:b, a:b].T, known.T).T
    return q


class Whitening(NamedTuple):
    """Fitted components: ``components[:, k]`` and ``eigenvalues[k]``, falling."""

    dimension: int
    centre: Centre
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centre.apply(x) @ (self.components / np.sqrt(self.eigenvalues))


def dimension_of(vectors: DataFrame) -> int | None:
    """The most frequent length of non-empty vectors (the longest of equally frequent ones)."""
    (column,) = vectors.columns
    counted = vectors.select(F.size(column).alias("length")).where("length > 0").groupBy("length").count()
    found = counted.orderBy(F.desc("count"), F.desc("length")).first()
    return found["length"] if found else None


def triangle(vectors: DataFrame, dimension: int, centre: Centre) -> np.ndarray:
    """R of ``Y = Q R`` for the centred rows, by repeated CholeskyQR."""
    r = np.eye(dimension)
    unit = np.finfo(float).eps
    for k in range(PASSES):

        def project(x: np.ndarray, r: np.ndarray = r, first: bool = not k) -> np.ndarray:
            y = centre.apply(x)
            return y if first else solve_rows(y, r)

        gram, _ = _gram(vectors, dimension, project, dimension)
        # The shift that keeps the factor real: 11 (m n + n (n + 1)) u |Y|^2 at first, rounding after.
        norm = np.linalg.norm(gram, 2)
        shift = (11 * (centre.n * dimension + dimension * (dimension + 1)) if not k else dimension) * unit * (norm or 1.0)
        shift = min(shift, norm * 1e-3 or 1.0)
        try:
            factor = np.linalg.cholesky(gram if k else gram + shift * np.eye(dimension)).T
        except np.linalg.LinAlgError:  # rank-deficient rows
            factor = np.linalg.cholesky(gram + shift * np.eye(dimension)).T
        r = np.triu(factor @ r)
        if k and np.abs(gram - np.eye(dimension)).max() < ORTHONORMAL * max(8, dimension):
            break
    return r


def fit(embeddings: DataFrame, column: str = "embedding", most: int = 32) -> Whitening | None:
    """Components of all rows that take part; None without any."""
    vectors = embeddings.select(column)
    dimension = dimension_of(vectors)
    if not dimension:
        return None
    n, sums = _sums(vectors, dimension)
    if not n:
        return None
    centre = Centre(n, sums)
    _, sigma, turned = np.linalg.svd(triangle(vectors, dimension, centre))
    eigenvalues = sigma**2 / n
    keep = [k for k in range(min(most, dimension)) if eigenvalues[k] > NO_VARIANCE * max(eigenvalues[0], 1.0)]
    return Whitening(dimension, centre, np.ascontiguousarray(turned[keep].T), eigenvalues[keep], float(eigenvalues.sum()))


def identity_error(embeddings: DataFrame, model: Whitening, column: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    k, n = len(model.eigenvalues), model.centre.n
    if not k:
        return 0.0
    gram, total = _gram(embeddings.select(column), model.dimension, model.apply, k)
    return float(np.abs(gram / n - np.outer(total / n, total / n) - np.eye(k)).max())


def whitened(embeddings: DataFrame, model: Whitening, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key`` and the whitened vector (an array, by component) of every row that takes part."""
    schema = "vec_id bigint, deviation bigint, whitened array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, x in _vectors(batches, 1, model.dimension):
            values = model.apply(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)).cast(pa.int64()), pa.array(model.centre.deviations(x), pa.int64()), lists], ["vec_id", "deviation", "whitened"])

    return embeddings.select(F.col(key).cast("long").alias("vec_id"), column).mapInArrow(run, schema)


def components(embeddings: DataFrame) -> DataFrame:
    """A row for each row that takes part and each component."""
    model = fit(embeddings)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], _OUT)
    error = identity_error(embeddings, model)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues]) if len(model.eigenvalues) else F.array().cast("array<double>")
    rows = whitened(embeddings, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.centre.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "embeddings"))

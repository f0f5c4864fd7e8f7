"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.ship import ship

#: The driver factors a square of this many dimensions at most.
MOST_DIMENSIONS = 4096
#: Whole entries beyond this are no exact doubles any more.
LARGEST = float(1 << 53)
SWEEPS = 60
EPS = np.finfo(np.float64).eps


@dataclass
class Whitening:
    """What a fit found: rows and exact sums, eigenvalues by falling size and their unit vectors (as columns), the trace
    of the covariance and how far the whitened covariance is from the identity."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def scaled(self) -> np.ndarray:
        return self.components / np.sqrt(self.eigenvalues)


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """L with ``matrix`` = L L^T, one column for each step: the largest entry left on the diagonal is the next pivot. Ends
    at the matrix's numerical rank. Rows in their own order; taken in pivot order they are lower triangular."""
    left, size = matrix.astype(np.float64), len(matrix)
    diagonal, columns = np.diag(left).copy(), []
    first = diagonal.max(initial=0.0)
    for _ in range(size):
        at = int(diagonal.argmax())
        if diagonal[at] <= size * EPS * first:
            break
        column = left[:, at] / np.sqrt(diagonal[at])
        for done in columns:
            column[done[0]] = 0.0
        column[at] = np.sqrt(diagonal[at])
        columns.append((at, column))
        left = left - np.outer(column, column)
        diagonal = np.diag(left).copy()
        diagonal[[a for a, _ in columns]] = 0.0
    return np.array([c for _, c in columns]).T if columns else np.zeros((size, 0))


def jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by falling size and unit eigenvectors (columns) of L L^T, from L alone: plane rotations make its
    columns orthogonal; their squared norms are the eigenvalues and their directions the vectors. Each round
    rotates pairs that share no column. The largest entry of a vector is positive."""
    columns = factor.astype(np.float64).copy()
    size = columns.shape[1]
    seats = list(range(size + size % 2))  # an odd column sits out in turn
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(seats) - 1):
            pairs = [(a, b) for a, b in zip(seats[: len(seats) // 2], seats[::-1]) if max(a, b) < size]
            if pairs:
                p, q = np.array(pairs).T
                x, y = columns[:, p], columns[:, q]
                a, b, both = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
                cosine = np.abs(both) / np.sqrt(np.maximum(a * b, np.finfo(np.float64).tiny))
                worst = max(worst, float(cosine.max()))
                turn = cosine > EPS
                safe = np.where(turn, both, 1.0)
                zeta = (b - a) / (2 * safe)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = np.where(turn, 1 / np.hypot(1.0, t), 1.0)
                s = np.where(turn, c * t, 0.0)
                columns[:, p], columns[:, q] = c * x - s * y, s * x + c * y
            seats = [seats[0], seats[-1], *seats[1:-1]]
        if worst <= EPS * max(len(factor), 8):
            break
    else:
        raise RuntimeError(f"no convergence in {SWEEPS} sweeps")
    norms = np.sqrt((columns * columns).sum(0))
    order = np.argsort(-norms, kind="stable")
    vectors = columns[:, order] / norms[order]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(size)]) if size else np.ones(0)
    return norms[order] ** 2, vectors * signs


def _sound(batch: pa.RecordBatch, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that take part and floor(scale * entry) of them, a row each."""
    lists = batch.column(1)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
    edges = np.concatenate([[0], np.cumsum(sizes)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    kept = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False) & (bad[edges[1:]] == bad[edges[:-1]]))
    if not len(kept):
        return kept, np.zeros((0, 0))
    width = sizes[kept[0]]
    if (sizes[kept] != width).any():
        raise ValueError("vectors differ in length")
    whole = np.floor(values[edges[kept][:, None] + np.arange(width)] * scale)
    if np.abs(whole).max(initial=0) >= LARGEST:
        raise ValueError("an entry is too large to be a whole number in a double")
    return kept, whole


def _summed(scale: float, offset: int):
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, None, None
        for batch in batches:
            kept, whole = _sound(batch, scale)
            if not len(kept):
                continue
            x = whole.astype(np.int64) + offset
            if low is None:
                low, high = np.zeros(x.shape[1], np.int64), np.zeros(x.shape[1], np.int64)
            if len(low) != x.shape[1]:
                raise ValueError("vectors differ in length")
            n += len(kept)
            low += (x & 0xFFFFFFFF).sum(0)  # in two halves, neither of which overflows
            high += (x >> 32).sum(0)
        if n:
            size = len(low)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, size), pa.int32()), pa.array(np.append(n, low)), pa.array(np.append(0, high)), pa.array(np.full(size + 1, size), pa.int32())],
                names=["i", "low", "high", "size"],
            )

    return summed


@dataclass
class _Centre:
    """Means as whole numbers and what is left of the sums beside them."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, n: int, sums: list[int], offset: int) -> "_Centre":
        return cls(n, np.array([s // n - offset for s in sums], np.int64), np.array([s % n for s in sums], np.int64))

    def centred(self, whole: np.ndarray) -> np.ndarray:
        """x - S / n, from the exact difference to a whole number near the mean."""
        return (whole - self.whole) - self.rest / self.n

    def deviation(self, whole: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S)^2, exact; None where no long holds it."""
        z = whole.astype(np.int64) - self.whole
        most = int(np.abs(z).max(initial=0)) + 1
        if z.shape[1] * (self.n * most) ** 2 < 1 << 63:
            return ((self.n * z - self.rest) ** 2).sum(1).tolist()
        if z.shape[1] * most * max(most, self.n) < 1 << 63:
            squares, products = (z * z).sum(1).astype(object), (z * self.rest).sum(1).astype(object)
        else:
            squares, products = (z.astype(object) ** 2).sum(1), (z.astype(object) * self.rest.astype(object)).sum(1)
        rests = sum(r * r for r in self.rest.tolist())
        exact = squares * self.n**2 - products * (2 * self.n) + rests
        return [v if v < 1 << 63 else None for v in exact.tolist()]


def _scatter(scale: float, centre: _Centre, onto: np.ndarray | None):
    """Per task the upper triangle of the scatter of the centred vectors, or of their projections; row -1 has the sums."""

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, sums = None, None
        for batch in batches:
            kept, whole = _sound(batch, scale)
            if len(kept):
                points = centre.centred(whole)
                points = points if onto is None else points @ onto
                square = points.T @ points + (0 if square is None else square)
                sums = points.sum(0) + (0 if sums is None else sums)
        if square is not None:
            i, j = np.triu_indices(len(square))
            m = len(square)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.full(m, -1), i]).astype(np.int32)),
                    pa.array(np.concatenate([np.arange(m), j]).astype(np.int32)), pa.array(np.concatenate([sums, square[i, j]])),
                ],
                names=["i", "j", "value"],
            )

    return scatter


def _covariance(raw: DataFrame, scale: float, centre: _Centre, onto: np.ndarray | None, size: int) -> np.ndarray:
    """Covariance over all rows, divisor n; the driver gets one sum for each pair of dimensions."""
    parts = raw.mapInArrow(_scatter(scale, centre, onto), "i int, j int, value double")
    square, means = np.zeros((size, size)), np.zeros(size)
    for i, j, value in parts.groupBy("i", "j").agg(F.sum("value")).collect():
        if i < 0:
            means[j] = value / centre.n
        else:
            square[i, j] = square[j, i] = value / centre.n
    return square - np.outer(means, means)


def _raw(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    return vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))


def fit(
    vectors: DataFrame, components: int = 32, scale: float = 64, offset: int = 0, id: str = "vec_id", vector: str = "embedding"
) -> Whitening:
    """Fit over all vectors: see :func:`whiten`."""
    ship(vectors.sparkSession)
    raw = _raw(vectors, id, vector)
    parts = raw.mapInArrow(_summed(scale, offset), "i int, low long, high long, size int")
    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    rows = parts.groupBy("i").agg(wide("low"), wide("high"), F.min("size"), F.max("size")).collect()
    if len({size for row in rows for size in row[3:]}) > 1:
        raise ValueError("vectors differ in length")
    known = {i: int(low) + (int(high) << 32) for i, low, high, *_ in rows}
    n, size = known.pop(-1, 0), len(known)
    sums = [known[i] for i in range(size)]
    if size > MOST_DIMENSIONS:
        raise ValueError(f"{size} dimensions, more than the {MOST_DIMENSIONS} that the driver factors")
    if not n or not size:
        return Whitening(n, sums, np.zeros(0), np.zeros((size, 0)), 0.0)
    centre = _Centre.of(n, sums, offset)
    covariance = _covariance(raw, scale, centre, None, size)
    values, vectors_ = jacobi(pivoted_cholesky(covariance))
    found = Whitening(n, sums, values[:components], vectors_[:, :components], float(np.trace(covariance)))
    if len(found.eigenvalues):
        k = len(found.eigenvalues)
        found.identity_error = float(np.abs(_covariance(raw, scale, centre, found.scaled, k) - np.eye(k)).max())
    return found


def _projected(scale: float, centre: _Centre, onto: np.ndarray):
    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, whole = _sound(batch, scale)
            if len(kept):
                points = centre.centred(whole) @ onto
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, points.size + 1, onto.shape[1]), pa.int32()), pa.array(points.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(kept)), pa.array(centre.deviation(whole), pa.int64()), lists], names=["vec_id", "deviation", "whitened"]
                )

    return projected


def whiten(
    vectors: DataFrame, components: int = 32, scale: float = 64, offset: int = 0, id: str = "vec_id", vector: str = "embedding",
    model: Whitening | None = None,
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every vector and each of the first
    ``components`` components.

    Entries become whole numbers x = floor(``scale`` * entry) + ``offset``. Three passes fit: exact sums; the covariance of
    the entries centred on them, gathered as a square for each task and added up in Spark; and, with the components known,
    the covariance of what is whitened. The driver factors the covariance, whose size is that of the dimensions: Cholesky
    with pivots gives a triangular factor of its rank, whose columns one-sided Jacobi makes orthogonal. The fourth
    pass projects, without a shuffle. Pass a fitted ``model`` (see :func:`fit`) to whiten other vectors by it.

    Vectors that are null or hold a null or non-finite entry are left out; a null id stays. Repeated rows count and are
    returned each. Dimensions that others determine lower the rank: there are no more components than that, and none,
    hence no rows, for equal vectors, a single one, empty vectors or an empty table. Equal eigenvalues have
    components in any order. Vectors of different lengths, and entries beyond 2^53, fail the job.
    ``deviation`` is the exact sum of (n * x - S)^2, null where no long can hold it.
    """
    ship(vectors.sparkSession)
    model = fit(vectors, components, scale, offset, id, vector) if model is None else model
    k = len(model.eigenvalues)
    if not k:
        kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], kinds)
    centre = _Centre.of(model.n, model.sums, offset)
    rows = _raw(vectors, id, vector).mapInArrow(
        _projected(scale, centre, model.scaled), "vec_id long, deviation long, whitened array<double>"
    )
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )

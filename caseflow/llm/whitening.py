"""Embedding whitening: leading eigenvectors by spectrum slicing, projections to unit variance.

Vectors become whole numbers; their number, sums and centred second moments are added up by Spark, so that only
a matrix of the dimension's size reaches the driver. There the inertia of L D L^T factors of the shifted
covariance (the signs of D) counts the eigenvalues above a shift. Halving an interval by such counts isolates each
leading eigenvalue, or a cluster that no shift can part; Rayleigh quotient iteration from there converges cubically
to a pair, which is taken only if its value lies in the interval. Counts on both sides of it then certify its
number. Vectors of a cluster are made orthogonal to those found before.

Results: rows whose vector is null, empty, or holds null, non-finite or huge entries (beyond 2**40, whose squares
no sum of longs could hold) are dropped; so are vectors of another length than most (of the greatest such
length). Components of no variance are not returned, so equal vectors give no rows. Equal rows get equal results,
one for each; ids may be null or repeated. Extra columns do not matter. An empty table gives no rows. A deviation
that a long cannot hold is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
# An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
HUGE = float(1 << 40)
#: Share of the trace below which a component has no variance.
NOTHING = 1e-13


# ---- spectrum slicing, on the driver, over one matrix of the dimension's size -----------------

def inertia_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues above a shift: the positive ones in D of L D L^T of the shifted matrix.

    Symmetric pivoting with blocks of one or two rows (Bunch and Kaufman) keeps the factors bounded.
    """
    a = matrix - shift * np.eye(len(matrix))
    positive, turn = 0, (1 + 17**0.5) / 8
    tiny = np.finfo(float).eps * max(float(np.abs(matrix).max()), 1e-300)
    while len(a):
        below = np.abs(a[1:, 0])
        size, swap = 1, 0
        if len(a) > 1 and abs(a[0, 0]) < turn * below.max():
            r = int(below.argmax()) + 1
            column = np.abs(a[:, r]).copy()
            column[r] = 0
            if abs(a[0, 0]) * column.max() < turn * below.max() ** 2:
                size, swap = (1, r) if abs(a[r, r]) >= turn * column.max() else (2, r)
        to = size - 1
        if swap != to:
            a[[to, swap]] = a[[swap, to]]
            a[:, [to, swap]] = a[:, [swap, to]]
        block, side = a[:size, :size], a[size:, :size]
        if size == 1:
            d = block[0, 0] if abs(block[0, 0]) > tiny else -tiny
            positive += d > 0
            a = a[1:, 1:] - np.outer(side, side) / d
        else:
            positive += 1  # a block of two is indefinite: one of its eigenvalues is above
            a = a[2:, 2:] - side @ np.linalg.solve(block, side.T)
    return positive


def _rayleigh(matrix: np.ndarray, start: np.ndarray, shift: float, others: np.ndarray, scale: float) -> tuple[float, np.ndarray]:
    """A pair near the shift: one step of inverse iteration, then Rayleigh quotients, orthogonal to the others."""
    def apart(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - others.T @ (others @ v)
        return v / np.linalg.norm(v)

    v, value, eye = apart(start), shift, np.eye(len(matrix))
    for step in range(12):
        try:
            v = apart(np.linalg.solve(matrix - value * eye, v))
        except np.linalg.LinAlgError:
            v = apart(np.linalg.solve(matrix - (value + 4 * np.finfo(float).eps * scale) * eye, v))
        if step:  # a first step towards the shift itself
            value = float(v @ matrix @ v)
        if np.linalg.norm(matrix @ v - value * v) <= 4 * len(matrix) * np.finfo(float).eps * scale:
            break
    return float(v @ matrix @ v), v


@dataclass(frozen=True)
class Eigen:
    """Values falling, vectors as rows, and for each the eigenvalues counted above and not below it."""

    values: np.ndarray
    vectors: np.ndarray
    counts: list[tuple[int, int]]


def leading(matrix: np.ndarray, wanted: int = COMPONENTS) -> Eigen:
    """The leading eigenpairs of a symmetric matrix with a positive share of its trace, certified by counts."""
    d, trace = len(matrix), float(np.trace(matrix))
    values, vectors, counts = [], np.zeros((0, d)), []
    if d == 0 or trace <= 0:
        return Eigen(np.array(values), vectors, counts)
    scale = float(np.abs(matrix).sum(1).max())  # no eigenvalue is beyond
    least, close = NOTHING * trace, 64 * d * np.finfo(float).eps * scale
    cuts = {0.0 + least: inertia_above(matrix, least), scale * (1 + 1e-12): 0}

    def count(shift: float) -> int:
        if shift not in cuts:
            cuts[shift] = inertia_above(matrix, shift)
        return cuts[shift]

    start = np.random.default_rng(0)
    for number in range(1, min(wanted, cuts[least]) + 1):
        low = max(s for s, n in cuts.items() if n >= number)
        high = min(s for s, n in cuts.items() if n < number and s > low)
        done = False
        while not done:
            # Halve until the interval holds this eigenvalue alone, or a cluster that no shift parts.
            while count(low) - count(high) > 1 and high - low > close:
                middle = (low + high) / 2
                low, high = (middle, high) if count(middle) >= number else (low, middle)
            value, vector = _rayleigh(matrix, start.standard_normal(d), (low + high) / 2, vectors, scale)
            rest = float(np.linalg.norm(matrix @ vector - value * vector))
            margin = max(rest, close)
            inside = low - margin <= value <= high + margin
            if inside and rest <= close:
                above, until = count(value + margin), count(value - margin)
                done = above < number <= until
            if not done:
                if high - low <= close:
                    raise ArithmeticError(f"no eigenvector found for eigenvalue {number}")
                middle = (low + high) / 2
                low, high = (middle, high) if count(middle) >= number else (low, middle)
        values.append(value)
        vectors = np.vstack((vectors, vector))
        counts.append((above, until))
    order = np.argsort(-np.array(values), kind="stable")  # values of a cluster may differ in their last digits
    return Eigen(np.array(values)[order], vectors[order], counts)


# ---- sums over the vectors, by Spark -----------------------------------------------------------

def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def whole_vectors(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, x) of the rows that are kept, and the vectors' length."""
    vector = F.col(vector_col).cast("array<double>")
    given = df.select(F.col(id_col).alias("id"), vector.alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > HUGE))
    good = given.where(F.col("v").isNotNull() & (F.size("v") > 0) & ~F.coalesce(bad, F.lit(True)))
    lengths = good.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if lengths is None:
        return given.where(F.lit(False)).select("id", F.lit(None).cast("array<bigint>").alias("x")), 0
    # A filter before the mapping keeps the mapping off the rows that are dropped.
    x = F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    return good.where(F.size("v") == lengths["length"]).select("id", x.alias("x")), lengths["length"]


def _added(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], dimension: int, kind: str) -> dict[int, float | int]:
    """Sum over all rows of an array made of each batch, by the array's places."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                own = part(_matrix(b.column("x"), dimension)).ravel()
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"])

    sums = rows.select("x").mapInArrow(partial, f"place long, value {kind}").groupBy("place").agg(F.sum("value").alias("value"))
    return {r["place"]: r["value"] for r in sums.collect()}  # as many as the array has places


def _array(sums: dict, shape: tuple[int, ...]) -> np.ndarray:
    return np.array([sums.get(i, 0) for i in range(int(np.prod(shape)))]).reshape(shape)


def centred_moments(mean: np.ndarray, project: Callable[[np.ndarray], np.ndarray] = lambda x: x) -> Callable[[np.ndarray], np.ndarray]:
    """Of a batch: the sum of the outer products of what is projected, less the mean."""
    def part(x: np.ndarray) -> np.ndarray:
        c = project(x) - mean
        return c.T @ c

    return part


@dataclass(frozen=True)
class Whitening:
    """What is needed to whiten a vector: the vectors' number and sums, and the components."""

    n: int
    sums: list[int]
    trace: float
    eigen: Eigen

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self) -> Callable[[np.ndarray], np.ndarray]:
        mean, axes = self.mean, self.eigen.vectors.T / np.sqrt(self.eigen.values)
        return lambda x: (x - mean) @ axes


def fit(rows: DataFrame, dimension: int, components: int = COMPONENTS) -> Whitening | None:
    """Moments of all rows (id, x) and their leading components; None without rows."""
    n = rows.count() if dimension else 0
    if n == 0:
        return None
    sums = _added(rows, lambda x: x.sum(0), dimension, "long")
    sums = [int(sums[i]) for i in range(dimension)]
    mean = np.array([s / n for s in sums])
    moments = _array(_added(rows, centred_moments(mean), dimension, "double"), (dimension, dimension)) / n
    covariance = (moments + moments.T) / 2
    return Whitening(n, sums, float(np.trace(covariance)), leading(covariance, components))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance, as measured over all of them, less the identity."""
    k, project = len(model.eigen.values), model.project()
    mean = _array(_added(rows, lambda x: project(x).sum(0), len(model.sums), "double"), (k,)) / model.n
    moments = _array(_added(rows, centred_moments(mean, project), len(model.sums), "double"), (k, k)) / model.n
    return float(np.abs(moments - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over dimensions of (n x - S)^2; null beyond a long."""
    centre = np.array(sums, np.int64 if max(map(abs, sums)) < 1 << 62 else object)
    most = max(abs(n * int(x.max())) + max(map(abs, sums)), abs(n * int(x.min())) + max(map(abs, sums))) if x.size else 0
    if most < 1 << 62:
        off = n * x - centre
        if float(np.abs(off).max(initial=0)) ** 2 * x.shape[1] < 2.0**62:
            return (off * off).sum(1).tolist()
    exact = ((n * x.astype(object) - centre) ** 2).sum(1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per kept row and component: id, component, n, deviation, whitened, explained, identity_error."""
    kept = df.schema[id_col].dataType.simpleString()
    rows, dimension = whole_vectors(df, id_col, vector_col)
    model = fit(rows, dimension, components)
    schema = f"id {kept}, component int, deviation long, whitened double, explained double"
    names: list[Column | str] = [F.col("id").alias(id_col), "component"]
    if model is None or not len(model.eigen.values):
        found = rows.select("id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("deviation"), F.lit(0.0).alias("whitened"), F.lit(0.0).alias("explained")).where(F.lit(False))
        error, n = 0.0, 0
    else:
        error, n, project = identity_error(rows, model), model.n, model.project()
        sums, explained = model.sums, model.eigen.values / model.trace
        k = len(explained)

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    x = _matrix(b.column("x"), dimension)
                    at = np.repeat(np.arange(len(x)), k)
                    columns = [b.column("id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)))]
                    columns.append(pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(at)))
                    columns += [pa.array(project(x).ravel()), pa.array(np.tile(explained, len(x)))]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "component", "deviation", "whitened", "explained"])

        found = rows.mapInArrow(each, schema)
    return found.select(*names, F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error"))

"""Whitening of embeddings on their leading principal components.

Vectors become whole numbers, so sums and products over all of them are exact and do not
depend on how rows are spread: tasks add up differences from the rounded means, Spark adds up
the tasks. The covariance has a row per pair of dimensions; its leading eigenvectors are found
on the driver by Householder reflections to a tridiagonal matrix, bisection on Sturm counts and
inverse iteration, and every vector is projected on them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from pulsemart.session import cut_lineage

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
# Rows of a matrix product within a task.
BLOCK = 4096
EPS = np.finfo(np.float64).eps
# Eigenvalues this close, relative to the largest, are one cluster.
CLUSTER = 1e-3
TOTAL = "decimal(38,0)"


def whole_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, x): entries as whole numbers floor(64 c) + 1,000,000, of all usable vectors.

    Left out are null and empty vectors, those with a null or non-finite entry (or one too large
    for a long), and those that have not the most common number of entries (of equally common
    ones the largest).
    """
    entries = F.col(vector_column).cast("array<double>")
    bound = float((1 << 62) // SCALE)
    usable = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < bound))
    x = F.transform(entries, lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    rows = cut_lineage(
        vectors.where(entries.isNotNull() & (F.size(entries) > 0) & usable).select(F.col(id_column).alias("vec_id"), x.alias("x")),
        "vectors",
    )
    common = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return rows.where(F.size("x") == (common.width if common else 0))


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    lists = batch.column(column)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 0), values.dtype)


def _totals(rows: DataFrame, column: str, add: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sums over all rows of what ``add`` gives for a matrix of them, flat: tasks sum up, Spark adds."""

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            matrix = _matrix(batch, column)
            for first in range(0, len(matrix), BLOCK):
                part = add(matrix[first : first + BLOCK]).ravel()
                total = part if total is None else total + part
        if total is not None:
            values = pa.array([int(v) for v in total], pa.decimal128(38, 0)) if kind == TOTAL else pa.array(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), values], ["place", "value"])

    found = rows.select(column).mapInArrow(sums, f"place long, value {kind}").groupBy("place").agg(F.sum("value").alias("value"))
    # As many rows as the matrix has entries.
    table = found.toArrow()
    out = np.empty(table.num_rows, dtype=object if kind == TOTAL else np.float64)
    values = [int(v) for v in table.column("value").to_pylist()] if kind == TOTAL else table.column("value").to_numpy()
    out[table.column("place").to_numpy()] = values
    return out


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left' right of whole numbers as Python integers, by the fastest arithmetic that is exact."""
    if not len(left):
        return np.zeros((left.shape[1], right.shape[1]), dtype=object)
    largest = int(np.abs(left).max()) * int(np.abs(right).max()) * len(left)
    if largest < 1 << 53:
        return (left.T.astype(np.float64) @ right.astype(np.float64)).astype(np.int64).astype(object)
    if largest < 1 << 63:
        return (left.T @ right).astype(object)
    return left.T.astype(object) @ right.astype(object)


@dataclass
class Moments:
    """Number of vectors, exact sums by dimension, rounded means, and the covariance from exact products."""

    n: int
    sums: list[int]
    means: list[int]
    covariance: np.ndarray

    @property
    def rest(self) -> list[int]:
        """n x means is short of the sums by so much."""
        return [s - self.n * m for s, m in zip(self.sums, self.means)]


def moments(rows: DataFrame) -> Moments | None:
    """Two passes: sums, then products of the differences from the rounded means, corrected exactly."""

    def column_sums(x: np.ndarray) -> np.ndarray:
        return exact_products(np.ones((len(x), 1), dtype=np.int64), np.concatenate([x, np.ones((len(x), 1), dtype=np.int64)], axis=1))

    totals = _totals(rows, "x", column_sums, TOTAL)
    if not len(totals):
        return None
    *sums, n = totals.tolist()
    means = [(2 * s + n) // (2 * n) for s in sums]
    centre = np.array(means, dtype=np.int64)

    def products(x: np.ndarray) -> np.ndarray:
        y = x - centre
        return exact_products(y, y)

    d = len(sums)
    gram = _totals(rows, "x", products, TOTAL).reshape(d, d)
    found = Moments(n, sums, means, np.zeros((d, d)))
    rest = found.rest
    for i in range(d):
        for j in range(d):
            found.covariance[i, j] = (n * gram[i, j] - rest[i] * rest[j]) / (n * n)
    return found


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflections) of a symmetric matrix, by Householder reflections."""
    a = matrix.astype(np.float64).copy()
    n = len(a)
    off, mirrors = np.zeros(max(n - 1, 0)), []
    for k in range(n - 1):
        column = a[k + 1 :, k]
        size = np.linalg.norm(column)
        mirror = column.copy()
        mirror[0] += np.copysign(size, column[0])
        length = np.linalg.norm(mirror)
        if k == n - 2 or not length:
            off[k] = column[0]
            mirrors.append(np.zeros(n - k - 1))
            continue
        mirror /= length
        off[k] = -np.copysign(size, column[0])
        below = a[k + 1 :, k + 1 :]
        product = below @ mirror
        product -= (mirror @ product) * mirror
        below -= 2 * (np.outer(mirror, product) + np.outer(product, mirror))
        mirrors.append(mirror)
    return np.diag(a).copy(), off, mirrors


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each value, the number of eigenvalues below it: signs of the Sturm sequence."""
    least = np.finfo(np.float64).tiny
    count = np.zeros(len(at), dtype=np.int64)
    pivot = np.ones(len(at))
    for d, e in zip(diagonal, [0.0, *off]):
        with np.errstate(over="ignore"):
            pivot = d - at - e * e / pivot
        # A pivot of zero counts as below, and the next one follows from that.
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues of a tridiagonal matrix, falling, each bisected until no double lies between its bounds."""
    n = len(diagonal)
    reach = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    width = max(np.max(np.abs(diagonal) + reach), np.finfo(np.float64).tiny)
    low = np.full(k, np.min(diagonal - reach) - 4 * EPS * width)
    high = np.full(k, np.max(diagonal + reach) + 4 * EPS * width)
    rank = n - np.arange(k)
    while True:
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high) | (high - low <= 4 * EPS * EPS * width)):
            return middle
        above = count_below(diagonal, off, middle) >= rank
        high, low = np.where(above, middle, high), np.where(above, low, middle)


def _solver(diagonal: np.ndarray, off: np.ndarray, at: float, scale: float) -> Callable[[np.ndarray], np.ndarray]:
    """Solves (T - at) y = b by elimination with row exchanges; a vanishing pivot becomes a tiny one."""
    n = len(diagonal)
    d, u, v = (diagonal - at).tolist(), [*off.tolist(), 0.0], [0.0] * n
    tiny = EPS * scale
    steps = []
    for i in range(n - 1):
        below = off[i]
        if abs(d[i]) >= abs(below):
            factor = below / d[i] if d[i] else 0.0
            steps.append((False, factor))
            d[i + 1] -= factor * u[i]
            u[i + 1] -= factor * v[i]
        else:
            factor = d[i] / below
            steps.append((True, factor))
            d[i], u[i], v[i], d[i + 1], u[i + 1] = below, d[i + 1], u[i + 1], u[i] - factor * d[i + 1], v[i] - factor * u[i + 1]
    d = [x if abs(x) > tiny else (tiny if x >= 0 else -tiny) for x in d]

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.tolist()
        for i, (exchanged, factor) in enumerate(steps):
            if exchanged:
                y[i], y[i + 1] = y[i + 1], y[i]
            y[i + 1] -= factor * y[i]
        for i in range(n - 1, -1, -1):
            rest = y[i]
            if i + 1 < n:
                rest -= u[i] * y[i + 1]
            if i + 2 < n:
                rest -= v[i] * y[i + 2]
            y[i] = rest / d[i]
        return np.array(y)

    return solve


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors as columns for falling eigenvalues, by inverse iteration from random starts.

    Those of a cluster are kept orthogonal to the earlier ones of it in every round.
    """
    n, k = len(diagonal), len(values)
    scale = max(np.max(np.abs(diagonal)), np.max(np.abs(off), initial=0.0), np.finfo(np.float64).tiny)
    random = np.random.default_rng(0)
    out = np.zeros((n, k))
    first, used = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * scale:
            first = j
        # Equal eigenvalues are told apart by a little more than rounding.
        used = value if j == first else min(value, used - 10 * EPS * scale)
        solve = _solver(diagonal, off, used, scale)
        vector = random.uniform(-1, 1, n)
        for _ in range(5):
            for _ in range(2):
                vector -= out[:, first:j] @ (out[:, first:j].T @ vector)
            vector = solve(vector / np.linalg.norm(vector))
            vector /= np.max(np.abs(vector))
        for _ in range(2):
            vector -= out[:, first:j] @ (out[:, first:j].T @ vector)
            vector /= np.linalg.norm(vector)
        out[:, j] = vector
    return out


def principal_components(covariance: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns), falling; the largest entry of a vector is positive.

    At most ``most``, without those whose eigenvalue is rounding: no variance to divide by.
    """
    if not np.any(covariance):
        return np.zeros(0), np.zeros((len(covariance), 0))
    # A power of two, so nothing is rounded.
    unit = 2.0 ** np.floor(np.log2(np.max(np.abs(covariance))))
    diagonal, off, mirrors = tridiagonal(covariance / unit)
    values = leading_eigenvalues(diagonal, off, min(most, len(diagonal)))
    values = values[values > 4 * len(diagonal) * EPS * values[0]]
    vectors = eigenvectors(diagonal, off, values)
    for k in range(len(mirrors) - 1, -1, -1):
        vectors[k + 1 :] -= 2 * np.outer(mirrors[k], mirrors[k] @ vectors[k + 1 :])
    vectors /= np.linalg.norm(vectors, axis=0)
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    return values * unit, vectors * np.sign(largest)


def _squares(y: np.ndarray, n: int, rest: list[int]) -> list[int]:
    """Per row the sum of (n y - rest)^2, exact."""
    most = n * int(np.abs(y).max(initial=0)) + max(map(abs, rest), default=0)
    kind = np.int64 if most * most * max(y.shape[1], 1) < 1 << 63 else object
    moved = y.astype(kind) * n - np.array(rest, dtype=kind)
    return (moved * moved).sum(axis=1).tolist()


def project(rows: DataFrame, found: Moments, values: np.ndarray, vectors: np.ndarray) -> DataFrame:
    """(vec_id, deviation, whitened array): every vector less the mean, on the components, over their deviations."""
    means, rest, n = np.array(found.means, dtype=np.int64), found.rest, found.n
    shared = rows.sparkSession.sparkContext.broadcast((means, np.array([r / n for r in rest]), vectors / np.sqrt(values)))

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means, fraction, onto = shared.value
        for whole in batches:
            for first in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(first, BLOCK)
                y = _matrix(batch, "x") - means
                whitened = (y - fraction) @ onto
                width = pa.array(np.arange(len(y) + 1) * onto.shape[1], pa.int32())
                columns = [
                    batch.column("vec_id"),
                    pa.array(_squares(y, n, rest), pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(width, pa.array(whitened.ravel())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "deviation", "whitened"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(apply, f"vec_id {kind}, deviation {TOTAL}, whitened array<double>")


def identity_error(projected: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the whitened vectors' own covariance, less the identity: a pass for the mean, one for the products."""
    mean = _totals(projected, "whitened", lambda w: w.sum(axis=0), "double") / n
    products = _totals(projected, "whitened", lambda w: (w - mean).T @ (w - mean), "double").reshape(k, k)
    return float(np.max(np.abs(products / n - np.eye(k))))


def whiten(
    vectors: DataFrame, most: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """A row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Usable are the vectors of `whole_vectors`, all of which make up the statistics; ``n`` is
    their number, ``deviation`` the exact sum of (n x - S)^2 over the dimensions,
    ``explained`` the component's share of the variance. Components without variance are left
    out, so equal vectors, a single one and an empty table give no rows; null and repeated ids
    come back as often as they are there. Other columns are ignored.
    """
    if not isinstance(vectors.schema[vector_column].dataType.elementType, NumericType):
        raise TypeError(f"{vector_column} has no numbers")
    rows = whole_vectors(vectors, id_column, vector_column)
    found = moments(rows)
    values, components = principal_components(found.covariance, most) if found else (np.zeros(0), np.zeros((0, 0)))
    kind = vectors.schema[id_column].dataType.simpleString()
    if not len(values):
        schema = f"vec_id {kind}, component int, n bigint, deviation {TOTAL}, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)
    projected = cut_lineage(project(rows, found, values, components), "whitened")
    error = identity_error(projected, found.n, len(values))
    shares = F.array(*[F.lit(float(v)) for v in values / np.trace(found.covariance)])
    return projected.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(found.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )

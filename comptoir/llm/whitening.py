"""Embedding whitening (operator 11): pivoted Cholesky, then one-sided Jacobi on the triangular factor.

An entry c of a vector becomes the integer x = floor(64 * c) + 1000000.

1. One pass adds up n and the sum S of every dimension, by task, then in Spark.
2. A second pass centres before it multiplies: each x is taken from the integer nearest to its
   mean, and the products of these small integers are added up exactly (whole numbers in floating point below
   2^53, then 64-bit, then DECIMAL(38,0) across tasks). What is left of the mean, less than a half, is taken off
   in exact integers, so the scatter matrix is the centred one, correctly rounded, in whatever order tasks end.
3. The matrix has one row a dimension at any data size, so it is factored on the driver: Cholesky with diagonal pivots,
   V = P L L' P', stopped at the numerical rank; then columns of L are rotated in pairs until all are
   orthogonal. Their norms squared are the eigenvalues, the columns divided by their norms the components.
   Nothing is multiplied up to L'L, so small eigenvalues keep their digits.
4. A third pass measures the covariance of the whitened rows (:func:`identity_error`), a last one writes them.

No pass shuffles rows: tasks send sums whose number depends on the dimensions only.

Defined results: a row whose vector is null or holds a null or non-finite entry is dropped, and so is one with an entry
of 2^34 or more in size, whose squares could overflow DECIMAL(38). Vectors count as whole only if they have
the most frequent number of entries (of several, the largest; empty vectors never count); others lack entries and are
dropped. Repeated rows count and come out as often as they stand there; a null id stays null. A component whose eigenvalue is
zero to double precision has null whitened values, and ``identity_error`` leaves it out (0 if none is left). Without usable rows
the result is empty. Of each component the entry of largest size (the first of several) is positive. Columns are kept, but for those named as an output.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm.common import batch_of, extended, stage
from comptoir.llm.vectors import Vectors, lists_of

SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0 ** 40  # of a scaled entry
EXACT = 2 ** 53  # whole numbers below are exact in floating point


@dataclass
class Whitening:
    """n and, by dimension: ``near``, the integer nearest to the mean; ``rest``, the sum of x - near. Components are columns."""

    n: int
    near: np.ndarray
    rest: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.rest)

    @property
    def flat(self) -> np.ndarray:
        """Which components have an eigenvalue of zero to double precision."""
        e = self.eigenvalues
        return e <= self.dims * np.finfo(float).eps * e.max(initial=0.0)

    def whiten(self, y: np.ndarray) -> np.ndarray:
        """Rows less ``near`` to whitened rows; zero where the eigenvalue is."""
        offset = np.array([s / self.n for s in self.rest])
        scale = np.where(self.flat, 0.0, 1.0 / np.sqrt(np.where(self.flat, 1.0, self.eigenvalues)))
        return (y - offset) @ self.components * scale


def scaled(vectors: Vectors, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, floor(64 * c)) of the rows that count, for vectors of ``dims`` entries. Whole numbers, exact."""
    rows, m = vectors.of_size(dims)
    with np.errstate(over="ignore"):
        m = np.floor(SCALE * m)
    small = (np.abs(m) < LARGEST).all(axis=1)
    return rows[small], m[small]


def _decimals(numbers) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in numbers], pa.decimal128(38, 0))


def _sums(vectors: DataFrame, column: str) -> tuple[int, int, list[int]]:
    """(dims, n, sums of x): of the most frequent number of entries; (0, 0, []) without usable rows."""
    def run(batches):
        n: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            found = Vectors(b.column(0))
            for dims in map(int, np.unique(found.sizes[found.sizes > 0])):
                m = scaled(found, dims)[1]
                if len(m):
                    n[dims] = n.get(dims, 0) + len(m)
                    sums[dims] = sums.get(dims, 0) + m.astype(np.int64).sum(axis=0).astype(object)
        for dims, s in sums.items():  # the row of dimension -1 counts
            yield batch_of({"dims": ([dims] * (dims + 1), pa.int32()), "i": (list(range(-1, dims)), pa.int32()),
                            "s": (_decimals([n[dims], *s]), None)})

    by_task = stage(vectors.select(column).mapInArrow(run, "dims int, i int, s decimal(38,0)"), "vector_sums")
    total = by_task.groupBy("dims", "i").agg(F.sum("s").alias("s"))
    most = total.where("i = -1").orderBy(F.desc("s"), F.desc("dims")).first()
    if most is None:
        return 0, 0, []
    n = int(most["s"])
    sums = {r["i"]: int(r["s"]) for r in total.where(F.col("dims") == most["dims"]).where("i >= 0").collect()}
    return most["dims"], n, [sums[i] + n * SHIFT for i in range(most["dims"])]


def _products(y: np.ndarray) -> tuple[np.ndarray, int]:
    """(y'y, a bound of its entries): exact, as 64-bit integers if they fit, else as Python's."""
    most = int(np.abs(y).max(initial=0.0)) ** 2
    if most * len(y) < EXACT:
        return (y.T @ y).astype(np.int64), most * len(y)
    whole = y.astype(np.int64)
    if most * len(y) >= 2 ** 62:
        whole = whole.astype(object)
    return whole.T @ whole, most * len(y)


def _scatter(vectors: DataFrame, column: str, near: np.ndarray) -> list[list[int]]:
    """The products of x - near, added up over all rows."""
    dims, upper = near.size, np.triu_indices(near.size)
    near = near - SHIFT

    def run(batches):
        total, part, bound = 0, 0, 0
        for b in batches:
            _, m = scaled(Vectors(b.column(0)), dims)
            if len(m):
                one, size = _products(m - near)
                if bound + size >= 2 ** 62:
                    total, part, bound = total + np.asarray(part).astype(object), 0, 0
                part, bound = part + one, bound + size
        if not np.isscalar(part) or not np.isscalar(total):
            sums = np.broadcast_to(total + np.asarray(part).astype(object), (dims, dims))
            yield batch_of({"i": (pa.array(upper[0], pa.int32()), None), "j": (pa.array(upper[1], pa.int32()), None),
                            "g": (_decimals(sums[upper]), None)})

    by_task = vectors.select(column).mapInArrow(run, "i int, j int, g decimal(38,0)")
    out = [[0] * dims for _ in range(dims)]
    for r in by_task.groupBy("i", "j").agg(F.sum("g").alias("g")).collect():  # a row for each pair of dimensions
        out[r["i"]][r["j"]] = out[r["j"]][r["i"]] = int(r["g"])
    return out


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): v[order][:, order] = L L', L with as many columns as ``v`` has numerical rank."""
    left, d = v.astype(float).copy(), len(v)
    order, factor = np.arange(d), np.zeros((d, d))
    floor = d * np.finfo(float).eps * left.diagonal().max(initial=0.0)
    rank = 0
    while rank < d:
        best = rank + int(np.argmax(left.diagonal()[rank:]))
        if left[best, best] <= floor:
            break
        swap = [rank, best]
        order[swap], factor[swap] = order[swap[::-1]], factor[swap[::-1]]
        left[swap] = left[swap[::-1]]
        left[:, swap] = left[:, swap[::-1]]
        pivot = np.sqrt(left[rank, rank])
        factor[rank, rank] = pivot
        below = left[rank + 1:, rank] / pivot
        factor[rank + 1:, rank] = below
        left[rank + 1:, rank + 1:] -= np.outer(below, below)
        rank += 1
    return factor[:, :rank], order


def one_sided_jacobi(factor: np.ndarray, most_sweeps: int = 60) -> np.ndarray:
    """The columns of ``factor`` rotated in pairs until all are orthogonal.

    A sweep meets every pair once, in rounds of disjoint pairs (a round-robin), so a round's rotations are done at once.
    """
    a = factor.copy()
    n = a.shape[1]
    if n < 2:
        return a
    tolerance = np.sqrt(len(a)) * np.finfo(float).eps
    ring = np.arange(n + n % 2)
    half = ring.size // 2
    for _ in range(most_sweeps):
        turned = False
        for _ in range(ring.size - 1):
            p, q = ring[:half], ring[:half - 1:-1]
            real = (p < n) & (q < n)  # an odd number of columns: one rests
            p, q = p[real], q[real]
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            go = np.abs(xy) > tolerance * np.sqrt(xx * yy)
            if go.any():
                turned = True
                p, q, x, y = p[go], q[go], x[:, go], y[:, go]
                z = (yy[go] - xx[go]) / (2 * xy[go])
                t = np.where(z < 0, -1.0, 1.0) / (np.abs(z) + np.hypot(1.0, z))
                c = 1 / np.hypot(1.0, t)
                a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
            ring = np.concatenate(([ring[0]], np.roll(ring[1:], 1)))
        if not turned:
            break
    return a


def components_of(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(components as columns, eigenvalues) of a covariance matrix, by falling eigenvalue; beyond its rank zero."""
    factor, order = pivoted_cholesky(v)
    turned = one_sided_jacobi(factor)
    norms = np.sqrt((turned * turned).sum(axis=0))
    by_size = np.argsort(-norms, kind="stable")
    units = np.zeros((len(v), len(v)))
    units[order, :norms.size] = (turned / norms)[:, by_size]
    signs = np.sign(units[np.abs(units).argmax(axis=0), np.arange(len(v))])
    return units * np.where(signs == 0, 1.0, signs), np.r_[norms[by_size] ** 2, np.zeros(len(v) - norms.size)]


def fit(vectors: DataFrame, components: int = 32, column: str = "embedding") -> Whitening | None:
    """The whitening of all usable rows, with the first ``components`` components; None without usable rows."""
    dims, n, sums = _sums(vectors, column)
    if not n:
        return None
    near = np.array([round(s / n) for s in sums], np.int64)
    rest = [s - n * int(m) for s, m in zip(sums, near)]
    g = _scatter(vectors, column, near)
    v = np.array([[(n * g[i][j] - rest[i] * rest[j]) / (n * n) for j in range(dims)] for i in range(dims)])
    units, e = components_of(v)
    k = min(components, dims)
    trace = float(v.trace())
    return Whitening(n, near, rest, units[:, :k], e[:k], e[:k] / trace if trace else np.zeros(k))


def identity_error(vectors: DataFrame, model: Whitening, column: str = "embedding") -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity, measured over all rows.

    The tasks' sums are added up as DECIMAL(38,18), so the order in which tasks end doesn't matter.
    """
    k, upper = model.eigenvalues.size, np.triu_indices(model.eigenvalues.size)
    sent = vectors.sparkSession.sparkContext.broadcast(astuple(model))

    def run(batches):
        m = Whitening(*sent.value)
        total, square = np.zeros(k), np.zeros((k, k))
        for b in batches:
            w = m.whiten(scaled(Vectors(b.column(0)), m.dims)[1] - (m.near - SHIFT))
            total, square = total + w.sum(axis=0), square + w.T @ w
        i, j = np.r_[upper[0], np.full(k, -1)], np.r_[upper[1], np.arange(k)]  # i = -1: the sums
        yield batch_of({"i": (pa.array(i, pa.int32()), None), "j": (pa.array(j, pa.int32()), None),
                        "s": (pa.array(np.r_[square[upper], total]), None)})

    sums = (vectors.select(column).mapInArrow(run, "i int, j int, s double")
            .groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,18)")).alias("s")).collect())
    s = {(r["i"], r["j"]): float(r["s"]) / model.n for r in sums}
    live = np.flatnonzero(~model.flat)
    return max((abs(s[i, j] - s[-1, i] * s[-1, j] - (i == j)) for i in live for j in live if i <= j), default=0.0)


def transform(vectors: DataFrame, model: Whitening, column: str = "embedding") -> DataFrame:
    """The usable rows with ``n``, ``deviation`` (sum of (n * x - S)^2, DECIMAL(38,0); null beyond 38 digits) and
    ``whitened``, an array with a value for each component."""
    sent = vectors.sparkSession.sparkContext.broadcast(astuple(model))

    def deviations(m: Whitening, y: np.ndarray) -> pa.Array:
        most = m.n * int(np.abs(y).max(initial=0.0)) + max(map(abs, m.rest))
        whole = y.astype(np.int64)
        if m.dims * most ** 2 < 2 ** 63:
            return pa.array([*map(Decimal, ((m.n * whole - np.array(m.rest)) ** 2).sum(axis=1).tolist())],
                            pa.decimal128(38, 0))
        exact = ((m.n * whole.astype(object) - np.array(m.rest, object)) ** 2).sum(axis=1)
        return pa.array([Decimal(v) if v < 10 ** 38 else None for v in exact], pa.decimal128(38, 0))

    def work(batches):
        m = Whitening(*sent.value)
        for column, in batches:
            places, x = scaled(Vectors(column), m.dims)
            y = x - (m.near - SHIFT)
            yield pa.array(places), [pa.array([m.n] * len(y), pa.int64()), deviations(m, y), lists_of(m.whiten(y), m.flat)]

    return extended(vectors, [vectors[f"`{column}`"]], "n bigint, deviation decimal(38,0), whitened array<double>", work)

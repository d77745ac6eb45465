"""Whitening of embeddings by their leading principal components, found by contour integration.

The covariance of the distinct vectors is summed in Spark, d x d numbers in all, and only it is
solved. Inertia counts (the signs of the pivots of an LDL^T factorisation of the shifted matrix,
by Sylvester's law the number of eigenvalues below the shift) cut the spectrum into intervals of few
eigenvalues, from the top down. For each interval FEAST projects a random block on its eigenvectors:
the integral of the resolvent along a circle through the interval's ends, by Gauss-Legendre
quadrature, is a sum of independent complex shifted solves, one Spark task each. Rayleigh-Ritz on
the projected block gives eigenpairs, whose residuals are driven to double precision. An interval is
done when it holds as many of them as its inertia count; else its block grows, up to all of space.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import stored
from .vectors import usable

#: Solves of a contour, eigenvalues of an interval unless they cannot be parted, rounds of FEAST.
NODES, INTERVAL_VALUES, ROUNDS = 8, 8, 60
#: Residual, relative to the largest eigenvalue, at which a pair counts as found.
FOUND = 1e-9
_EPS = float(np.finfo(float).eps)
_PIVOT = (1 + 17**0.5) / 8


def below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are below ``shift``: the negative pivots of
    LDL^T with complete pivoting on 1 x 1 and 2 x 2 blocks."""
    a = matrix - shift * np.eye(len(matrix))
    negative = 0
    while len(a):
        diagonal, off = np.abs(np.diagonal(a)), np.abs(a - np.diag(np.diagonal(a)))
        p, largest = int(np.argmax(diagonal)), off.max()
        if diagonal[p] == largest == 0:
            break
        first = [p] if diagonal[p] >= _PIVOT * largest else list(map(int, np.unravel_index(np.argmax(off), off.shape)))
        rest = np.delete(np.arange(len(a)), first)
        pivot, side = a[np.ix_(first, first)], a[np.ix_(rest, first)]
        # a 2 x 2 pivot is indefinite: its diagonal is small against the rest
        negative += int(pivot[0, 0] < 0) if len(first) == 1 else 1
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(pivot, side.T)
        a = (a + a.T) / 2
    return negative


def leading_intervals(matrix: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """Disjoint intervals (low, high, eigenvalues) from the top of the spectrum down that hold at
    least ``k`` eigenvalues together; ends lie in gaps as far as halving finds any."""
    reach = np.abs(matrix).sum(axis=1)
    low, high = float(min(np.diagonal(matrix) - reach)), float(max(np.diagonal(matrix) + reach))
    margin = 0.01 * (high - low) or 1.0
    todo, out, have = [(low - margin, high + margin, 0, len(matrix))], [], 0
    least = 64 * _EPS * max(abs(low), abs(high))
    while todo and have < k:
        a, b, under_a, under_b = todo.pop()
        count = under_b - under_a
        if not count:
            continue
        if count <= INTERVAL_VALUES or b - a <= least:
            out.append((a, b, count))
            have += count
            continue
        # the first place, around the middle, that has no eigenvalue near by
        for part in (0.5, 0.447, 0.553, 0.382, 0.618, 0.309, 0.691):
            middle, near = a + part * (b - a), 1e-4 * (b - a)
            under = below(matrix, middle - near)
            if under == below(matrix, middle + near):
                break
        else:
            middle = a + 0.5 * (b - a)
            under = below(matrix, middle)
        todo += [(a, middle, under_a, under), (middle, b, under, under_b)]
    return out


def _nodes() -> list[tuple[complex, float]]:
    """Points of the upper half of the unit circle, and their weights."""
    at, weights = np.polynomial.legendre.leggauss(NODES)
    return [(complex(np.exp(-0.5j * np.pi * (t - 1))), float(w)) for t, w in zip(at, weights, strict=True)]


Solver = Callable[[list[tuple[int, complex, complex]], dict[int, np.ndarray]], dict[int, np.ndarray]]


def spark_solver(spark: SparkSession, matrix: np.ndarray) -> Solver:
    """Sums of weight x (shift I - matrix)^-1 block per interval, one task per shift."""
    held = spark.sparkContext.broadcast(matrix)

    def solve(solves: list[tuple[int, complex, complex]], blocks: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        asked = spark.sparkContext.broadcast((solves, blocks))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in batch.column(0).to_pylist():
                    interval, shift, weight = asked.value[0][at]
                    found = np.linalg.solve(shift * np.eye(len(held.value)) - held.value, asked.value[1][interval].astype(complex))
                    cell = np.ascontiguousarray((weight * found).real).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([cell], pa.binary())], names=["at", "block"])

        rows = spark.range(0, len(solves), 1, len(solves)).mapInArrow(run, "at long, block binary").collect()
        out = {interval: np.zeros_like(block) for interval, block in blocks.items()}
        for row in sorted(rows, key=lambda r: r["at"]):
            interval = solves[row["at"]][0]
            out[interval] += np.frombuffer(row["block"]).reshape(out[interval].shape)
        asked.unpersist()
        return out

    return solve


def eigenpairs(matrix: np.ndarray, intervals: list[tuple[float, float, int]], solver: Solver) -> tuple[np.ndarray, np.ndarray]:
    """All eigenvalues of the intervals, falling, and their unit vectors as rows, by FEAST."""
    d = len(matrix)
    norm = max(np.abs(matrix).sum(axis=1).max(), np.finfo(float).tiny)
    draw = np.random.default_rng(12)
    blocks = {i: draw.standard_normal((d, min(d, 2 * count + 4))) for i, (_, _, count) in enumerate(intervals)}
    done: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    residuals = dict.fromkeys(blocks, np.inf)
    for _ in range(ROUNDS):
        solves = []
        for i in blocks:
            center, radius = (intervals[i][0] + intervals[i][1]) / 2, (intervals[i][1] - intervals[i][0]) / 2
            solves += [(i, center + radius * z, w / 2 * radius * z) for z, w in _nodes()]
        for i, projected in solver(solves, dict(blocks)).items():
            low, high, count = intervals[i]
            basis = np.linalg.qr(projected)[0]
            values, small = np.linalg.eigh(basis.T @ matrix @ basis)
            vectors = basis @ small
            rest = np.linalg.norm(matrix @ vectors - vectors * values, axis=0) / norm
            inside = (values > low) & (values < high) & (rest <= FOUND)
            worst = rest[inside].max(initial=0.0)
            complete = int(inside.sum()) == count
            if complete and (worst <= 4 * _EPS or worst > residuals[i] / 2):
                done[i] = values[inside], vectors[:, inside].T
                del blocks[i]
                continue
            if not complete and basis.shape[1] < d and rest[(values > low) & (values < high)].max(initial=0.0) >= residuals[i] / 2:
                # no progress: a wider block
                vectors = np.concatenate([vectors, draw.standard_normal((d, min(d - vectors.shape[1], vectors.shape[1])))], axis=1)
            residuals[i] = worst if complete else rest[(values > low) & (values < high)].max(initial=np.inf)
            blocks[i] = vectors
        if not blocks:
            break
    if blocks:
        raise ArithmeticError(f"inertia counts eigenvalues that were not found: {[intervals[i] for i in blocks]}")
    values = np.concatenate([done[i][0] for i in sorted(done)])
    vectors = np.concatenate([done[i][1] for i in sorted(done)])
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[order]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), dims)


def _sums(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), dims)
                # halves apart: a batch of them cannot overflow
                columns = [pa.array(np.arange(dims, dtype=np.int32)), pa.array((x >> 32).sum(axis=0)), pa.array((x & 0xFFFFFFFF).sum(axis=0))]
                yield pa.RecordBatch.from_arrays(columns, names=["dim", "high", "low"])

    return run


def _products(dims: int, mean: np.ndarray):
    """Task: its sum of products of centred vectors, a row per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            if batch.num_rows:
                centred = _matrix(batch.column(0), dims) - mean
                total += centred.T @ centred
        columns = [pa.array(np.arange(dims, dtype=np.int32)), pa.array(np.full(dims, TaskContext.get().partitionId(), np.int32)), pa.array([x.tobytes() for x in total], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["dim", "part", "products"])

    return run


def _summed(table: pa.Table) -> pa.Table:
    rows = table.sort_by("part").column("products").to_pylist()
    total = np.zeros(len(rows[0]) // 8)
    for row in rows:
        total += np.frombuffer(row)
    return pa.table([table.column("dim").slice(0, 1), pa.array([total.tobytes()], pa.binary())], names=["dim", "products"])


@dataclass
class Whitening:
    """What was learned from ``n`` distinct vectors of whole numbers with per-dimension ``sums``."""

    scale: float
    n: int
    sums: list[int]
    trace: float
    #: Falling eigenvalues and unit eigenvectors (rows), as many as were asked for and are not zero.
    values: np.ndarray
    components: np.ndarray
    #: Largest absolute entry of the whitened vectors' covariance minus the identity.
    identity_error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.n for s in self.sums])
        return (x - mean) @ self.components.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """sum((n x - sums)^2) per row, exactly; raises where a long cannot hold it."""
        reach = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if reach * reach * len(self.sums) < 1 << 63:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1)
        exact = [sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x]
        if max(exact) >= 1 << 63:
            raise OverflowError("a deviation exceeds 64 bits")
        return np.array(exact, np.int64)

    def applied(self, rows: DataFrame) -> DataFrame:
        """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` per row of
        ``rows`` (vec_id, x) and component."""
        held = rows.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = held.value
            k, explained = len(model.values), model.values / model.trace
            for batch in batches:
                m = batch.num_rows
                if not m or not k:
                    continue
                x = _matrix(batch.column(1), len(model.sums))
                columns = [
                    batch.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)), pa.array(np.repeat(model.deviations(x), k)), pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

        return rows.select("vec_id", "x").mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whole_vectors(vectors: DataFrame, scale: float) -> tuple[DataFrame, int]:
    """Rows ``(vec_id, x)`` of whole numbers floor(scale c), all filled with zeros to the same
    length, and that length; raises where a long cannot hold an entry."""
    rows = vectors.where(usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    dims = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    entry = lambda c: F.floor(F.when(F.abs(c) < 2.0**63, c).otherwise(F.raise_error(F.lit("an entry exceeds 64 bits"))))
    at = F.sequence(F.lit(0), F.lit(max(dims, 1) - 1))
    x = F.transform(at, lambda i: entry(F.coalesce(F.get("embedding", i).cast("double"), F.lit(0.0)) * scale))
    return rows.select("vec_id", x.alias("x")), dims


def fitted(rows: DataFrame, dims: int, k: int, scale: float) -> Whitening:
    """Learned from the distinct ``x`` of ``rows`` (vec_id, x); only sums and d x d products leave
    the executors."""
    spark = rows.sparkSession
    fit = stored(rows.select("x").distinct(), "fit")
    n = fit.count()
    if not n or not dims:
        return Whitening(scale, n, [0] * dims, 0.0, np.zeros(0), np.zeros((0, dims)))
    whole = "decimal(38,0)"
    sums = fit.mapInArrow(_sums(dims), "dim int, high long, low long").groupBy("dim").agg(F.sum(F.col("high").cast(whole)).alias("high"), F.sum(F.col("low").cast(whole)).alias("low"))
    by_dim = {r["dim"]: (int(r["high"]) << 32) + int(r["low"]) for r in sums.collect()}
    sums = [by_dim[i] for i in range(dims)]
    mean = np.array([s / n for s in sums])
    products = fit.mapInArrow(_products(dims, mean), "dim int, part int, products binary").groupBy("dim").applyInArrow(_summed, "dim int, products binary")
    covariance = np.zeros((dims, dims))
    for row in products.collect():
        covariance[row["dim"]] = np.frombuffer(row["products"]) / n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    # eigenvalues that rounding cannot tell from zero are no components
    k = min(k, dims - below(covariance, dims * _EPS * trace)) if trace > 0 else 0
    values, components = np.zeros(0), np.zeros((0, dims))
    if k:
        values, components = eigenpairs(covariance, leading_intervals(covariance, k), spark_solver(spark, covariance))
        values, components = values[:k], components[:k]
        largest = np.abs(components).argmax(axis=1)
        components = components * np.sign(components[np.arange(k), largest])[:, None]
    model = Whitening(scale, n, sums, trace, values, components)
    model.identity_error = _identity_error(fit, dims, model)
    return model


def _identity_error(fit: DataFrame, dims: int, model: Whitening) -> float:
    k = len(model.values)
    if not k:
        return 0.0
    held = fit.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.value.whitened(_matrix(batch.column(0), dims)).T], names=[f"w{i}" for i in range(k)])

    whitened = fit.mapInArrow(run, ", ".join(f"w{i} double" for i in range(k)))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = whitened.agg(*(F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened_components(vectors: DataFrame, k: int = 4, scale: float = 256.0) -> DataFrame:
    """Every usable row of ``vectors`` (vec_id, embedding), whitened on up to ``k`` components.

    A component c counts as floor(scale c). Defined cases: vectors that are null or hold null or
    non-finite entries give no row and teach nothing; shorter vectors are filled with zeros; repeated
    vectors teach once, and each row gives its rows; a null vec_id gives rows; there are as many
    components as eigenvalues that differ from zero (none for fewer than two distinct vectors, so no
    rows), in falling order; of equal eigenvalues any basis, the same for all rows; an empty table
    gives an empty table; other columns are ignored; entries or deviations beyond 64 bits raise.
    """
    rows, dims = whole_vectors(vectors, scale)
    return fitted(rows, dims, k, scale).applied(rows)

"""Embedding whitening by spectrum slicing.

The covariance of all distinct vectors is summed by Spark; its leading eigenvalues are isolated
one by one: the inertia of an LDL' factorisation of the covariance less a shift counts the
eigenvalues above that shift, so bisection gives an interval that holds the j-th one alone.
Rayleigh quotient iteration then converges cubically inside it, and two more counts, just above
and just below the result, certify that it is the j-th.

Only sums of one row a dimension or pair of dimensions reach the driver: its memory grows with
the square of the vector length, never with the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlytics.llm.common import pick, written

#: Components of the production query, and the scale entries are rounded down at.
COMPONENTS, SCALE = 4, 256
EPS = np.finfo(np.float64).eps
#: Share of the largest entry of a column that a 1x1 pivot must reach (diagonal pivoting).
PIVOT = (1 + math.sqrt(17)) / 8


# ------------------------------------------------------------------ eigenpairs


def positive_pivots(a: np.ndarray) -> int:
    """Number of positive eigenvalues of a symmetric matrix: those of D in P'AP = LDL', where D
    has blocks of one or two rows, each chosen so that no element grows much."""
    a = np.array(a, dtype=np.float64)
    n, k, count = len(a), 0, 0

    def swap(i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        pair = False
        if k + 1 < n:
            low = np.abs(a[k + 1:, k])
            r = k + 1 + int(low.argmax())
            most = low[r - k - 1]
            if abs(a[k, k]) < PIVOT * most:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                other = row.max()
                if abs(a[k, k]) * other < PIVOT * most * most:
                    if abs(a[r, r]) >= PIVOT * other:
                        swap(k, r)
                    else:
                        swap(k + 1, r)
                        pair = True
        if pair:
            d, below = a[k:k + 2, k:k + 2], a[k + 2:, k:k + 2]
            det = d[0, 0] * d[1, 1] - d[0, 1] * d[1, 0]
            count += 1 if det < 0 else 2 * int(d[0, 0] > 0)
            a[k + 2:, k + 2:] -= below @ np.linalg.solve(d, below.T)
            k += 2
        else:
            count += int(a[k, k] > 0)
            if a[k, k] != 0:
                col = a[k + 1:, k].copy()
                a[k + 1:, k + 1:] -= np.outer(col, col / a[k, k])
            k += 1
    return count


def _refine(v: np.ndarray, shift: float, found: list[np.ndarray], size: float) -> tuple[float, float, np.ndarray]:
    """(residual, eigenvalue, vector) by Rayleigh quotient iteration from the shift, at right angles
    to the vectors found so far."""
    eye, n = np.eye(len(v)), len(v)

    def clean(x):
        for _ in range(2):
            for f in found:
                x = x - f * (f @ x)
        return x / np.linalg.norm(x)

    def step(x, s):
        try:
            y = np.linalg.solve(v - s * eye, x)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            y = np.linalg.solve(v - (s + n * EPS * size) * eye, x)
        return clean(y / np.abs(y).max())

    x = clean(np.cos(np.arange(1, n + 1) * 1.7) + 0.1)  # any start without a pattern
    for _ in range(3):
        x = step(x, shift)
    best, worse = (math.inf, 0.0, x), 0
    while worse < 3:  # a step may fail to gain before the cubic convergence, and gains nothing after it
        e = float(x @ v @ x)
        off = float(np.linalg.norm(v @ x - e * x))
        worse = 0 if off < best[0] / 2 else worse + 1
        best = min(best, (off, e, x), key=lambda b: b[0])
        x = step(x, e)
    return best


def leading_eigenpairs(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest k eigenvalues of a covariance, falling, and their unit vectors as columns.

    Fewer if fewer are above rounding error.  Equal eigenvalues get some orthonormal basis of
    their space.  Raises ArithmeticError if the counts do not certify an eigenvalue's number.
    """
    size = float(np.abs(v).sum(1).max()) if v.size else 0.0
    least = 16 * len(v) * EPS * size
    counts: dict[float, int] = {2 * size + 1.0: 0}

    def above(s: float) -> int:
        if s not in counts:
            counts[s] = positive_pivots(v - s * np.eye(len(v)))
        return counts[s]

    values: list[float] = []
    vectors: list[np.ndarray] = []
    for j in range(1, min(k, above(least)) + 1):
        while True:
            lo = max(s for s, c in counts.items() if c >= j)
            hi = min(s for s, c in counts.items() if c < j)
            alone = counts[lo] - counts[hi] == 1
            if alone or hi - lo <= least:
                off, e, x = _refine(v, (lo + hi) / 2, vectors, size)
                if off <= least and lo - least <= e <= hi + least:
                    break
                if hi - lo <= least:
                    raise ArithmeticError(f"eigenvalue {j} does not settle in its interval")
            above((lo + hi) / 2)
        if not above(e + 2 * least) < j <= above(e - 2 * least):
            raise ArithmeticError(f"the counts do not certify eigenvalue {j}")
        values.append(e)
        vectors.append(x)
    return np.array(values), np.array(vectors).T.reshape(len(v), len(values))


# ------------------------------------------------------------------ sums over the vectors


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _dimension_sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for b in batches:
            x = _matrix(b.column("x"), d)
            n += len(x)
            # halves of 32 bits, so that no sum of a batch can overflow
            high, low = (x >> 32).sum(0).tolist(), (x & 0xFFFFFFFF).sum(0).tolist()
            total = [t + (h << 32) + s for t, h, s in zip(total, high, low)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                 pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["dim", "n", "s"])
    return run


def _product_sums(rows_of, d: int, width: int):
    """Sums of the products of all pairs of columns of rows_of(x), a row (i, j, g) a pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, any_row = np.zeros((width, width)), False
        for b in batches:
            y = rows_of(_matrix(b.column("x"), d))
            g += y.T @ y
            any_row = any_row or len(y) > 0
        if any_row:
            i, j = np.triu_indices(width)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(g[i, j])],
                                             names=["i", "j", "g"])
    return run


def _symmetric(fit: DataFrame, rows_of, d: int, width: int) -> np.ndarray:
    parts = fit.mapInArrow(_product_sums(rows_of, d, width), "i int, j int, g double")
    sums = parts.groupBy("i", "j").agg(F.sum("g").alias("g")).toPandas()  # one row a pair of columns
    out = np.zeros((width, width))
    out[sums.i, sums.j] = out[sums.j, sums.i] = sums.g
    return out


def integer_vectors(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): rows of df whose vector is whole, with entries floor(scale * c) as long.

    Left out are null and empty vectors and vectors with a null or non-finite entry.  Vectors of
    another length than most (of lengths equally frequent, the largest) lack entries and are
    left out like those with a null.
    """
    good = pick(df, "vec_id", "embedding").where(F.forall(
        "embedding", lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False))))
    sizes = good.groupBy(F.size("embedding").alias("d")).count().where("d > 0")
    first = sizes.orderBy(F.col("count").desc(), F.col("d").desc()).limit(1).collect()
    good = good.where(F.size("embedding") == (first[0].d if first else 0))
    return good.select("vec_id", F.transform("embedding", lambda c: F.floor(scale * c.cast("double"))).alias("x")) \
        .where(F.size("x") > 0)


def _deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sums over the dimensions of (n x - S) squared; None where a long does not hold it."""
    most = max(int(x.max(initial=0)), -int(x.min(initial=0)), 1) * n + max(map(abs, total))
    if x.shape[1] * most * most < 1 << 63:
        y = n * x - np.array(total, dtype=np.int64)
        return (y * y).sum(1).tolist()
    exact = (sum((n * a - s) ** 2 for a, s in zip(r, total)) for r in x.tolist())
    return [e if e < 1 << 63 else None for e in exact]


def whiten(df: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each whole vector of
    df (see integer_vectors) and each leading component, numbered from 1 by falling eigenvalue.

    The covariance is over the distinct integer vectors, so copies weigh nothing more; each row
    of df gets its rows, also with a null or repeated vec_id.  There are at most as many
    components as eigenvalues above rounding error: none, and so no rows, of an empty table or
    of one distinct vector.  `deviation` is null if it is too large for a long.
    """
    schema = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    kind = dict(pick(df, "vec_id").dtypes)["vec_id"]
    schema = f"vec_id {kind}, {schema}"
    rows = written(integer_vectors(df, scale), "whiten-rows")
    one = rows.select(F.size("x").alias("d")).first()
    if one is None:
        return df.sparkSession.createDataFrame([], schema)
    d = one.d
    fit = written(rows.select("x").distinct(), "whiten-fit")
    sums = (fit.mapInArrow(_dimension_sums(d), "dim int, n bigint, s decimal(38,0)")
            .groupBy("dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("dim").collect())  # d rows
    n, total = sums[0].n, [int(r.s) for r in sums]
    # centred by the nearest integers before multiplying: the products are exact in double as
    # long as their sums are under 2**53, so the covariance is the same in any order of rows
    mid = [(2 * s + n) // (2 * n) for s in total]
    rest = np.array([(s - n * m) / n for s, m in zip(total, mid)])
    centre = np.array(mid, dtype=np.int64)
    cov = _symmetric(fit, lambda x: (x - centre).astype(np.float64), d, d) / n - np.outer(rest, rest)
    values, vectors = leading_eigenpairs(cov, components)
    k = len(values)
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    explained = values / np.trace(cov)

    def project(x: np.ndarray) -> np.ndarray:
        return ((x - centre) - rest) @ vectors / np.sqrt(values)

    # a column of ones beside the projections gives their sums, and so their centred covariance
    seen = _symmetric(fit, lambda x: np.column_stack([project(x), np.ones(len(x))]), d, k + 1) / n
    white = seen[:k, :k] - np.outer(seen[k, :k], seen[k, :k])
    error = float(np.abs(white - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), d)
            m = len(x)
            at = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n, dtype=np.int64)),
                 pa.array(_deviations(x, n, total), pa.int64()).take(pa.array(at)),
                 pa.array(project(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)

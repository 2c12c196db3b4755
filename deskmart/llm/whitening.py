"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmart.llm.common import written

SCALE, SHIFT = 1024, 100_000   # fixed values of the contract: x = floor(SCALE * entry) + SHIFT
LARGEST = 2.0 ** 42            # entries beyond are no whole numbers of doubles after scaling
ROWS = 4096                    # multiplied at once; products of limbs add up to less than 2 ** 53
LIMB = 20
_WIDE = np.longdouble


@dataclass(frozen=True)
class Fit:
    """``n`` vectors with sums ``sums`` per dimension; the covariance's trace, eigenvalues by falling size and unit
    eigenvectors (columns). ``eigenvalues`` are as many as the covariance has rank."""

    n: int
    sums: list[int]
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(factor, order) with ``matrix[order][:, order] = factor @ factor.T`` for a symmetric matrix without negative
    eigenvalues; the largest remaining diagonal entry comes next, and the factor has as many columns as the rank."""
    rest = matrix.copy()
    d = len(rest)
    order, columns = np.arange(d), []
    least = d * np.finfo(rest.dtype).eps * (np.max(np.diag(rest)) if d else 0)
    for k in range(d):
        p = k + int(np.argmax(np.diag(rest)[k:]))
        if not rest[p, p] > least:
            break
        swap = [k, p]
        rest[swap], order[swap] = rest[swap[::-1]], order[swap[::-1]]
        rest[:, swap] = rest[:, swap[::-1]]
        for column in columns:
            column[swap] = column[swap[::-1]]
        column = np.zeros(d, rest.dtype)
        column[k:] = rest[k:, k] / np.sqrt(rest[k, k])
        rest[k:, k:] -= np.outer(column[k:], column[k:])
        columns.append(column)
    return np.stack(columns, axis=1) if columns else np.zeros((d, 0), rest.dtype), order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``factor`` with its columns rotated until all are orthogonal. Every step rotates disjoint pairs of columns at
    once, and the steps of a sweep meet every pair."""
    a = factor.copy()
    r = a.shape[1]
    players = np.arange(r + r % 2)  # one stands idle in a sweep of an odd number
    tolerance = np.finfo(a.dtype).eps * max(r, 1)
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(players) - 1):
            i, j = players[:len(players) // 2], players[:len(players) // 2 - 1:-1]
            real = (i < r) & (j < r)
            i, j = i[real], j[real]
            left, right = a[:, i], a[:, j]
            dot = (left * right).sum(axis=0)
            one, two = (left * left).sum(axis=0), (right * right).sum(axis=0)
            angle = np.abs(dot) / np.sqrt(one * two)
            worst = max(worst, float(angle.max(initial=0)))
            turn = angle > tolerance
            zeta = (two - one) / np.where(turn, 2 * dot, 1)
            t = np.where(turn, np.copysign(1, zeta) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0)
            c = 1 / np.sqrt(1 + t * t)
            a[:, i], a[:, j] = c * left - c * t * right, c * t * left + c * right
            players = np.concatenate([players[:1], players[-1:], players[1:-1]])
        if worst <= tolerance:
            break
    return a


def eigen(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues by falling size, unit eigenvectors as columns) of the positive part of a covariance: norms and
    directions of the rotated columns of its pivoted Cholesky factor. Computed in the widest floats there are."""
    factor, order = pivoted_cholesky(covariance.astype(_WIDE))
    rotated = one_sided_jacobi(factor)
    squares = (rotated * rotated).sum(axis=0)
    falling = np.argsort(-squares, kind="stable")
    values = squares[falling]
    vectors = np.zeros_like(rotated)
    vectors[order] = rotated[:, falling] / np.sqrt(values)
    return values.astype(float), vectors.astype(float)


def _usable(vector: Column) -> Column:
    """No null, no entry that is null, not finite or beyond LARGEST."""
    inside = F.forall(vector, lambda v: F.coalesce(F.abs(v.cast("double")) < LARGEST, F.lit(False)))
    return F.coalesce(vector.isNotNull() & inside, F.lit(False))


def _whole(column: pa.Array, d: int) -> np.ndarray:
    """One row of whole numbers for each vector of ``d`` entries."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(SCALE * flat) + SHIFT).astype(np.int64).reshape(-1, d)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """``y`` as the sum of limbs times powers of 2 ** LIMB, in doubles; the last limb carries the sign."""
    out, half = [], 1 << (LIMB - 1)
    while len(y) and (y.max() >= half or y.min() < -half):
        out.append((y & ((1 << LIMB) - 1)).astype(float))
        y = y >> LIMB
    return [*out, y.astype(float)]


def _products(y: np.ndarray) -> np.ndarray:
    """y.T @ y without rounding, as Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for at in range(0, len(y), ROWS):
        limbs = _limbs(y[at:at + ROWS])
        for p, a in enumerate(limbs):
            for q, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (p + q))
    return total


def _summed(df: DataFrame, column: str, width: int, fold) -> list[int]:
    """Sum over all batches of ``fold(batch column)``, a list of ``width`` integers: one list a task, added up by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype=object)
        for batch in batches:
            if batch.num_rows:
                total += fold(batch.column(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width, dtype=np.int32)), pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0))],
            names=["k", "v"])

    added = df.select(column).mapInArrow(run, "k int, v decimal(38,0)").groupBy("k").agg(F.sum("v").alias("v"))
    out = [0] * width
    for k, v in added.toLocalIterator():
        out[k] = int(v)
    return out


def fit(vectors: DataFrame, column: str, d: int, n: int) -> Fit:
    """Sums, covariance and its eigenvectors over all ``n`` rows of ``vectors``, each with ``d`` usable entries.

    Two passes: sums per dimension, then products of entries centred at the whole number next to the mean, whose
    rest is taken off afterwards. All is added up in whole numbers, so the covariance is rounded once and the
    same however rows are dealt. The driver and each task hold d * d numbers.
    """
    sums = _summed(vectors, column, d, lambda c: _whole(c, d).astype(object).sum(axis=0))
    centre = [round(Fraction(s, n)) for s in sums]
    low, high = np.triu_indices(d)

    def products(c: pa.Array) -> np.ndarray:
        return _products(_whole(c, d) - np.array(centre, dtype=np.int64))[low, high]

    total = _summed(vectors, column, len(low), products)
    rest = [s - n * m for s, m in zip(sums, centre)]
    covariance = np.zeros((d, d), _WIDE)
    for i, j, v in zip(low, high, total):
        exact = n * v - rest[i] * rest[j]  # n * n times the entry
        whole, part = divmod(exact, n * n)
        covariance[i, j] = covariance[j, i] = _WIDE(whole) + _WIDE(part) / _WIDE(n * n)
    values, components = eigen(covariance)
    return Fit(n, sums, float(np.trace(covariance)), values, components)


def _projected(vectors: DataFrame, column: str, keys: list[str], model: Fit, k: int) -> DataFrame:
    """``keys``, deviation and the ``k`` whitened values of every row."""
    d, n, sums = len(model.sums), model.n, model.sums
    centre = [round(Fraction(s, n)) for s in sums]
    rest = np.array([float(Fraction(s, n) - m) for s, m in zip(sums, centre)])
    turn = model.components[:, :k] / np.sqrt(model.eigenvalues[:k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _whole(batch.column(0), d)
            y = x - np.array(centre, dtype=np.int64)
            reach = n * (int(np.abs(y).max(initial=0)) + 1)
            if reach * reach * d < 1 << 63:
                off = n * x - np.array(sums, dtype=np.int64)
                deviation = pa.array((off * off).sum(axis=1))
            else:
                off = n * x.astype(object) - np.array(sums, dtype=object)
                deviation = pa.array([v if v < 1 << 63 else None for v in (off * off).sum(axis=1)], pa.int64())
            values = (y - rest) @ turn
            starts = pa.array(np.arange(len(x) + 1, dtype=np.int32) * k)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], deviation, pa.ListArray.from_arrays(starts, pa.array(values.ravel()))],
                names=[*batch.schema.names[1:], "deviation", "whitened"])

    chosen = vectors.select(column, *keys)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema[1:])
    return chosen.mapInArrow(run, f"{kinds}, deviation bigint, whitened array<double>")


def _covariance_error(values: DataFrame, column: str, k: int) -> float:
    """Largest absolute entry of the covariance of the ``k`` values of ``column`` minus the identity."""
    item = [F.col(column)[i] for i in range(k)]
    means = values.agg(*(F.avg(c).alias(f"m{i}") for i, c in enumerate(item))).first()
    centred = [c - F.lit(m) for c, m in zip(item, means)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = values.agg(*(F.avg(centred[i] * centred[j]).alias(f"v{i}_{j}") for i, j in pairs)).first()
    return max((abs(v - (i == j)) for v, (i, j) in zip(found, pairs)), default=0.0)


def whiten(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = 8) -> DataFrame:
    """``key``, component, n, deviation, whitened, explained, identity_error of every usable vector and component.

    Entries are taken as the whole numbers x = floor(1024 * entry) + 100000. The components are unit eigenvectors of the
    covariance of all usable vectors, by falling eigenvalue from 1; ``whitened`` is the centred vector's
    projection over the eigenvalue's root, ``explained`` the eigenvalue's share of the trace, ``deviation`` the exact
    sum of (n * x - sum) ** 2 (null where 64 bits cannot hold it) and ``identity_error`` how far the
    covariance of the whitened values, measured on the written rows, is from the identity.

    Usable are vectors without null, infinite or NaN entries or entries of 2 ** 42 or more, and, should lengths
    differ, of the most frequent length (the longer one of equally frequent ones). Components with an
    eigenvalue of zero are left out, so equal vectors, a single one or an empty table give no rows. Repeated rows count
    each and are all returned, null keys too; ties between eigenvalues are broken arbitrarily, alike for all
    rows; further columns are ignored. Memory holds d * d numbers for vectors of d entries.
    """
    usable = vectors.select(F.col(column), F.col(key)).where(_usable(F.col(column)))
    lengths = usable.groupBy(F.size(column).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    d, n = (common["d"], common["n"]) if common else (0, 0)
    usable = usable.where(F.size(column) == d)
    model = fit(usable, column, d, n) if d else Fit(0, [], 0.0, np.zeros(0), np.zeros((0, 0)))
    k = min(components, len(model.eigenvalues))
    if k:
        values = written(_projected(usable, column, [key], model, k), "whitened")
        error = _covariance_error(values, "whitened", k)
    else:
        values, error = usable.where(F.lit(False)).select(
            key, F.lit(None).cast("bigint").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened")), 0.0
    shares = F.array(*(F.lit(float(e) / model.trace) for e in model.eigenvalues[:k])).cast("array<double>")
    return (values.select(key, "deviation", F.posexplode("whitened").alias("at", "value"))
            .select(key, (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
                    F.col("value").alias("whitened"), F.get(shares, F.col("at")).alias("explained"),
                    F.lit(error).alias("identity_error")))

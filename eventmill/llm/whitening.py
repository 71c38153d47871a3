"""Whitening of vectors by their principal components.

Each partition keeps the spectrum (eigenvalues and vectors) of what it has read:
a vector, centred on the mean so far, is a rank-one update, whose eigenvalues are
the roots of a secular equation. Directions that the update does not touch, and
all but one of equal eigenvalues, are deflated. Two spectra become one by the
rank-one updates of the second's eigenvectors and of the difference of means;
they meet in a tree. The result is a basis of whole rank, in which the exact
covariance is all but diagonal. A last pass (Rayleigh-Ritz) sums up that
covariance over all partitions, and its small eigenproblem gives the components.

What reaches the driver is bounded by the dimensions alone: sums, one spectrum,
one matrix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.session import written

SCALE = 64
COMPONENTS = 16
#: Spectra that one task combines.
FAN_IN = 8
EPS = float(np.finfo(float).eps)
#: Most steps to a root; some eight are usual.
STEPS = 80
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(weights / (poles - x)) = 0 for rising poles and positive weights, one behind each pole.

    A root is its nearest pole's number and the distance from it, so that its
    differences to poles lose no digits. A step keeps value and slope of the
    poles up to the root in the pole below it, those of the others in the pole
    above, and solves that; where it leaves the bracket, the bracket is halved.
    """
    n = len(poles)
    own = np.arange(n)
    last = own == n - 1
    above = np.minimum(own + 1, n - 1)
    gaps = np.append(np.diff(poles), weights.sum())
    at_middle = 1 + (weights / ((poles[None, :] - poles[:, None]) - gaps[:, None] / 2)).sum(1)
    near_own = (at_middle >= 0) | last
    origin = np.where(near_own, own, above)
    poles_from = poles[None, :] - poles[origin][:, None]  # a row for each root
    low = np.where(near_own, np.where(last & (at_middle < 0), gaps / 2, 0.0), -gaps / 2)
    high = np.where(near_own, np.where(last & (at_middle < 0), gaps, gaps / 2), 0.0)
    x = (low + high) / 2
    up_to_own = np.tri(n)
    for _ in range(STEPS):
        apart = poles_from - x[:, None]
        terms = weights / apart
        value = 1 + terms.sum(1)
        found = np.abs(value) <= n * EPS * (1 + np.abs(terms).sum(1))  # no digits left
        if found.all():
            break
        low, high = np.where(value < 0, x, low), np.where(value < 0, high, x)
        slopes = terms / apart
        slope_below = (slopes * up_to_own).sum(1)
        slope_above = slopes.sum(1) - slope_below
        d1, d2 = apart[own, own], np.where(last, 1.0, apart[own, above])
        s1, s2 = slope_below * d1 * d1, slope_above * d2 * d2
        c = value - slope_below * d1 - slope_above * d2
        a, b = c * d1 * d2 + s1 * d2 + s2 * d1, c * (d1 + d2) + s1 + s2  # c t^2 - b t + a = 0 for the step t
        root = np.sqrt(np.maximum(b * b - 4 * a * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(last, d1 + s1 / c, np.where(b > 0, 2 * a / (b + root), (b - root) / (2 * c)))
        moved = x + step
        inside = np.isfinite(moved) & (moved > low) & (moved < high)
        moved = np.where(inside, moved, (low + high) / 2)
        moved = np.where(found, x, moved)
        still = np.abs(moved - x) <= 2 * EPS * np.abs(moved)
        x = moved
        if still.all():
            break
    return origin, x


class Spectrum:
    """Eigenvalues (rising) and eigenvectors (columns) of the scatter of n vectors about their mean."""

    def __init__(self, dim: int):
        self.n, self.mean = 0, np.zeros(dim)
        self.values, self.vectors = np.zeros(dim), np.eye(dim)

    def update(self, z: np.ndarray) -> None:
        """The spectrum of the scatter plus z z'."""
        values, basis = self.values, self.vectors
        w = z @ basis
        size = float(w @ w)
        if size == 0:
            return
        tolerance = 8 * EPS * max(values[-1], size)
        for i in np.flatnonzero(np.diff(values) <= tolerance).tolist():  # of equal eigenvalues, the last takes all of z
            if w[i]:
                r = float(np.hypot(w[i], w[i + 1]))
                c, s = w[i + 1] / r, w[i] / r
                x, y = basis[:, i].copy(), basis[:, i + 1].copy()
                basis[:, i], basis[:, i + 1] = c * x - s * y, s * x + c * y
                w[i], w[i + 1] = 0.0, r
        live = np.flatnonzero(np.abs(w) * np.sqrt(size) > tolerance)
        poles, parts = values[live], w[live]
        n = len(live)
        if n == 1:
            values[live] = poles + parts * parts
        elif n:
            origin, x = secular_roots(poles, parts * parts)
            root_from = x[None, :] - (poles[:, None] - poles[origin][None, :])  # root minus pole, a row for each pole
            # the weights for which these roots are exact keep the new vectors at right angles
            between = poles[None, :] - poles[:, None]
            others = np.where(np.tril(np.ones((n, n), bool), -1), between, np.roll(between, -1, 1))
            others[:, -1] = 1.0
            exact = np.copysign(np.sqrt(np.abs(np.prod(root_from / others, axis=1))), parts)
            turned = exact[:, None] / root_from
            turned /= np.sqrt((turned * turned).sum(0))
            values[live] = poles[origin] + x
            basis[:, live] = basis[:, live] @ turned
        order = np.argsort(values, kind="stable")
        self.values, self.vectors = values[order], basis[:, order]

    def add(self, x: np.ndarray) -> None:
        """One more vector."""
        apart = x - self.mean
        self.n += 1
        self.mean += apart / self.n
        self.update(apart * np.sqrt((self.n - 1) / self.n))

    def merge(self, other: Spectrum) -> None:
        """All vectors of another spectrum."""
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.update(np.sqrt(value) * vector)
        n = self.n + other.n
        apart = other.mean - self.mean
        self.update(apart * np.sqrt(self.n * other.n / n))
        self.mean += apart * (other.n / n)
        self.n = n


def numbers(column: pa.ListArray, dim: int) -> np.ndarray:
    """A matrix of a column of equally long lists."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def spectrum_row(node: int, s: Spectrum) -> pa.RecordBatch:
    lists = [pa.array([v.ravel().tolist()], pa.list_(pa.float64())) for v in (s.mean, s.values, s.vectors)]
    return pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([s.n], pa.int64()), *lists], ["node", "n", "mean", "eigen", "vectors"])


SPECTRUM = "node long, n long, mean array<double>, eigen array<double>, vectors array<double>"


def spectrum_of(fit: DataFrame, dim: int) -> Spectrum:
    """The spectrum of all rows of ``fit`` (x): by partition, then in a tree."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Spectrum(dim)
        for batch in batches:
            for x in numbers(batch.column("x"), dim).astype(float):
                s.add(x)
        if s.n:
            yield spectrum_row(TaskContext.get().partitionId(), s)

    def combine(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = Spectrum(dim)
        for batch in batches:
            for row in batch.to_pylist():
                s = Spectrum(dim)
                s.n, s.mean, s.values = row["n"], np.array(row["mean"]), np.array(row["eigen"])
                s.vectors = np.array(row["vectors"]).reshape(dim, dim)
                if whole.n:
                    whole.merge(s)
                else:
                    whole = s
        yield spectrum_row(key[0].as_py(), whole)

    spectra = written(fit.select("x").mapInArrow(read, SPECTRUM), "spectra")
    while spectra.count() > 1:
        spectra = written(spectra.withColumn("node", F.floor(F.col("node") / FAN_IN)).groupBy("node").applyInArrow(combine, SPECTRUM), "spectra")
    row = spectra.first()
    s = Spectrum(dim)
    s.n, s.mean, s.values, s.vectors = row.n, np.array(row.mean), np.array(row.eigen), np.array(row.vectors).reshape(dim, dim)
    return s


def centred(n: int, sums: list[int], dim: int) -> Callable[[pa.ListArray], tuple[np.ndarray, np.ndarray]]:
    """A function of a column of x: n * x - S as integers, and that divided by n. Integers too large for 64 bits are Python's."""
    small = np.array(sums, object)

    def of(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        x = numbers(column, dim)
        largest = n * max((abs(int(v)) for v in (x.min(), x.max())), default=0) + max(map(abs, sums), default=0) if x.size else 0
        if dim * largest * largest < 1 << 63:
            whole = n * x - small.astype(np.int64)
            return whole, whole / n
        whole = n * x.astype(object) - small
        return whole, (whole / n).astype(float)

    return of


def moments(fit: DataFrame, n: int, sums: list[int], basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and mean product of each two, of the centred rows projected on the columns of ``basis``."""
    dim, k = basis.shape
    around = centred(n, sums, dim)
    shared = fit.sparkSession.sparkContext.broadcast(basis)  # dim x dim numbers at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                p = around(batch.column("x"))[1] @ shared.value
                total += p.sum(0)
                products += p.T @ p
        yield pa.RecordBatch.from_arrays([pa.array([np.append(total, products).tolist()], pa.list_(pa.float64()))], ["part"])

    parts = fit.select("x").mapInArrow(run, "part array<double>").select(F.posexplode("part").alias("at", "value"))
    flat = np.zeros(k + k * k)
    for row in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():
        flat[row["at"]] = row.value
    return flat[:k] / n, flat[k:].reshape(k, k) / n


def principal(fit: DataFrame, n: int, sums: list[int], most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Components (columns) by falling eigenvalue, these, and the trace; directions without variance are no components."""
    basis = spectrum_of(fit, len(sums)).vectors
    _, covariance = moments(fit, n, sums, basis)
    values, turn = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > len(sums) * EPS * max(values.max(), 0)][:most]
    return basis @ turn[:, order], values[order], float(np.trace(covariance))


def whiten(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each row and component.

    Rows whose vector is missing, or has a missing or non-finite entry, are
    dropped. An entry c counts as x = floor(64 * c); a shift of all x alters
    nothing here. The fit takes each different x vector once, the result has
    every row, so repeated rows and missing ids need no rule. Vectors of
    different lengths are whitened apart, each length on its own fit.
    Directions without variance (fewer vectors than dimensions, constant
    entries) are no components; one vector alone, or empty vectors, give no rows,
    nor does an empty table. ``deviation`` is exact, and missing if it is beyond
    a long. Entries beyond a long count as the largest one.
    """
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = embeddings.where(F.col("embedding").isNotNull()).where(finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda v: F.floor(v.cast("double") * SCALE)).alias("x"))
    rows = written(rows, "rounded").withColumn("dim", F.size("x"))
    fit = written(rows.select("x", "dim").distinct(), "fit")
    sums = fit.select("dim", F.posexplode("x").alias("at", "value")).groupBy("dim", "at").agg(
        F.sum(F.col("value").cast("decimal(20,0)")).alias("total"), F.count(F.lit(1)).alias("n")).collect()  # a row for each dimension
    out = rows.sparkSession.createDataFrame([], RESULT)
    for dim in sorted({r.dim for r in sums}):
        own = sorted((r for r in sums if r.dim == dim), key=lambda r: r["at"])
        out = out.unionAll(whiten_length(rows.where(F.col("dim") == dim), fit.where(F.col("dim") == dim), own[0].n, [int(r.total) for r in own], most))
    return out


def whiten_length(rows: DataFrame, fit: DataFrame, n: int, sums: list[int], most: int) -> DataFrame:
    """``whiten`` for vectors of one length."""
    components, values, trace = principal(fit, n, sums, most)
    k = len(values)
    if not k:
        return rows.sparkSession.createDataFrame([], RESULT)
    scaled = components / np.sqrt(values)
    mean, products = moments(fit, n, sums, scaled)
    error = float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max())
    around = centred(n, sums, len(sums))
    shared = rows.sparkSession.sparkContext.broadcast((scaled, values / trace))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scaled, explained = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            whole, real = around(batch.column("x"))
            deviation = [v if v < 1 << 63 else None for v in (whole * whole).sum(1).tolist()]
            each = np.repeat(np.arange(batch.num_rows), k)
            m = len(each)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)), pa.array(np.full(m, n)),
                 pa.array(deviation, pa.int64()).take(pa.array(each)), pa.array((real @ scaled).ravel()), pa.array(np.tile(explained, batch.num_rows)),
                 pa.array(np.full(m, error))], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(run, RESULT)

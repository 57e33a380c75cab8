"""Embedding whitening by incremental eigendecomposition.

A ``Spectrum`` is the eigendecomposition of the scatter of the rows it has seen,
with their number and mean. Rows enter as centred rank-one updates: the new
eigenvalues are the roots of the secular equation (a safeguarded two-pole rational
iteration for all roots at once, each from its nearer pole), entries of the update
that are next to nothing and equal eigenvalues are deflated, and the new vectors
come from the update that the computed roots belong to exactly (Loewner's
formula), so they stay orthonormal. A block of rows first becomes its triangular
factor, which has the block's scatter: a column count of updates stands for
``ROWS`` rows. Two spectra combine by as many rank-one updates, one for each
eigenpair, and one for the distance of the means.

Each task makes one spectrum of its rows; spectra combine ``FAN`` at a time in
tasks until the driver has ``FAN`` at most. A last distributed pass refines the
result (Rayleigh-Ritz): the rows, centred by their exact integer sums, are
projected on all vectors found, and the eigenvectors of the small matrix of
products turn these into the covariance's to double precision.

Entries are taken as long x = floor(64 c) + 1000000. The fit is over each
distinct x vector once; every row whose vector takes part is projected.

Defined results: rows whose vector is null, empty, of another length than most (the
shorter of equally frequent ones counts), or holds null, non-finite or entries of
2^46 and more in size (no exact long) take no part; null ids and repeated rows stay,
each with its own rows. Components whose eigenvalue is nothing but rounding (as of a
constant column, or all of a single vector) are not returned; neither is anything
for an empty table. Equal eigenvalues have any basis of their space. A deviation
beyond a long is null. Work grows with the rows; a task, the driver and the
broadcasts hold matrices of the dimension's square only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaymart.llm.common import forget, written

COMPONENTS = 16
#: Rows of a block that enters as its triangular factor.
ROWS = 1024
#: Spectra that one task combines.
FAN = 32
SCALE, SHIFT = 64.0, 1_000_000
_EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + z z', for rising distinct d and no zero in z: for each,
    the index of the pole it is measured from, and its distance from it."""
    m, weight = len(d), z * z
    k = np.arange(m)
    upper = np.append(d[1:], d[-1] + weight.sum())
    gap = upper - d

    def value(origin, tau):
        """f, and the derivatives of the parts of its poles up to and beyond k."""
        part = weight / ((d[None, :] - d[origin][:, None]) - tau[:, None])
        slope = part * part / weight
        low = np.tril(slope).sum(axis=1)
        return 1 + part.sum(axis=1), low, slope.sum(axis=1) - low, np.abs(part).sum(axis=1)

    with np.errstate(all="ignore"):
        f, *_ = value(k, gap / 2)
        near_next = (f < 0) & (k < m - 1)
        origin = np.where(near_next, np.minimum(k + 1, m - 1), k)
        # the last root has no pole above it
        low = np.where(near_next, -gap / 2, np.where(f < 0, gap / 2, 0.0))
        high = np.where(near_next, 0.0, np.where(f < 0, gap, gap / 2))
        tau = (low + high) / 2
        for _ in range(60):
            f, psi, phi, size = value(origin, tau)
            low, high = np.where(f < 0, tau, low), np.where(f < 0, high, tau)
            left = (d - d[origin]) - tau
            right = (upper - d[origin]) - tau
            a = (left + right) * f - left * right * (psi + phi)
            b = left * right * f
            c = f - left * psi - right * phi
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = left[-1] + left[-1] ** 2 * psi[-1] / (f[-1] - left[-1] * psi[-1])
            new = tau + step
            new = np.where(np.isfinite(new) & (new > low) & (new < high), new, (low + high) / 2)
            still = (np.abs(f) > 4 * _EPS * (1 + size)) & (np.abs(new - tau) > 2 * _EPS * np.abs(tau))
            if not still.any():
                break
            tau = np.where(still, new, tau)
    return origin, tau


@dataclass
class Spectrum:
    """n rows, their mean, and the eigendecomposition of their scatter (rising)."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def none(dim: int) -> Spectrum:
        return Spectrum(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def rank_one(self, v: np.ndarray) -> None:
        """Add v v' to the scatter."""
        z = v @ self.vectors
        size = np.sqrt(z @ z)
        if size == 0.0:
            return
        d, q = self.values, self.vectors
        tol = 8 * _EPS * max(d[-1], size * size)
        active = np.abs(z) * size > tol
        at = np.flatnonzero(active)
        # equal eigenvalues: turn their vectors so that one of each group takes the update
        for i, j in zip(at[:-1], at[1:]):
            if d[j] - d[i] <= tol:
                r = np.hypot(z[i], z[j])
                c, s = z[j] / r, z[i] / r
                q[:, [i, j]] = q[:, [i, j]] @ np.array([[c, s], [-s, c]])
                z[i], z[j] = 0.0, r
                active[i] = False
        at = np.flatnonzero(active)
        if not len(at):
            return
        da, za = d[at], z[at]
        origin, tau = secular_roots(da, za)
        apart = (da[:, None] - da[origin][None, :]) - tau[None, :]  # d_i - new_k
        # the update these roots belong to
        poles = da[:, None] - da[None, :]
        np.fill_diagonal(poles, -1.0)
        exact = np.sqrt(np.abs(np.prod(apart / poles, axis=1))) * np.sign(za)
        turn = exact[:, None] / apart
        turn /= np.sqrt((turn * turn).sum(axis=0))
        d, q = d.copy(), q.copy()
        d[at] = da[origin] + tau
        q[:, at] = q[:, at] @ turn
        order = np.argsort(d, kind="stable")
        self.values, self.vectors = d[order], q[:, order]

    def _shifted(self, n: int, mean: np.ndarray) -> None:
        """Take in the number and the mean of rows whose centred scatter is in."""
        apart, total = mean - self.mean, self.n + n
        if self.n:
            self.rank_one(apart * np.sqrt(self.n * (n / total)))
        self.mean = self.mean + apart * (n / total)
        self.n = total

    def add(self, rows: np.ndarray) -> None:
        """Take in a block of rows."""
        if not len(rows):
            return
        mean = rows.mean(axis=0)
        centred = rows - mean
        if len(rows) > rows.shape[1]:
            centred = np.linalg.qr(centred, mode="r")
        for v in centred:
            self.rank_one(v)
        self._shifted(len(rows), mean)

    def merge(self, other: Spectrum) -> None:
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.rank_one(vector * np.sqrt(value))
        self._shifted(other.n, other.mean)


_SPECTRA = "id long, n long, sums array<long>, mean array<double>, eigenvalues array<double>, eigenvectors array<double>"


def _pack(id_: int, spectrum: Spectrum, sums: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"id": [id_], "n": [spectrum.n], "sums": [sums], "mean": [spectrum.mean],
                         "eigenvalues": [spectrum.values], "eigenvectors": [spectrum.vectors.ravel()]})


def _merged(frame: pd.DataFrame) -> tuple[Spectrum, np.ndarray]:
    out, sums = None, 0
    for r in frame.sort_values("id").itertuples():
        dim = len(r.mean)
        one = Spectrum(r.n, np.array(r.mean), np.array(r.eigenvalues), np.array(r.eigenvectors).reshape(dim, dim))
        sums = sums + np.array(r.sums, np.int64)
        if out is None:
            out = one
        else:
            out.merge(one)
    return out, sums


def _matrices(batches: Iterator[pa.RecordBatch], dim: int, column: int = 0) -> Iterator[np.ndarray]:
    """Blocks of x - SHIFT (exact)."""
    for batch in batches:
        flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
        yield np.asarray(flat, np.int64).reshape(-1, dim) - SHIFT


def spectrum_of(fit: DataFrame, dim: int, rows: int = ROWS, fan: int = FAN) -> tuple[Spectrum, np.ndarray]:
    """The spectrum of x - SHIFT over all rows, and the exact sums of x."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        spectrum, sums = Spectrum.none(dim), np.zeros(dim, np.int64)
        for x in _matrices(batches, dim):
            for i in range(0, len(x), rows):
                spectrum.add(x[i:i + rows].astype(float))
            sums += x.sum(axis=0) + len(x) * SHIFT
        if spectrum.n:
            yield pa.RecordBatch.from_pandas(_pack(TaskContext.get().partitionId(), spectrum, sums), schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_SPECTRA))
    spectra = written(fit.select("x").mapInArrow(of_task, _SPECTRA), "spectra")
    while spectra.count() > fan:
        level = spectra
        grouped = level.withColumn("group", F.expr(f"id div {fan}")).groupBy("group")
        spectra = written(grouped.applyInPandas(
            lambda key, frame: _pack(key[0], *_merged(frame)), _SPECTRA), "spectra")
        forget(level)
    found = _merged(spectra.toPandas())  # `fan` rows at most
    forget(spectra)
    return found


def _summed(fit: DataFrame, dim: int, size: int, fn) -> np.ndarray:
    """The sum over all blocks of a flat array of ``size`` numbers, added up on the cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for x in _matrices(batches, dim):
            total += fn(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["at", "value"])

    added = fit.select("x").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(size)
    frame = added.toPandas()  # `size` rows
    out[frame["at"].to_numpy()] = frame["value"].to_numpy()
    return out


@dataclass
class Whitening:
    """What :func:`fit` found: x's exact sums over n distinct vectors, and the
    components (columns, eigenvalues falling) of their covariance."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The integers next to the mean of x - SHIFT, and n times what is left of it (exact)."""
        shifted = self.sums - self.n * SHIFT
        near = (2 * shifted + self.n) // (2 * self.n)
        return near, shifted - self.n * near

    def centred(self, x: np.ndarray) -> np.ndarray:
        near, rest = self.centre()
        return (x - near) - rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        near, rest = self.centre()
        about = ((self.n * (x - near).astype(float) - rest) ** 2).sum(axis=1)
        fits = about < 2.0**62
        exact = ((self.n * (x[fits] - near) - rest) ** 2).sum(axis=1)
        out = np.full(len(x), None, object)
        out[fits] = exact.tolist()
        return out.tolist()


def quantised(vectors: DataFrame) -> tuple[DataFrame, int | None]:
    """vec_id and x of the rows that take part, and their dimension (None: no row)."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) >= 2.0**46)
    v = F.col("embedding")
    usable = vectors.filter(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad))
    top = usable.groupBy(F.size(v).alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not top:
        return usable, None
    x = F.transform(v, lambda c: F.floor(F.lit(SCALE) * c.cast("double")) + F.lit(SHIFT).cast("long"))
    return usable.filter(F.size(v) == top[0].dim).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")), top[0].dim


def fit(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct x vectors of ``rows``."""
    distinct = written(rows.select("x").distinct(), "distinct-vectors")
    spectrum, sums = spectrum_of(distinct, dim)
    w = Whitening(spectrum.n, sums, spectrum.values, spectrum.vectors, 0.0, 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        y = w.centred(x) @ basis
        return (y.T @ y).ravel()

    basis = np.linalg.qr(spectrum.vectors)[0]
    ritz = _summed(distinct, dim, dim * dim, products).reshape(dim, dim) / w.n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    trace = float(np.trace(ritz))
    keep = np.flatnonzero(values > dim * _EPS * max(trace, 0.0))[::-1][:components]
    w = Whitening(w.n, sums, values[keep], (basis @ turn)[:, keep], trace, 0.0)
    k = len(keep)

    def moments(x: np.ndarray) -> np.ndarray:
        y = w.whitened(x)
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    if k:
        total = _summed(distinct, dim, k + k * k, moments) / w.n
        covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
        w.identity_error = float(np.abs(covariance - np.eye(k)).max())
    forget(distinct)
    return w


_REPORT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")


def report(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per remaining vector and component. Extra columns are not read."""
    rows, dim = quantised(vectors)
    if dim is None:
        return vectors.sparkSession.createDataFrame([], _REPORT)
    shared = vectors.sparkSession.sparkContext.broadcast(fit(rows, dim, components))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        k, explained = len(w.values), w.values / w.trace if w.trace else w.values
        for batch in batches:
            x = next(_matrices([batch], dim, 1))
            m = len(x)
            if not m or not k:
                continue
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, w.n)), pa.array(w.deviations(x), pa.int64()).take(each),
                pa.array(w.whitened(x).ravel()), pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, w.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, _REPORT)

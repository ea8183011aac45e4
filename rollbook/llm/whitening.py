"""Whitening of embeddings by incremental eigendecomposition.

Every entry c becomes the whole number ``floor(scale * c) + shift``. The spectrum of the vectors' scatter
(the sum of squares about the mean, n times the covariance) is kept as eigenvalues and
eigenvectors and moved on by rank-one updates only:

* A task takes its vectors in blocks. A block's vectors are centred about the block's mean and
  turned by an orthogonal transformation (QR), which leaves at most as many vectors as there are
  dimensions and the same scatter; each of them is one update, and one more accounts for the
  distance between the block's mean and the mean so far. ``block=1`` updates vector by vector.
* An update solves the secular equation for all new eigenvalues at once, each between its two
  old neighbours. Entries of the update that are nothing, and equal eigenvalues (one entry is rotated
  away), are deflated: their eigenpairs stay. The eigenvectors come from the solved eigenvalues by the
  update that has exactly these (Gu and Eisenstat), so they are orthogonal however close the values lie.
* Spectra of tasks are merged ``fan`` at a time, in rounds: the eigenvectors of one, as long as the roots of
  their eigenvalues, and the difference of the means update the other.
* At last the covariance is taken once more, about the exact mean, in the basis found (distributed:
  every task sends the sums of products of its projected vectors) and diagonalised there: Rayleigh-Ritz
  over the whole space, which takes away what the updates' rounding left.

Whitened values are the centred vectors on the first ``keep`` components, divided by the root of the
eigenvalue; the largest distance of their covariance from the identity is measured on them.

What the driver or a task holds is a few matrices of d x d numbers, for d dimensions, whatever the rows.

Defined cases: vectors that are null or hold a null or non-finite entry are left out, and so are those
of another length than the most frequent one (the shorter of equally frequent); zero vectors, equal
vectors, equal ids and null ids take part row by row; entries beyond 2**40 in size after scaling count as
2**40; a component without spread (beyond rounding) has null ``whitened`` and is not part of the
identity error; ``deviation`` is null where it does not fit a long; other columns are not read, so their
names do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.session import written

_EPS = float(np.finfo(np.float64).eps)
_SPECTRUM = "part long, n long, mean array<double>, values array<double>, vectors binary, sums array<string>"
_LARGEST = 1 << 40


# Spectra of scatters.


class Spectrum:
    """``vectors @ diag(values) @ vectors.T`` is the scatter of ``n`` vectors about ``mean``."""

    def __init__(self, dimensions: int):
        self.n = 0
        self.mean = np.zeros(dimensions)
        self.values = np.zeros(dimensions)
        self.vectors = np.eye(dimensions)

    def update(self, v: np.ndarray) -> None:
        """The spectrum after adding ``v v^T``."""
        self.values, self.vectors = rank_one(self.values, self.vectors, v)

    def _shift(self, n: int, mean: np.ndarray) -> None:
        """Account for ``n`` more vectors about ``mean``, whose own scatter was added."""
        total = self.n + n
        apart = mean - self.mean
        if self.n:
            self.update(apart * math.sqrt(self.n * n / total))
        self.mean = self.mean + apart * (n / total)
        self.n = total

    def add(self, block: np.ndarray) -> None:
        """A block of vectors, centred about their own mean."""
        mean = block.mean(axis=0)
        centred = block - mean
        if len(centred) > centred.shape[1]:
            centred = np.linalg.qr(centred, mode="r")
        if len(block) > 1:
            for v in centred:
                self.update(v)
        self._shift(len(block), mean)

    def merge(self, other: Spectrum) -> None:
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.update(vector * math.sqrt(value))
        if other.n:
            self._shift(other.n, other.mean)


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, ascending, and eigenvectors after ``v v^T`` is added."""
    z = vectors.T @ v
    size = float(z @ z)
    if size == 0.0:
        return values, vectors
    tolerance = 8 * _EPS * max(float(values[-1]), size)
    active = np.abs(z) * math.sqrt(size) > tolerance
    if active.sum() > 1:
        vectors = _rotate_equal(values, vectors, z, active, tolerance)
    at = np.flatnonzero(active)
    if not len(at):
        return values, vectors
    moved, mixing = _secular(values[at], z[at])
    values, vectors = values.copy(), vectors.copy()
    values[at] = moved
    vectors[:, at] = vectors[:, at] @ mixing
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def _rotate_equal(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, active: np.ndarray, tolerance: float) -> np.ndarray:
    """Of neighbours with equal values, turn the update into the last one; the others are at rest."""
    at = np.flatnonzero(active)
    close = np.flatnonzero(np.diff(values[at]) <= tolerance)
    if not len(close):
        return vectors
    vectors = vectors.copy()
    for k in close:
        i, j = at[k], at[k + 1]
        length = math.hypot(z[i], z[j])
        c, s = z[j] / length, z[i] / length
        vectors[:, i], vectors[:, j] = c * vectors[:, i] - s * vectors[:, j], s * vectors[:, i] + c * vectors[:, j]
        z[i], z[j] = 0.0, length
        active[i] = False
    return vectors


def _secular(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(z_j^2 / (d_j - x)) = 0`` and the eigenvectors in the basis of ``d``.

    Each root is sought as a distance from the nearer of its two poles, so that it keeps its digits
    where it lies close to one. A step replaces the two sums left and right of the root by one pole
    each that agrees in value and slope; a step that leaves the bracket is halved.
    """
    k = len(d)
    squares = z * z
    upper = np.append(d[1:], d[-1] + squares.sum())
    middle = (d + upper) / 2
    gap = upper - d
    rows = np.arange(k)
    left = rows[None, :] <= rows[:, None]

    def split(delta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        terms = squares[None, :] / delta
        slopes = terms / delta
        psi, phi = np.where(left, terms, 0.0), np.where(left, 0.0, terms)
        dpsi, dphi = np.where(left, slopes, 0.0), np.where(left, 0.0, slopes)
        return psi.sum(axis=1), phi.sum(axis=1), dpsi.sum(axis=1), dphi.sum(axis=1)

    psi, phi, _, _ = split(d[None, :] - middle[:, None])
    near_left = (1 + psi + phi >= 0) | (rows == k - 1)
    origin = np.where(near_left, d, upper)
    poles = d[None, :] - origin[:, None]
    # The root's distance from its origin lies between these two.
    low = np.where(near_left, 0.0, -gap / 2)
    high = np.where(near_left, np.where(rows == k - 1, gap, gap / 2), 0.0)
    lower_pole, upper_pole = d - origin, upper - origin
    x = (low + high) / 2
    with np.errstate(all="ignore"):
        for _ in range(80):
            psi, phi, dpsi, dphi = split(poles - x[:, None])
            f = 1 + psi + phi
            done = np.abs(f) <= 4 * _EPS * k * (1 + np.abs(psi) + np.abs(phi))
            low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
            done |= (high - low) <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high))
            if done.all():
                break
            a1, a2 = lower_pole - x, upper_pole - x
            slope = dpsi + dphi
            a = (a1 + a2) * f - a1 * a2 * slope
            b = a1 * a2 * f
            c = f - a1 * dpsi - a2 * dphi
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * c))
            following = x + step
            inside = np.isfinite(following) & (following > low) & (following < high)
            x = np.where(done, x, np.where(inside, following, (low + high) / 2))
    x = np.where(x == 0.0, np.where(near_left, np.finfo(float).tiny, -np.finfo(float).tiny), x)
    # d_j minus root i, exact where they are close.
    apart = poles - x[:, None]
    between = d[:, None] - d[None, :]
    np.fill_diagonal(between, 1.0)
    # The update that has these roots exactly: products over the roots, each with its own pole.
    ratio = apart / between.T
    exact = np.abs(np.prod(ratio, axis=0))
    fitted = np.sqrt(exact) * np.where(z < 0, -1.0, 1.0)
    mixing = fitted[:, None] / apart.T
    mixing /= np.linalg.norm(mixing, axis=0)
    return origin + x, mixing


# Rows in and out.


def usable(vector: str = "embedding") -> Column:
    """Not null and finite in every component."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(x.isNotNull() & ~bad, F.lit(False))


def whole_numbers(entries: np.ndarray, scale: int, shift: int) -> np.ndarray:
    return np.clip(np.floor(scale * entries), -_LARGEST, _LARGEST).astype(np.int64) + shift


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _row(part: int, spectrum: Spectrum, sums: list[int]) -> dict[str, object]:
    return {
        "part": part,
        "n": spectrum.n,
        "mean": spectrum.mean.tolist(),
        "values": spectrum.values.tolist(),
        "vectors": spectrum.vectors.tobytes(),
        "sums": [str(s) for s in sums],
    }


def _spectrum(row: object) -> Spectrum:
    out = Spectrum(len(row.mean))
    out.n, out.mean, out.values = int(row.n), np.array(row.mean), np.array(row.values)
    out.vectors = np.frombuffer(row.vectors).reshape(len(row.mean), -1)
    return out


def task_spectra(rows: DataFrame, dimensions: int, block: int) -> DataFrame:
    """One spectrum for each task, with the exact sums of its vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        spectrum, sums = Spectrum(dimensions), [0] * dimensions
        held, n = [], 0

        def fold() -> None:
            whole = np.concatenate(held)
            for at in range(0, len(whole), block):
                spectrum.add(whole[at : at + block].astype(np.float64))

        for batch in batches:
            x = _matrix(batch.column("x"), dimensions)
            held.append(x)
            n += len(x)
            sums = [a + int(b) for a, b in zip(sums, x.sum(axis=0), strict=True)]
            if n >= block:
                fold()
                held, n = [], 0
        if n:
            fold()
        if spectrum.n:
            out = pd.DataFrame([_row(TaskContext.get().partitionId(), spectrum, sums)])
            yield from pa.Table.from_pandas(out, preserve_index=False).to_batches()

    return written(rows.select("x").mapInArrow(run, _SPECTRUM), "spectra")


def merged(spectra: DataFrame, fan: int) -> tuple[Spectrum, list[int]]:
    """All spectra as one, ``fan`` to a task in each round."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        total, sums = None, None
        for row in frame.sort_values("part").itertuples():
            own = [int(s) for s in row.sums]
            if total is None:
                total, sums = _spectrum(row), own
            else:
                total.merge(_spectrum(row))
                sums = [a + b for a, b in zip(sums, own, strict=True)]
        return pd.DataFrame([_row(int(frame["part"].min()), total, sums)])

    while (count := spectra.count()) > 1:
        number = F.expr("row_number() OVER (ORDER BY part) - 1")
        grouped = spectra.withColumn("g", (number / fan).cast("int")).groupBy("g")
        spectra = written(grouped.applyInPandas(merge, _SPECTRUM), f"spectra-of-{count}")
    row = spectra.first()
    return _spectrum(row), [int(s) for s in row.sums]


def _summed(products: DataFrame, size: int) -> np.ndarray:
    """The sum of the tasks' symmetric matrices, cell by cell."""
    out = np.zeros((size, size))
    for cell in products.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[cell.i, cell.j] = out[cell.j, cell.i] = cell.value
    return out


def _products(rows: DataFrame, columns_of: Callable[[pa.Array], np.ndarray], size: int) -> np.ndarray:
    """The sum over all rows of the products of every two of ``columns_of(x)``, rows by ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            y = columns_of(batch.column("x"))
            total += y.T @ y
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "value"]
        )

    return _summed(rows.select("x").mapInArrow(run, "i int, j int, value double"), size)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums``, exact: in 64 bits where that is enough."""
    if n * (2 * _LARGEST) < 1 << 62 or (len(x) and n * int(np.abs(x).max()) < 1 << 61):
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _deviation(apart: np.ndarray) -> list[int | None]:
    """The exact sum of squares of each row; null beyond a long."""
    if not len(apart):
        return []
    most = int(np.abs(apart).max())
    if most * most * apart.shape[1] < 1 << 63:
        whole = apart.astype(np.int64)
        return (whole * whole).sum(axis=1).tolist()
    wide = apart.astype(object)
    out = (wide * wide).sum(axis=1).tolist()
    return [s if s < 1 << 63 else None for s in out]


def whiten(
    rows: DataFrame, keep: int = 8, scale: int = 1024, shift: int = 100_000, block: int = 2048, fan: int = 8
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    finite = rows.where(usable()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda v: v.cast("double")).alias("embedding"),
    )
    sizes = finite.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None or sizes["d"] == 0:
        return rows.sparkSession.createDataFrame([], schema)
    d = sizes["d"]

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(_matrix(batch.column("embedding"), d), scale, shift)
            offsets = pa.array(np.arange(0, len(x) * d + 1, d, dtype=np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists], ["vec_id", "x"])

    whole = finite.where(F.size("embedding") == d).mapInArrow(prepare, "vec_id long, x array<long>")
    whole = written(whole, "whitening-rows")
    spectrum, totals = merged(task_spectra(whole, d, block), fan)
    n, sums = spectrum.n, np.array(totals, dtype=object)
    basis = np.linalg.qr(spectrum.vectors[:, ::-1])[0]

    def projected(directions: np.ndarray) -> Callable[[pa.Array], np.ndarray]:
        def columns(column: pa.Array) -> np.ndarray:
            apart = _centred(_matrix(column, d), n, sums)
            return (apart.astype(np.float64) / n) @ directions

        return columns

    covariance = _products(whole, projected(basis), d) / n
    values, mixing = np.linalg.eigh(covariance)
    values, components = values[::-1], (basis @ mixing)[:, ::-1]
    shown = min(keep, d)
    values_shown, components = values[:shown], components[:, :shown]
    spread = values_shown > max(values[0], 0.0) * d * 16 * _EPS
    trace = float(np.trace(covariance))
    explained = np.maximum(values_shown, 0.0) / trace if trace > 0 else np.zeros(shown)
    directions = components[:, spread] / np.sqrt(values_shown[spread])
    lasting = directions.shape[1]
    error = 0.0
    if lasting:
        measured = _products(whole, projected(directions), lasting) / n
        error = float(np.abs(measured - np.eye(lasting)).max())

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place_of = np.cumsum(spread) - 1
        for batch in batches:
            ids, x = batch.column("vec_id"), _matrix(batch.column("x"), d)
            apart = _centred(x, n, sums)
            whitened = (apart.astype(np.float64) / n) @ directions
            deviation = pa.array(_deviation(apart), pa.int64())
            for c in range(shown):
                own = pa.array(whitened[:, place_of[c]]) if spread[c] else pa.nulls(len(x), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.full(len(x), c + 1, dtype=np.int32)),
                        pa.array(np.full(len(x), n, dtype=np.int64)),
                        deviation,
                        own,
                        pa.array(np.full(len(x), explained[c])),
                        pa.array(np.full(len(x), error)),
                    ],
                    [f.split()[0] for f in schema.split(", ")],
                )

    return whole.mapInArrow(out, schema)

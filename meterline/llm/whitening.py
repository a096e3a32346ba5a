"""Whitening of vectors with a covariance from polarisation.

Components c become whole numbers x = floor(1024 * c) + 100000. With n vectors and the sums S, the centred value of an
entry is n * x - S, a whole number too. For every dimension, and for the sum of every two dimensions, the squares of the
centred values are added up exactly: sum of (a + b)^2 less that of a^2 and of b^2 is twice the sum of a * b, so the
differences give all cross-covariances without a product of two different values ever being formed. The matrix is
assembled on the driver, which holds only dimensions by dimensions values, and split into eigenvectors there.

Every sum over rows is taken in whole numbers: a task adds squares in two halves of 26 bits (or in unbounded whole numbers,
if values are too large for that) and Spark adds what the tasks found. So no result depends on the order of rows.

Defined results: vectors that are null, empty, or hold null or non-finite entries take no part; entries beyond
2^62 / 1024 count as that; vectors of different dimension are whitened apart, each dimension with its own n; a component
without variance has a null in ``whitened`` and takes no part in the identity error; ``explained`` is null where there is
no variance at all; a deviation beyond 38 digits is null; repeated rows and null ids count and are returned row by row;
an empty table gives no rows. Extra columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 1024.0
SHIFT = 100_000
KEEP = 8
#: Centred values below this are squared in halves of HALF bits, whose sums over ROWS rows stay within 64 bits.
_SMALL = 1 << 51
_HALF = 26
_ROWS = 512
_DIGITS = 10**38
_LARGEST = 2.0**62
_LIMB = 1 << 60


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, places in the batch, x) of the usable vectors of each dimension."""
    column = batch["v"]
    sizes = np.where(column.is_valid(), column.value_lengths().fill_null(0), 0)
    starts = np.asarray(column.offsets)[:-1].astype(np.int64)
    entries = column.values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(sizes == dim)
        c = entries[starts[at][:, None] + np.arange(dim)]
        usable = np.isfinite(c).all(axis=1)
        if usable.any():
            with np.errstate(over="ignore"):
                scaled = np.floor(c[usable] * SCALE)
            yield dim, at[usable], np.clip(scaled, -_LARGEST, _LARGEST).astype(np.int64) + SHIFT


def _limbs(value: int) -> tuple[int, int]:
    return value // _LIMB, value % _LIMB


@dataclass(frozen=True)
class Sums:
    """Of one dimension: the number of vectors and the sums of x."""
    n: int
    sums: list[int]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, as 64-bit or unbounded whole numbers."""
        kind = np.int64 if max(int(x.max()), -int(x.min())) * self.n + max(map(abs, self.sums)) < _SMALL else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)


def _total(partials: DataFrame) -> list[tuple[int, int, int, int]]:
    """(dim, i, j, sum) of partial sums in two limbs."""
    rows = partials.groupBy("dim", "i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return [(r["dim"], r["i"], r["j"], int(r["high"]) * _LIMB + int(r["low"])) for r in rows]


_PARTIAL = "dim int, i int, j int, high decimal(38,0), low decimal(38,0)"


def _partial(found: dict[tuple[int, int, int], int]) -> pa.RecordBatch:
    keys, limbs = list(found), [_limbs(v) for v in found.values()]
    columns = [pa.array([k[c] for k in keys], pa.int32()) for c in range(3)] + [pa.array([x[c] for x in limbs], pa.decimal128(38, 0)) for c in range(2)]
    return pa.RecordBatch.from_arrays(columns, names=["dim", "i", "j", "high", "low"])


def _sums(rows: DataFrame) -> dict[int, Sums]:
    """One pass; the number of vectors is in place -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for dim, at, x in _vectors(batch):
                for i, value in enumerate([len(at), *_exact_sums(x)], -1):
                    found[dim, i, 0] = found.get((dim, i, 0), 0) + value
        yield _partial(found)

    by = {(dim, i): value for dim, i, _, value in _total(rows.mapInArrow(run, _PARTIAL))}
    return {dim: Sums(n, [by[dim, k] for k in range(dim)]) for (dim, i), n in by.items() if i == -1}


def _exact_sums(x: np.ndarray) -> list[int]:
    top = max(int(x.max()), -int(x.min()))
    return (x if top * len(x) < 1 << 63 else x.astype(object)).sum(axis=0).tolist()


def _squares(z: np.ndarray) -> list[int]:
    """Exact sums of the squares of each column."""
    if z.dtype == object:
        return (z * z).sum(axis=0).tolist()
    total = [0] * z.shape[1]
    for at in range(0, len(z), _ROWS):
        part = z[at:at + _ROWS]
        high, low = part >> _HALF, part & ((1 << _HALF) - 1)
        parts = (np.einsum("ij,ij->j", a, b).tolist() for a, b in ((high, high), (high, low), (low, low)))
        total = [t + (hh << 2 * _HALF) + (hl << _HALF + 1) + ll for t, hh, hl, ll in zip(total, *parts, strict=True)]
    return total


def square_sums(z: np.ndarray) -> dict[tuple[int, int], int]:
    """Sums of squares of every column (i, i) and of the sum of every two columns (i, j)."""
    found = {}
    for i in range(z.shape[1]):
        both = z[:, i:] + z[:, i:i + 1]
        both[:, 0] = z[:, i]
        found |= {(i, i + k): s for k, s in enumerate(_squares(both))}
    return found


def _square_sums(rows: DataFrame, sums: dict[int, Sums]) -> list[tuple[int, int, int, int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for dim, at, x in _vectors(batch):
                for (i, j), value in square_sums(sums[dim].centred(x)).items():
                    found[dim, i, j] = found.get((dim, i, j), 0) + value
        yield _partial(found)

    return _total(rows.mapInArrow(run, _PARTIAL))


@dataclass(frozen=True)
class Whitener:
    """Of one dimension. Column k of ``axes`` projects x - S/n on component k over the root of its eigenvalue; NaN where
    there is no variance."""
    sums: Sums
    axes: np.ndarray
    explained: list[float | None]

    def project(self, z: np.ndarray) -> np.ndarray:
        return (z / self.sums.n).astype(float) @ self.axes


def covariance(sums: Sums, squares: dict[tuple[int, int], int]) -> np.ndarray:
    """From the exact sums; differences are taken before anything is rounded."""
    dim, cube = len(sums.sums), sums.n**3
    v = np.zeros((dim, dim))
    for (i, j), both in squares.items():
        v[i, j] = v[j, i] = both / cube if i == j else (both - squares[i, i] - squares[j, j]) / (2 * cube)
    return v


def whitener(sums: Sums, squares: dict[tuple[int, int], int], keep: int = KEEP) -> Whitener:
    values, vectors = np.linalg.eigh(covariance(sums, squares))
    values, vectors = values[::-1][:keep], vectors[:, ::-1][:, :keep]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    trace = sum(squares[i, i] for i in range(len(sums.sums))) / sums.n**3
    real = values > len(sums.sums) * np.finfo(float).eps * trace
    axes = np.where(real, vectors / np.sqrt(np.where(real, values, 1.0)), np.nan)
    return Whitener(sums, axes, [max(0.0, float(e)) / trace if trace else None for e in values])


def _products(rows: DataFrame, models: dict[int, Whitener]) -> dict[int, float]:
    """Largest difference of the whitened rows' covariance from the identity, by dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _vectors(batch):
                y = models[dim].project(models[dim].sums.centred(x))
                y = np.c_[np.ones(len(y)), y]  # the first row has the sums
                found[dim] = found.get(dim, 0.0) + y.T @ y
        keys = [(d, i, j) for d, m in found.items() for i in range(len(m)) for j in range(i, len(m))]
        yield pa.RecordBatch.from_arrays([pa.array([k[c] for k in keys], pa.int32()) for c in range(3)] + [pa.array([float(found[d][i, j]) for d, i, j in keys], pa.float64())], names=["dim", "i", "j", "s"])

    errors: dict[int, float] = {}
    got = {(r["dim"], r["i"], r["j"]): r["s"] for r in rows.mapInArrow(run, "dim int, i int, j int, s double").groupBy("dim", "i", "j").agg(F.sum("s").alias("s")).collect()}
    for (dim, i, j), s in got.items():
        if i and not np.isnan(s):
            n = models[dim].sums.n
            gap = abs(s / n - got[dim, 0, i] / n * got[dim, 0, j] / n - (i == j))
            errors[dim] = max(errors.get(dim, 0.0), float(gap))
    return errors


_WHITE = "id bigint, dim int, n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"


def whiten(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", keep: int = KEEP) -> DataFrame:
    """(id, dim, n, deviation, whitened, explained, identity_error): one row per usable vector. ``whitened`` and ``explained``
    hold up to ``keep`` components by falling eigenvalue."""
    rows = table.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    only = rows.select("v")
    sums = _sums(only)
    squares: dict[int, dict[tuple[int, int], int]] = {dim: {} for dim in sums}
    for dim, i, j, value in _square_sums(only, sums):
        squares[dim][i, j] = value
    models = {dim: whitener(s, squares[dim], keep) for dim, s in sums.items()}
    errors = _products(only, models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["id"]
            for dim, at, x in _vectors(batch):
                model = models[dim]
                z = model.sums.centred(x)
                y = model.project(z)
                spread = _squares(z.T)
                white = pa.array([[None if v != v else v for v in row] for row in y.tolist()], pa.list_(pa.float64()))
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at)), pa.array([dim] * n, pa.int32()), pa.array([model.sums.n] * n, pa.int64()),
                     pa.array([d if d < _DIGITS else None for d in spread], pa.decimal128(38, 0)), white,
                     pa.array([model.explained] * n, pa.list_(pa.float64())), pa.array([errors.get(dim)] * n, pa.float64())],
                    names=[c.split()[0] for c in _WHITE.split(", ")])

    return rows.mapInArrow(run, _WHITE)


def components(whitened: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from 1."""
    each = whitened.select("id", "dim", "n", "deviation", F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "c"), "identity_error")
    return each.select("id", (F.col("k") + 1).cast("int").alias("component"), "dim", "n", "deviation", "c.whitened", "c.explained", "identity_error")

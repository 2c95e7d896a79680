"""Embedding whitening with components found by FEAST contour integration.

Vectors become integers, x = floor(64 * c) + 1000000, so equal vectors, counts
and sums are exact.  Distinct vectors are summed and then centred and
multiplied, both inside tasks; only sums of one matrix reach the driver (its
side is the length of a vector, however many rows there are).

The leading eigenpairs of that matrix V come from slices of its spectrum.
Inertia counts (signs of the pivots of a symmetric factorisation of V - s) tell
how many eigenvalues lie above any s and cut the spectrum from the top into
intervals with few of them.  For each interval, complex shifted systems
(z - V) Q = Y are solved at quadrature points z of a circle around it; their
weighted sum projects Y onto the interval's eigenvectors, Rayleigh-Ritz
extracts the pairs, and the count of pairs must equal the interval's inertia
count, or the subspace grows and the integration goes on.

Defined results: rows whose vector is null or holds a null, a non-finite entry
or one of 2^46 or more in size are dropped; vectors of another length are
whitened among themselves; eigenvalues that are zero in double precision have
no component, so equal vectors alone give no rows; a row may lack an id, and
repeated rows are repeated in the result.  ``deviation`` holds an exact sum of
squares up to 2^63 - 1; beyond that the value is deviation_high * 2^63 +
deviation.  Other columns are not read."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import bounded_batches, table, written

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
#: Entries of this size or more have no exact x.
TOO_LARGE = float(1 << 46)
#: Vectors of an Arrow batch.
ROWS = 512
#: Eigenvalues of an interval, at most, unless they cannot be told apart.
SLICE = 8
#: Quadrature points on the half circle; contours before a subspace grows.
POINTS, ROUNDS = 8, 12
EPS = float(np.finfo(np.float64).eps)

ROW = "vec_id long, component int, n long, deviation long, deviation_high long, whitened double, explained double, identity_error double"


def eigenvalues_above(v: np.ndarray, shift: float) -> int:
    """Inertia: how many eigenvalues of the symmetric ``v`` exceed ``shift``,
    by a factorisation with pivots of one or two rows."""
    a, count = v - shift * np.eye(len(v)), 0
    while len(a):
        size = np.abs(a)
        p = int(np.argmax(np.diag(size)))
        apart = size - np.diag(np.diag(size))
        q, r = np.unravel_index(int(np.argmax(apart)), a.shape)
        if apart[q, r] == 0:
            return count + int((np.diag(a) > 0).sum())
        # (1 + sqrt(17)) / 8 bounds the growth of what remains.
        pivot = [p] if size[p, p] >= (1 + 17**0.5) / 8 * apart[q, r] else [int(q), int(r)]
        rest = np.setdiff1d(np.arange(len(a)), pivot)
        block, side = a[np.ix_(pivot, pivot)], a[np.ix_(rest, pivot)]
        count += int((np.linalg.eigvalsh(block) > 0).sum())
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        a = (a + a.T) / 2
    return count


def top_intervals(v: np.ndarray, want: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues in it), from the top until ``want`` are held."""
    high = float(np.abs(v).sum(axis=1).max()) * (1 + len(v) * EPS)
    floor = len(v) * EPS * high
    rank = eigenvalues_above(v, floor) if high > 0 else 0
    todo, out, held = [(floor, high, rank, 0)], [], 0
    while todo and held < min(want, rank):
        low, high, upto, over = todo.pop()  # eigenvalues above low, and above high
        count = upto - over
        if count == 0:
            continue
        middle = (low * high) ** 0.5 if high > 4 * low else (low + high) / 2
        if count <= SLICE or not low * (1 + 64 * EPS) < middle < high * (1 - 64 * EPS):
            out.append((low, high, count))
            held += count
            continue
        inner = eigenvalues_above(v, middle)
        todo += [(low, middle, upto, inner), (middle, high, inner, over)]
    return out


def contour_projection(v: np.ndarray, low: float, high: float, y: np.ndarray) -> np.ndarray:
    """The part of ``y`` in eigenvectors of (low, high]: quadrature over the
    upper half of a circle (the lower one is its conjugate)."""
    at, weight = np.polynomial.legendre.leggauss(POINTS)
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(y)
    for t, w in zip(at.tolist(), weight.tolist(), strict=True):
        turn = np.exp(1j * np.pi / 2 * (1 + t))
        out += w / 2 * np.real(radius * turn * np.linalg.solve((centre + radius * turn) * np.eye(len(v)) - v, y))
    return out


def rayleigh_ritz(v: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    q = np.linalg.qr(q)[0]
    small = q.T @ v @ q
    values, turned = np.linalg.eigh((small + small.T) / 2)
    return values, q @ turned


def interval_pairs(v: np.ndarray, low: float, high: float, count: int) -> np.ndarray:
    """Eigenvectors of the ``count`` eigenvalues in (low, high]."""
    draw = np.random.default_rng(1)
    width = min(len(v), count + max(4, count // 2))
    close = 8 * EPS * len(v) ** 0.5 * float(np.abs(v).sum(axis=1).max())
    y = draw.normal(size=(len(v), width))
    while True:
        for _ in range(ROUNDS):
            values, y = rayleigh_ritz(v, contour_projection(v, low, high, y))
            inside = (values > low) & (values <= high)
            if inside.sum() == count and np.abs(v @ y[:, inside] - y[:, inside] * values[inside]).max() <= close:
                return y[:, inside]
            if width == len(v):
                # The whole space: an eigenvalue lies on the border within rounding.
                nearest = np.argsort(np.maximum(low - values, values - high), kind="stable")[:count]
                return y[:, nearest]
        width = min(len(v), 2 * width)
        y = np.hstack([y, draw.normal(size=(len(v), width - y.shape[1]))])


def leading_pairs(v: np.ndarray, want: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a covariance."""
    found = [interval_pairs(v, *span) for span in top_intervals(v, want)]
    if not found:
        return np.zeros(0), np.zeros((len(v), 0))
    values, vectors = rayleigh_ritz(v, np.hstack(found))
    return values[::-1][:want], vectors[:, ::-1][:, :want]


@dataclass
class Centre:
    """The exact mean S / n of integer vectors, as a whole part and a rest."""

    n: int
    whole: np.ndarray  # integers next to the mean
    rest: list[int]  # S - n * whole
    part: np.ndarray  # rest / n

    @classmethod
    def of(cls, n: int, sums: list[int]) -> Centre:
        whole = [round(Fraction(s, n)) for s in sums]
        rest = [s - n * w for s, w in zip(sums, whole, strict=True)]
        return cls(n, np.array(whole, np.int64), rest, np.array([r / n for r in rest]))

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.part

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of (n * x - S)^2, exact."""
        off = x - self.whole
        largest = self.n * (int(np.abs(off).max(initial=0)) + 1)
        if largest * largest * max(1, x.shape[1]) < 1 << 63:
            y = self.n * off - np.array(self.rest, np.int64)
            return (y * y).sum(axis=1).tolist()
        return [sum((self.n * o - r) ** 2 for o, r in zip(row, self.rest, strict=True)) for row in off.tolist()]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _summed(parts: DataFrame, size: int) -> np.ndarray:
    """Sums by place over all tasks: ``size`` numbers reach the driver."""
    total = parts.select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros(size)
    out[total.column("at").to_numpy()] = total.column("x").to_numpy()
    return out


def _centre(fit: DataFrame, dim: int) -> Centre:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, [0] * dim, [0] * dim
        for b in batches:
            x = _matrix(b.column(0), dim)  # split, so that no sum of a batch overflows
            n += len(x)
            high = [a + c for a, c in zip(high, (x >> 32).sum(axis=0).tolist(), strict=True)]
            low = [a + c for a, c in zip(low, (x & 0xFFFFFFFF).sum(axis=0).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([[str((h << 32) + w) for h, w in zip(high, low, strict=True)]], pa.list_(pa.string()))], ["n", "sums"])

    parts = fit.mapInArrow(run, "n long, sums array<string>")
    total = parts.select("n", F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("at").collect()
    return Centre.of(total[0]["n"], [int(r["s"]) for r in total])


def _products(fit: DataFrame, dim: int, centre: Centre, turn: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the fit list, or of what ``turn`` makes of it."""
    size = dim if turn is None else turn.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for b in batches:
            c = centre.centred(_matrix(b.column(0), dim))
            c = c if turn is None else c @ turn
            total += c.T @ c
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["sums"])

    return _summed(fit.mapInArrow(run, "sums array<double>"), size * size).reshape(size, size) / centre.n


def _whitened(rows: DataFrame, dim: int, centre: Centre, turn: np.ndarray, explained: list[float], error: float) -> DataFrame:
    k, low = turn.shape[1], (1 << 63) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1), dim)
            exact = centre.deviations(x)
            each = np.repeat(np.arange(len(x)), k)
            cols = [
                b.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), centre.n, np.int64)),
                pa.array([d & low for d in exact], pa.int64()).take(pa.array(each)),
                pa.array([d >> 63 for d in exact], pa.int64()).take(pa.array(each)),
                pa.array((centre.centred(x) @ turn).ravel()),
                pa.array(np.tile(np.array(explained), len(x))),
                pa.array(np.full(len(each), error)),
            ]
            yield pa.RecordBatch.from_arrays(cols, [f.split()[0] for f in ROW.split(", ")])

    return rows.select("vec_id", "x").mapInArrow(run, ROW)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component."""
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = F.coalesce(F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < TOO_LARGE)), F.lit(False)) & (F.size("v") > 0)
    rows = source.where(sound).select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + OFFSET).alias("x"))
    rows = rows.withColumn("dim", F.size("x"))
    fit = written(rows.select("dim", "x").distinct(), "fit")
    out = None
    for dim in sorted(r[0] for r in fit.select("dim").distinct().collect()):  # lengths of vectors: one, as a rule
        mine = fit.where(F.col("dim") == dim).select("x")
        centre = _centre(mine, dim)
        v = _products(mine, dim, centre)
        values, axes = leading_pairs(v, components)
        if not len(values):
            continue
        turn = axes / np.sqrt(values)
        error = float(np.abs(_products(mine, dim, centre, turn) - np.eye(len(values))).max())
        part = _whitened(rows.where(F.col("dim") == dim), dim, centre, turn, (values / np.trace(v)).tolist(), error)
        out = part if out is None else out.unionByName(part)
    return vectors.sparkSession.createDataFrame([], ROW) if out is None else out


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading components of all embeddings."""
    bounded_batches(spark, ROWS)
    return whiten(table(spark, sf_dir, "embeddings"))

"""Embedding whitening by incremental eigendecomposition.

Every partition keeps (n, sums, spectrum, basis) of the centred scatter of its
rows and takes each row in by one symmetric rank-one update: the new spectrum
solves the secular equation of ``diag(d) + z z'``, after deflation of tiny
components of ``z`` and of nearly equal eigenvalues; the eigenvectors come from
the weights for which the computed roots are exact, so they stay orthogonal.
States are combined, ``FAN_IN`` a task and level by level, by rank-one updates
with the scaled axes of the other spectrum and with the difference of the means.  A last
pass over the rows takes the covariance in the combined basis (Rayleigh-Ritz)
and turns the basis by its eigenvectors, which removes what rounding was left.

A state holds one square matrix of the dimension, whatever the number of rows.

Defined cases: rows whose vector is null or holds a null or non-finite entry
take no part; shorter vectors count as padded with zeros to the longest one;
null and repeated ids are rows like others; without rows, or with empty vectors
only, the result is empty; components without variance get null ``whitened``
and stay out of ``identity_error``; a ``deviation`` beyond a long is null.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiremap.llm.common import stored

#: Entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
FAN_IN = 8
EPS = float(np.finfo(float).eps)
STATE = "part long, n long, sums binary, values binary, basis binary"


def secular_roots(d: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The matrix of ``d[j] - root[i]`` (line j, column i) of ``1 + sum z[j]^2 / (d[j] - x) = 0``.

    ``d`` ascends strictly, no ``z`` is zero.  Root i lies between d[i] and
    d[i + 1] (the last within |z|^2 above); it is sought relative to the nearer
    one, so that the differences keep their relative accuracy.
    """
    k, z2 = len(d), z * z
    upper = np.append(d[1:], d[-1] + z2.sum())
    half = (upper - d) / 2
    # Left half or right half: the sign at the midpoint (the sum rises between poles).
    middle = 1 + (z2[:, None] / ((d[:, None] - d) - half)).sum(0)
    right = middle < 0
    right[-1] = False
    origin = np.where(right, upper, d)
    gap = d[:, None] - origin
    low, high = np.where(right, -half, 0.0), np.where(right, 0.0, half)
    if middle[-1] < 0:
        low[-1], high[-1] = half[-1], 2 * half[-1]
    x = (low + high) / 2
    below = np.tri(k).T  # line j <= column i: poles left of root i
    near = np.arange(k)
    next_gap = np.append(gap[near[1:], near[:-1]], upper[-1] - origin[-1])
    open_ = np.ones(k, bool)
    for _ in range(80):
        delta = gap - x
        with np.errstate(all="ignore"):
            term = z2[:, None] / delta
            slopes = term / delta
            total, psi = term.sum(0), np.einsum("ji,ji->i", term, below)
            slope, dpsi = slopes.sum(0), np.einsum("ji,ji->i", slopes, below)
            f, size = 1 + total, 1 + total - 2 * psi
            low, high = np.where(open_ & (f < 0), x, low), np.where(open_ & (f > 0), x, high)
            # The sum as two poles and a constant that agree with it in value and slope.
            a, b = delta[near, near], next_gap - x
            c = f - a * dpsi - b * (slope - dpsi)
            p, q = (a + b) * f - a * b * slope, a * b * f
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            fresh = x + step
        fresh = np.where((fresh > low) & (fresh < high), fresh, (low + high) / 2)
        open_ &= (np.abs(f) > k * EPS * size) & (fresh != x)
        if not open_.any():
            break
        x = np.where(open_, fresh, x)
    return gap - x


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and vectors (columns) of ``basis diag(values) basis' + vector vector'``."""
    z = vector @ basis
    norm2 = float(z @ z)
    if norm2 == 0:
        return values, basis
    tol = 8 * EPS * max(float(values[-1]), norm2)
    size = float(np.sqrt(norm2))
    keep = np.flatnonzero(np.abs(z) * size > tol)
    values, basis = values.copy(), basis.copy()
    if len(keep) > 1 and _close(values[keep], z[keep], tol).any():
        # Nearly equal eigenvalues: a rotation moves both weights into one of them.
        last, kept = keep[0], []
        for i in keep[1:]:
            r = float(np.hypot(z[last], z[i]))
            c, s, t = z[i] / r, z[last] / r, values[i] - values[last]
            if abs(t * c * s) <= tol:
                z[i], z[last] = r, 0.0
                basis[:, [last, i]] = np.stack((c * basis[:, last] - s * basis[:, i],
                                                s * basis[:, last] + c * basis[:, i]), 1)
                values[last], values[i] = values[last] * c * c + values[i] * s * s, \
                    values[last] * s * s + values[i] * c * c
            else:
                kept.append(last)
            last = i
        keep = np.array([*kept, last])
        keep = keep[np.argsort(values[keep], kind="stable")]
    d, w = values[keep], z[keep]
    if len(keep) == 1:
        values[keep] += w * w
    elif len(keep):
        delta = secular_roots(d, w)
        apart = d[:, None] - d
        np.fill_diagonal(apart, 1.0)
        # The weights that have exactly these roots.
        w = np.copysign(np.sqrt(np.abs(np.prod(delta / apart, axis=1))), w)
        turn = w[:, None] / delta
        turn /= np.sqrt((turn * turn).sum(0))
        values[keep] = d - np.diagonal(delta)
        basis[:, keep] = basis[:, keep] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


def _close(d: np.ndarray, z: np.ndarray, tol: float) -> np.ndarray:
    r2 = z[1:] ** 2 + z[:-1] ** 2
    return np.abs(np.diff(d) * z[1:] * z[:-1]) <= tol * r2


@dataclass
class Spectrum:
    """Count, exact sums and eigendecomposition of the centred scatter of some rows."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim, np.int64), np.zeros(dim), np.eye(dim))

    def add(self, rows: np.ndarray) -> None:
        for row in rows:
            if self.n:
                away = row - self.sums / self.n
                self.values, self.basis = rank_one(self.values, self.basis, away * np.sqrt(self.n / (self.n + 1)))
            self.sums = self.sums + row
            self.n += 1

    def merge(self, other: Spectrum) -> None:
        if self.n and other.n:
            away = other.sums / other.n - self.sums / self.n
            axes = (other.basis * np.sqrt(np.maximum(other.values, 0))).T
            for v in [*axes, away * np.sqrt(self.n * other.n / (self.n + other.n))]:
                self.values, self.basis = rank_one(self.values, self.basis, v)
        elif other.n:
            self.values, self.basis = other.values, other.basis
        self.n, self.sums = self.n + other.n, self.sums + other.sums

    def batch(self, part: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int64()), "n": pa.array([self.n], pa.int64()),
            "sums": pa.array([self.sums.astype("<i8").tobytes()], pa.binary()),
            "values": pa.array([self.values.astype("<f8").tobytes()], pa.binary()),
            "basis": pa.array([self.basis.astype("<f8").tobytes()], pa.binary())})

    @classmethod
    def of(cls, row: dict) -> Spectrum:
        sums = np.frombuffer(row["sums"], "<i8").astype(np.int64)
        return cls(row["n"], sums, np.frombuffer(row["values"], "<f8").copy(),
                   np.frombuffer(row["basis"], "<f8").reshape(len(sums), -1).copy())


def clean_rows(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part, as long as they are."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    out = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    return out.filter(F.col("v").isNotNull() & F.forall("v", finite))


def _whole(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """The rows of column ``v`` as longs, padded to ``dim`` entries before scaling."""
    v = batch.column("v")
    sizes = np.diff(v.offsets.to_numpy())
    out = np.zeros((len(v), dim))
    out[np.arange(dim) < sizes[:, None]] = v.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * out).astype(np.int64) + SHIFT


def spectrum(rows: DataFrame, dim: int) -> Spectrum:
    """The spectrum over all rows of ``clean_rows``."""

    def local(batches):
        state = Spectrum.empty(dim)
        for b in batches:
            state.add(_whole(b, dim))
        if state.n:
            yield state.batch(0)

    def combine(key, table):
        # At most FAN_IN states, in the order of the parts.
        states = [Spectrum.of(row) for row in table.sort_by([("n", "ascending"), ("sums", "ascending")]).to_pylist()]
        for other in states[1:]:
            states[0].merge(other)
        return pa.Table.from_batches([states[0].batch(key[0].as_py())])

    states = rows.select("v").mapInArrow(local, STATE).withColumn("part", F.spark_partition_id().cast("long"))
    states = stored(states, "spectra")
    while (parts := states.agg(F.count("*"), F.max("part")).first())[0] > 1:
        group = F.floor(F.col("part") / FAN_IN).cast("long")
        states = states.withColumn("part", group).groupBy("part").applyInArrow(combine, STATE)
        states = stored(states, "spectra")
    return Spectrum.of(states.first().asDict()) if parts[0] else Spectrum.empty(dim)


def _summed(rows: DataFrame, part, width: int) -> np.ndarray:
    """The sum over tasks of the arrays that ``part`` makes of a task's batches."""

    def run(batches):
        total = np.zeros(width)
        for b in batches:
            total += part(b)
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(width)), "x": pa.array(total)})

    sums = rows.mapInArrow(run, "i long, x double").groupBy("i").agg(F.sum("x").alias("x"))
    out = np.zeros(width)
    for r in sums.collect():  # width rows
        out[r["i"]] = r["x"]
    return out


def refine(rows: DataFrame, state: Spectrum) -> tuple[np.ndarray, np.ndarray, float]:
    """Rayleigh-Ritz in the basis of ``state``: eigenvalues (falling) and vectors of the covariance, its trace."""
    dim, mean, basis = len(state.sums), state.sums / state.n, state.basis

    def part(batch: pa.RecordBatch) -> np.ndarray:
        y = (_whole(batch, dim) - mean) @ basis
        return (y.T @ y).ravel()

    inner = _summed(rows.select("v"), part, dim * dim).reshape(dim, dim) / state.n
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    return values[::-1].copy(), (basis @ turn)[:, ::-1].copy(), float(np.trace(inner))


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of each row that takes part."""
    spark = rows.sparkSession
    names = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
             "identity_error double")
    rows = clean_rows(rows, id_col, vec_col)
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 0
    state = spectrum(rows, dim) if dim else Spectrum.empty(0)
    if not state.n:
        return spark.createDataFrame([], names)
    values, basis, trace = refine(rows, state)
    count, n = min(components, dim), state.n
    live = values[:count] > dim * EPS * max(values[0], 0.0) if trace > 0 else np.zeros(count, bool)
    axes = np.where(live, basis[:, :count] / np.sqrt(np.where(live, values[:count], 1.0)), 0.0)
    mean, sums, out = state.sums / n, state.sums, F.col

    def project(batches):
        for b in batches:
            x = _whole(b, dim)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(_deviation(x, sums, n), pa.int64()),
                 pa.FixedSizeListArray.from_arrays(pa.array(((x - mean) @ axes).ravel()), count).cast(
                     pa.list_(pa.float64()))], names=["vec_id", "deviation", "w"])

    done = stored(rows.mapInArrow(project, "vec_id long, deviation long, w array<double>"), "whitened")

    def square(batch: pa.RecordBatch) -> np.ndarray:
        w = batch.column("w").flatten().to_numpy().reshape(-1, count)
        return np.concatenate((w.sum(0), (w.T @ w).ravel()))

    total = _summed(done.select("w"), square, count + count * count) / n
    covariance = total[count:].reshape(count, count) - np.outer(total[:count], total[:count])
    error = np.abs(covariance - np.eye(count))[np.ix_(live, live)]
    fixed = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.lit(bool(live[i])).alias("live"),
                               F.lit(float(values[i] / trace) if live[i] else 0.0).alias("explained"))
                      for i in range(count)])
    pairs = F.explode(F.arrays_zip(F.col("w"), fixed.alias("c")))
    return done.select("vec_id", "deviation", pairs.alias("p")).select(
        "vec_id", out("p.c.component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.when(out("p.c.live"), out("p.w")).alias("whitened"), out("p.c.explained"),
        F.lit(float(error.max()) if error.size else 0.0).alias("identity_error"))


def _deviation(x: np.ndarray, sums: np.ndarray, n: int) -> list[int | None]:
    """The sums over dimensions of (n * x - sums)^2, exact; None beyond a long."""
    limit = (1 << 63) - 1
    # Python integers where 64 bits might overflow.
    top = int(np.abs(x).max(initial=0)) * n + int(np.abs(sums).max(initial=0))
    if top < limit and (far := np.abs(n * x - sums)).max(initial=0) < 3_000_000_000 and \
            int(far.max(initial=0)) ** 2 * x.shape[1] <= limit:
        return (far * far).sum(1).tolist()
    exact = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(1)
    return [int(v) if v <= limit else None for v in exact]

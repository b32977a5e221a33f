"""Whitening of embeddings by an incremental eigendecomposition.

Entries become whole numbers, and each distinct vector is fitted once. Every task
keeps the spectrum of what it has seen: count, exact sums, eigenvalues and axes. A
block of vectors is centred on its own mean and turned by QR into as many rows as
there are dimensions, which have the same scatter; each of these rows is one
rank-one update, and so is the distance of the block's mean from the mean so far.
An update solves the secular equation for the new eigenvalues; entries that meet
no axis are deflated, and axes of equal eigenvalue are turned until one of them
meets the update. Spectra are combined in the same way, by one update per axis, in
rounds of ``FAN`` spectra per task. Last, tasks project all fitted vectors on the
axes and a Rayleigh-Ritz step on the summed products gives the components; it is
repeated until the whitened vectors' covariance is the identity.

A spectrum's size is set by the dimension, so what tasks send and the driver holds
does not grow with the vectors.

Defined cases: vectors that are null or hold a null or a value that is not finite
are dropped; of the others the commonest length is taken (of equally common ones
the longest) and other lengths are dropped; axes without variance are no
components, so equal vectors, a single vector and empty ones give no rows; equal
rows give equal results each; entries beyond 64 bits are cut to them; a deviation
beyond 64 bits is null; no rows give none. Only the id and the vector are read, so
other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from loreweave.sources.staging import stage

SCALE = 256
#: Vectors per block, and spectra that one task combines.
BLOCK, FAN = 4096, 16
#: Refinements at most, and the products of different axes, as a share, that end them.
ROUNDS, NEAR = 4, 1e-8
#: Axes with less than this share of the largest eigenvalue have no variance.
FLAT = 1e-12
_EPS = np.finfo(float).eps


def _secular(lam: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 = sum(z² / (root - lam)), as the pole next to each and the distance from it.

    ``lam`` rises strictly. Each root lies above its pole and below the next
    one, the last one below the last pole plus |z|². The nearer of both poles is
    the origin, so differences of roots and poles keep their leading digits. A
    step fits one pole on each side of the root; a step that leaves the bracket
    is replaced by its middle.
    """
    n, z2 = len(lam), z * z
    above = np.append(lam[1:], lam[-1] + z2.sum())
    gap = above - lam
    here = np.arange(n)
    middle = 1 - (z2 / (lam[:, None] + gap[:, None] / 2 - lam)).sum(axis=1)
    origin = np.where((middle < 0) & (here < n - 1), here + 1, here)
    poles = lam[None, :] - lam[origin][:, None]
    low = np.where(origin == here, 0.0, -gap / 2)
    high = np.where(origin == here, np.where(here < n - 1, gap / 2, gap), 0.0)
    tau = (low + high) / 2
    left = here[None, :] <= here[:, None]
    p = poles[here, here]
    q = np.where(here < n - 1, poles[here, np.minimum(here + 1, n - 1)], np.inf)
    for _ in range(100):
        away = tau[:, None] - poles
        with np.errstate(divide="ignore", invalid="ignore"):
            part = z2 / away
            slope = part / away
        value = 1 - part.sum(axis=1)
        low, high = np.where(value < 0, tau, low), np.where(value < 0, high, tau)
        done = (np.abs(value) <= 8 * _EPS * n * (1 + np.abs(part).sum(axis=1))) | (high - low <= 2 * _EPS * np.abs(tau))
        if done.all():
            break
        # value = c - a / (tau - p) + b / (q - tau), with slopes taken from the sums on each side.
        dp, dq = tau - p, q - tau
        a = np.where(left, slope, 0).sum(axis=1) * dp * dp
        b_slope = np.where(left, 0, slope).sum(axis=1)
        b = np.where(np.isfinite(dq), b_slope * np.where(np.isfinite(dq), dq, 0) ** 2, 0)
        c = value + a / dp - np.where(np.isfinite(dq), b / np.where(np.isfinite(dq), dq, 1), 0)
        # c (x - p)(q - x) - a (q - x) + b (x - p) = 0, in y = x - p with w = q - p.
        w = np.where(np.isfinite(q), q - p, 0.0)
        mid = c * w + a + b
        with np.errstate(divide="ignore", invalid="ignore"):
            root = np.sqrt(np.maximum(mid * mid - 4 * c * a * w, 0))
            y = np.where(np.isfinite(q), 2 * a * w / (mid + root), a / c)
        new = p + y
        inside = np.isfinite(new) & (new > low) & (new < high)
        tau = np.where(done, tau, np.where(inside, new, (low + high) / 2))
    return origin, tau


def rank_one(lam: np.ndarray, axes: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, rising, and axes (columns) of ``axes @ diag(lam) @ axes.T + v v.T``."""
    z = axes.T @ v
    norm = np.sqrt(z @ z)
    scale = max(abs(lam[-1]), norm * norm)
    if not scale:
        return lam, axes
    close = 8 * _EPS * scale
    # Axes of one eigenvalue are turned so that the last of them alone meets v.
    cuts = np.flatnonzero(np.diff(lam) > close) + 1
    starts, ends = np.append(0, cuts), np.append(cuts, len(lam))
    axes, z = axes.copy(), z.copy()
    for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
        u = z[s:e].copy()
        size = np.sqrt(u @ u) * (1 if u[-1] >= 0 else -1)
        if size:
            u[-1] += size
            u *= np.sqrt(2) / np.sqrt(u @ u)
            axes[:, s:e] -= np.outer(axes[:, s:e] @ u, u)
            z[s:e] = 0
            z[e - 1] = -size
    moved = np.abs(z) * norm > close
    if not moved.any():
        return lam, axes
    old, met = lam[moved], z[moved]
    origin, tau = _secular(old, met)
    # root_j - old_i, from the pole that root_j is measured from.
    away = (old[origin] - old[:, None]).T + tau[:, None]
    # The update that has exactly these roots, so that the new axes are orthogonal.
    n = len(old)
    poles = old[:, None] - old[None, :]
    np.fill_diagonal(poles, 1.0)
    logs = np.log(np.abs(away)).sum(axis=0) - np.log(np.abs(poles)).sum(axis=0)
    fitted = np.exp(logs / 2) * np.where(met < 0, -1.0, 1.0)
    turn = fitted[None, :] / -away
    turn /= np.sqrt((turn * turn).sum(axis=1, keepdims=True))
    new = lam.copy()
    new[moved] = old[origin] + tau
    axes[:, moved] = axes[:, moved] @ turn.T
    order = np.argsort(new, kind="stable")
    return new[order], axes[:, order]


class Spectrum:
    """Count, exact sums, and the eigenvalues and axes of the scatter around the mean."""

    def __init__(self, n: int, sums: np.ndarray, lam: np.ndarray, axes: np.ndarray) -> None:
        self.n, self.sums, self.lam, self.axes = n, sums, lam, axes

    @classmethod
    def empty(cls, d: int) -> Spectrum:
        return cls(0, np.zeros(d, np.int64), np.zeros(d), np.eye(d))

    def _shift(self, n: int, sums: np.ndarray) -> None:
        """Takes in the mean of ``n`` more vectors."""
        if self.n and n:
            apart = self.sums / self.n - sums / n
            self.lam, self.axes = rank_one(self.lam, self.axes, np.sqrt(self.n * (n / (self.n + n))) * apart)
        self.n, self.sums = self.n + n, self.sums + sums

    def add(self, x: np.ndarray) -> None:
        """Takes in rows of whole numbers."""
        sums = x.sum(axis=0)
        rows = np.linalg.qr(x - sums / len(x), mode="r")
        for v in rows:
            self.lam, self.axes = rank_one(self.lam, self.axes, v)
        self._shift(len(x), sums)

    def merge(self, other: Spectrum) -> None:
        for size, axis in zip(other.lam, other.axes.T, strict=True):
            if size > 0:
                self.lam, self.axes = rank_one(self.lam, self.axes, np.sqrt(size) * axis)
        self._shift(other.n, other.sums)

    def pack(self) -> bytes:
        return np.int64(self.n).tobytes() + self.sums.tobytes() + self.lam.tobytes() + self.axes.tobytes()

    @classmethod
    def unpack(cls, data: bytes, d: int) -> Spectrum:
        whole = np.frombuffer(data, np.int64, 1 + d)
        real = np.frombuffer(data, np.float64, d + d * d, 8 * (1 + d))
        return cls(int(whole[0]), whole[1:].copy(), real[:d].copy(), real[d:].reshape(d, d).copy())


def _rows(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _per_task(df: DataFrame, work: Callable[[Iterator[np.ndarray]], bytes | None], d: int) -> DataFrame:
    """``part, data``: what ``work`` makes of the vectors of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = work(_rows(batch.column(0), d) for batch in batches if batch.num_rows)
        if data is not None:
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

    out = df.select("x").mapInArrow(run, "data binary")
    return out.select(F.spark_partition_id().alias("part"), "data")


def _folded(parts: DataFrame, combine: Callable[[list[bytes]], bytes], name: str) -> bytes | None:
    """All rows of ``part, data`` combined, ``FAN`` at a time in tasks until so few are left."""
    parts = stage(parts, name)
    while parts.count() > FAN:

        def run(group: pa.Table) -> pa.Table:
            return pa.table({"part": group["part"].slice(0, 1), "data": pa.array([combine(group["data"].to_pylist())], pa.binary())})

        dealt = parts.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
        parts = stage(dealt.groupBy("part").applyInArrow(run, "part int, data binary"), name)
    rows = [bytes(r["data"]) for r in parts.orderBy("part").collect()]
    return combine(rows) if rows else None


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, x`` of the vectors that take part, of any length."""
    v = F.col(vector_col)
    fit = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(v, lambda c: F.floor(F.lit(SCALE) * c.cast("double")).cast("bigint"))
    return vectors.filter(fit).select(F.col(id_col).alias("vec_id"), x.alias("x"))


def fit(fitted: DataFrame, d: int) -> tuple[Spectrum, float] | None:
    """The spectrum of distinct vectors ``x`` of length ``d``, refined, and its trace."""

    def spectrum(parts: Iterator[np.ndarray]) -> bytes | None:
        found = Spectrum.empty(d)
        for x in parts:
            for at in range(0, len(x), BLOCK):
                found.add(x[at : at + BLOCK])
        return found.pack() if found.n else None

    def merged(rows: list[bytes]) -> bytes:
        first, *others = (Spectrum.unpack(data, d) for data in rows)
        for other in others:
            first.merge(other)
        return first.pack()

    data = _folded(_per_task(fitted, spectrum, d), merged, "spectra")
    if data is None:
        return None
    now = Spectrum.unpack(data, d)
    n, mean = now.n, now.sums / now.n

    def added(rows: list[bytes]) -> bytes:
        return np.sum([np.frombuffer(r) for r in rows], axis=0).tobytes()

    for _ in range(ROUNDS):
        axes, _ = np.linalg.qr(now.axes)

        def products(parts: Iterator[np.ndarray], axes: np.ndarray = axes) -> bytes | None:
            total = None
            for x in parts:
                for at in range(0, len(x), BLOCK):
                    y = (x[at : at + BLOCK] - mean) @ axes
                    total = y.T @ y + (0 if total is None else total)
            return None if total is None else total.tobytes()

        gram = np.frombuffer(_folded(_per_task(fitted, products, d), added, "products")).reshape(d, d) / n
        lam, turn = np.linalg.eigh((gram + gram.T) / 2)
        now = Spectrum(n, now.sums, lam, axes @ turn)
        # What the axes before this step were off by; one step squares it.
        size = np.sqrt(np.maximum(np.diag(gram), lam[-1] * FLAT))
        if not lam[-1] or np.abs(gram / np.outer(size, size) - np.diag(np.diag(gram) / size**2)).max() < NEAR:
            break
    return now, float(lam.sum())


def whiten(vectors: DataFrame, id_col: str, vector_col: str, most: int = 4) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for up to ``most`` components."""
    kind = vectors.schema[id_col].dataType
    out = StructType([
        StructField("vec_id", kind), StructField("component", IntegerType()), StructField("n", LongType()),
        StructField("deviation", LongType()), StructField("whitened", DoubleType()), StructField("explained", DoubleType()),
        StructField("identity_error", DoubleType()),
    ])
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, id_col, vector_col)
    lengths = rows.filter(F.size("x") > 0).groupBy(F.size("x").alias("d")).agg(F.count("*").alias("k"))
    commonest = lengths.orderBy(F.desc("k"), F.desc("d")).first()
    if commonest is None:
        return spark.createDataFrame([], out)
    d = commonest["d"]
    rows = rows.filter(F.size("x") == d)
    fitted = stage(rows.select("x").distinct(), "fitted")
    spectrum, trace = fit(fitted, d)
    order = np.argsort(-spectrum.lam, kind="stable")[:most]
    lam = spectrum.lam[order]
    order, lam = order[lam > lam[0] * FLAT], lam[lam > lam[0] * FLAT]
    if not len(lam) or lam[0] <= 0:
        return spark.createDataFrame([], out)
    n, sums, mean = spectrum.n, spectrum.sums, spectrum.sums / spectrum.n
    planes, explained = spectrum.axes[:, order] / np.sqrt(lam), lam / trace

    def measured(parts: Iterator[np.ndarray]) -> bytes | None:
        total, at_all = np.zeros((len(lam), len(lam) + 1)), False
        for x in parts:
            y, at_all = (x - mean) @ planes, True
            total += np.column_stack([y.T @ y, y.sum(axis=0)])
        return total.tobytes() if at_all else None

    def added(found: list[bytes]) -> bytes:
        return np.sum([np.frombuffer(r) for r in found], axis=0).tobytes()

    total = np.frombuffer(_folded(_per_task(fitted, measured, d), added, "whitened")).reshape(len(lam), -1) / n
    centred = total[:, :-1] - np.outer(total[:, -1], total[:, -1])
    error = float(np.abs(centred - np.eye(len(lam))).max())

    def deviations(x: np.ndarray) -> pa.Array:
        far = int(max(n * int(np.abs(x).max()) + int(np.abs(sums).max()), 1)) if len(x) else 1
        if far * far * d < 2**63:
            apart = n * x - sums
            return pa.array((apart * apart).sum(axis=1), pa.int64())
        exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums.tolist(), strict=True)) for row in x.tolist()]
        return pa.array([e if e < 2**63 else None for e in exact], pa.int64())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(lam)
        for batch in batches:
            x = _rows(batch.column(1), d)
            each = pa.array(np.repeat(np.arange(len(x)), k), pa.int64())
            m = len(each)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), pa.int32()),
                 pa.array(np.full(m, n), pa.int64()), deviations(x).take(each), pa.array(((x - mean) @ planes).ravel()),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(m, error))],
                out.names,
            )

    return rows.mapInArrow(project, out)

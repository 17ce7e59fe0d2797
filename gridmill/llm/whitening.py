"""Embedding whitening: eigenvectors of a distributed covariance, refined in mixed precision.

Vectors become whole numbers, and each different one is fitted once. Their sums and their
centred products are added up exactly, as whole numbers, by the tasks and by Spark, so
the covariance is exact whatever the order or the size. Only matrices of the vectors'
dimension reach the driver. There the eigenvectors are taken in float32 and corrected by
Ogita-Aishima iterations, which are matrix products: first in float64, then in extended
precision. Eigenvalues too close to be told apart are a cluster, whose vectors are turned
by the eigenvectors of the small matrix that the cluster sees (shifted by its mean, so
that what is left of it has all its digits).
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from gridmill.llm.common import stored

SCALE = 256
COMPONENTS = 4
#: Products of limbs of 16 bits over so many rows stay below 2^53, and sums of so many such blocks below 2^63.
LIMB, ROWS, BLOCKS = 16, 1 << 20, 1 << 10
OUT = "vec_id, component, n, deviation, whitened, explained, identity_error"


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id, x of the rows whose vector is there and has no null or non-finite entry: floor(256 c) as longs (beyond 64 bits the nearest long)."""
    vector = F.col("embedding")
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return embeddings.filter(vector.isNotNull() & finite).select("vec_id", F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def dimension(rows: DataFrame) -> int:
    """The length that most vectors have, of equals the largest; 0 where there is none."""
    found = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    return found.d if found else 0


def sums(fit: DataFrame, width: int) -> tuple[int, list[int], int]:
    """The number of vectors, their exact sum per dimension, and the largest absolute entry."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high, most = 0, np.zeros(width, np.int64), np.zeros(width, np.int64), 0
        for batch in batches:
            x = _matrix(batch.column(0), width)
            n += len(x)
            low += (x & 0xFFFFFFFF).sum(0)
            high += (x >> 32).sum(0)
            most = max(most, int(x.max(initial=0)), -int(x.min(initial=0)))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()), pa.array(low), pa.array(high), pa.array([min(most, 2**63 - 1)] * width, pa.int64())], ["i", "n", "low", "high", "most"])

    parts = fit.select("x").mapInArrow(added, "i int, n long, low long, high long, most long")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = sorted(parts.groupBy("i").agg(F.sum("n").alias("n"), exact("low"), exact("high"), F.max("most").alias("most")).collect())
    return rows[0].n, [(int(r.high) << 32) + int(r.low) for r in rows], max(r.most for r in rows)


def products(fit: DataFrame, centre: list[int], width: int) -> dict[tuple[int, int], int]:
    """The exact sums of products of x - centre, for every pair of dimensions i <= j."""
    upper = np.triu_indices(width)

    def out(total: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for s, g in total.items():
            v = g[upper]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), s, np.int32)), pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(v)], ["s", "i", "j", "v"])

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        blocks = 0
        for batch in batches:
            x = _matrix(batch.column(0), width) - np.array(centre, np.int64)
            for at in range(0, len(x), ROWS):
                y, limbs = x[at : at + ROWS], []
                while y.min(initial=0) < -(1 << LIMB) or y.max(initial=0) >= 1 << LIMB:
                    limbs.append((y & ((1 << LIMB) - 1)).astype(np.float64))
                    y = y >> LIMB
                limbs.append(y.astype(np.float64))
                for a, p in enumerate(limbs):
                    for b, q in enumerate(limbs):
                        g = (p.T @ q).astype(np.int64)
                        total[a + b] = total[a + b] + g if a + b in total else g
                blocks += len(limbs)
                if blocks >= BLOCKS - 8:
                    yield from out(total)
                    total, blocks = {}, 0
        yield from out(total)

    parts = fit.select("x").mapInArrow(multiplied, "s int, i int, j int, v long")
    found: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("s", "i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():
        found[r.i, r.j] = found.get((r.i, r.j), 0) + (int(r.v) << (LIMB * r.s))
    return found


def covariance(fit: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums S, and n^2 times the covariance, all exact. Vectors are centred by the mean's nearest whole number before multiplying, and the rest of the mean is taken off exactly."""
    n, total, most = sums(fit, width)
    centre = [(2 * s + n) // (2 * n) for s in total] if most < 1 << 61 else [0] * width
    rest = [s - n * c for s, c in zip(total, centre)]
    dots = products(fit, centre, width)
    return n, total, [[n * dots[min(i, j), max(i, j)] - rest[i] * rest[j] for j in range(width)] for i in range(width)]


def _clusters(values: np.ndarray, apart: float) -> list[np.ndarray]:
    """Places of values that a chain of gaps of at most ``apart`` holds together, two or more."""
    order = np.argsort(values)
    cuts = np.nonzero(np.diff(values[order]) > apart)[0] + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def _refined(a: np.ndarray, x: np.ndarray, most: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of a symmetric matrix from approximate ones, by Ogita-Aishima iterations in the matrix's own precision."""
    eps, eye = np.finfo(a.dtype).eps, np.eye(len(a), dtype=a.dtype)
    size = float(np.linalg.norm(a.astype(np.float64)))
    norm = lambda m: float(np.linalg.norm(m.astype(np.float64)))
    last = np.inf
    values = np.diag(x.T @ a @ x)
    for _ in range(most):
        r, s = eye - x.T @ x, x.T @ a @ x
        # Rounding must not make them unsymmetric: over a small gap that would unmake right angles.
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        apart = 2 * (norm(s - np.diag(values)) + size * norm(r))
        gaps = values[None, :] - values[:, None]
        far = np.abs(gaps) > apart
        e = np.where(far, (s + values[None, :] * r) / np.where(far, gaps, 1), r / 2)
        x = x + x @ e
        step, turned = float(np.abs(e).max()), False
        for own in _clusters(values, apart):
            # What the cluster sees of the matrix, less its mean: small, so no digits are lost to the mean.
            q, mean = x[:, own], values[own].mean()
            small = q.T @ (a @ q - mean * q)
            if norm(small - np.diag(np.diag(small))) > 4 * float(eps) * size:
                _, turn = np.linalg.eigh(((small + small.T) / 2).astype(np.float64))
                x[:, own], turned = q @ turn.astype(a.dtype), True
        if not turned and (step <= 4 * float(eps) or (step > 0.5 * last and last < 1e-6)):
            break
        last = np.inf if turned else step
    # What rounding over the smallest gaps has left of an angle.
    return values, x + x @ ((eye - x.T @ x) / 2)


def eigen(exact: list[list[int]], n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Falling eigenvalues, their unit eigenvectors (columns; the largest entry positive) and the trace of exact / n^2."""
    square = n * n
    trace = sum(exact[i][i] for i in range(len(exact)))
    if trace == 0:
        return np.zeros(len(exact)), np.eye(len(exact)), 0.0
    # The matrix over its trace: each entry in two doubles, put together in extended precision.
    high = [[v / trace for v in row] for row in exact]
    low = [[float(Fraction(v, trace) - Fraction(h)) for v, h in zip(row, hs)] for row, hs in zip(exact, high)]
    a = np.array(high, np.longdouble) + np.array(low, np.longdouble)
    _, x = np.linalg.eigh(a.astype(np.float32))
    _, x = _refined(a.astype(np.float64), x.astype(np.float64))
    values, x = _refined(a, x.astype(np.longdouble))
    x = x / np.sqrt((x * x).sum(0))
    order = np.argsort(-values, kind="stable")
    values, x = values[order], x[:, order]
    x = x * np.where(x[np.abs(x).argmax(0), np.arange(len(values))] < 0, -1, 1)
    whole = Fraction(trace, square)
    return np.array([float(np.longdouble(float(whole)) * v) for v in values]), x.astype(np.float64), float(whole)


class Whitening:
    """A fitted whitening: ``n``, the sums, falling eigenvalues ``e``, the axes as columns, and each one's share of the trace.

    An eigenvalue of nothing (no spread along the axis) whitens to 0.
    """

    def __init__(self, fit: DataFrame, width: int, components: int = COMPONENTS):
        self.width = width
        self.n, self.total, exact = covariance(fit, width)
        values, axes, trace = eigen(exact, self.n)
        self.e, self.axes = values[:components], axes[:, :components]
        self.none = self.e <= 1e-16 * trace
        self.explained = np.where(self.none, 0.0, self.e / (trace or 1.0))

    def _centred(self, x: np.ndarray) -> tuple[np.ndarray, bool]:
        """n x - S as longs, or as Python numbers where a long might not hold it or its square sum."""
        largest = max(1, int(x.max(initial=0)), -int(x.min(initial=0))) * self.n + max(map(abs, self.total))
        if self.width * largest * largest < 1 << 63:
            return x * self.n - np.array(self.total, np.int64), True
        return x.astype(object) * self.n - np.array(self.total, object), False

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The exact deviation of each row (an object array; None beyond 64 bits) and its whitened components."""
        z, small = self._centred(x)
        deviation = (z * z).sum(1)
        if not small:
            deviation = np.array([d if d < 1 << 63 else None for d in deviation.tolist()], object)
        scale = np.where(self.none, 0.0, 1 / np.sqrt(np.where(self.none, 1.0, self.e)))
        return deviation, ((z / self.n).astype(np.float64) @ self.axes) * scale

    def identity_error(self, fit: DataFrame) -> float:
        """The largest absolute entry of the whitened fit rows' covariance less the identity, from a pass over them."""
        width, p = self.width, len(self.e)
        i, j = np.triu_indices(p)

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, dots = np.zeros(p), np.zeros((p, p))
            for batch in batches:
                _, w = self.of(_matrix(batch.column(0), width))
                total, dots = total + w.sum(0), dots + w.T @ w
            yield pa.RecordBatch.from_arrays([pa.array([-1] * p + i.tolist(), pa.int32()), pa.array([*range(p), *j.tolist()], pa.int32()), pa.array([*total, *dots[i, j]], pa.float64())], ["i", "j", "v"])

        rows = {(r.i, r.j): r.v / self.n for r in fit.select("x").mapInArrow(added, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
        # The whitened rows' mean is nought but for rounding; what there is of it is taken off.
        return max(abs(v - rows[-1, a] * rows[-1, b] - (a == b)) for (a, b), v in rows.items() if a >= 0)


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every row with a whole vector and every component.

    Rows with a null vector, or a null or non-finite entry in it, are left out, and so
    are vectors of another length than most have. Repeated rows and null ids are kept and
    fitted once. With fewer dimensions than components there are as many components. An
    axis without spread (one vector, equal vectors) whitens to 0, explains nothing and
    leaves an identity error of 1; axes of equal spread are any of their plane, the same
    for all rows. A deviation beyond 64 bits is null. An empty table gives none. Extra
    columns are not looked at.
    """
    rows = quantised(embeddings)
    width = dimension(rows)
    schema = StructType([embeddings.schema["vec_id"], StructField("deviation", LongType()), StructField("w", ArrayType(DoubleType()))])
    rows = rows.filter(F.size("x") == width)
    if width == 0:
        return embeddings.sparkSession.createDataFrame([], StructType([schema[0]])).select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in zip(OUT.split(", ")[1:], ("int", "long", "long", "double", "double", "double"))])
    fit = stored(rows.select("x").distinct())
    found = Whitening(fit, width, components)

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviation, w = found.of(_matrix(batch.column(1), width))
            p = w.shape[1]
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(w) + 1) * p, p, dtype=np.int32)), pa.array(w.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation.tolist(), pa.int64()), listed], ["vec_id", "deviation", "w"])

    made = rows.mapInArrow(applied, schema).select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    share = F.get(F.array(*[F.lit(float(v)) for v in found.explained]), "at")
    return made.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(float(found.identity_error(fit))).alias("identity_error"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
